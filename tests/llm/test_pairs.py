import pytest

from tests.conftest import message
from tracewright.llm import pairs as P

Q = "Our nightly job dies in jobs/tensor/score.go with an error as soon as the runner meets an early task. How would you change the branch so that it is handled?"


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        (Q, None, "empty"), (Q, " ​﻿\n", "empty"), (Q, Q, "echo"), (Q, "> " + Q.upper(), "echo"), (Q, "User: " + Q.replace("nightly", "daily"), "echo"),
        (Q, Q + " The cause is a missing lock in the reader: take it before the loop starts, then run all of the tests again, and remove the old retry as it hides the fault from the log.", None),
        (Q, "I'm sorry, but I can't help with that request. Let me know if another topic would be useful.", "refusal"),
        (Q, "I see that you want to change score_task. My instructions prevent me from discussing this topic.", "refusal"),
        (Q, "Lo siento, pero no puedo ayudarte con eso.", "refusal"), ("你能帮我吗？", "抱歉，我无法协助完成这个请求。 请换一个话题。", "refusal"), (Q, "Tut mir leid, dabei kann ich leider nicht helfen.", "refusal"),
        (Q, "I cannot recommend the 0.23.0 release here, so the reader stays on the old lock. The cause is in the loop.", None),
        (Q, "Sorry for the confusion earlier, the cause is in a different place. The reader takes the lock too late.", None),
        (Q, "Der Fehler liegt in der Schleife, weil die Sperre nicht gesetzt wird und der Leser zu früh beginnt.", "language"),
        (Q + " Please answer in German.", "Der Fehler liegt in der Schleife, weil die Sperre nicht gesetzt wird und der Leser zu früh beginnt.", None),
        (Q, "Done.", None), (Q, "`fix_lock`", None), (None, "The reader takes the lock too late.", None),
    ],
)
def test_pair_defect(question, answer, want):
    assert P.pair_defect(question, answer) == want


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        ("Hallo", "hallo", "echo"), ("why", "Why", "echo"), ("why", "yes", None), ("ok go", "done", None), ("a", "b", None), ("", "a", None),
        ("why does it fail? " * 400, "Why does it fail? " * 400, "echo"), ("word " * 3000 + "why?", "It waits for the lock.", None),
        (Q, "I can't help with that request. " * 50, "refusal"), (Q, "I can't help with that request. " * 50 + "The cause is the lock in the reader.", None),
        (Q, " ".join(f"Step {k} of the change moves the lock before the loop in the reader." for k in range(2000)), None),
    ],
)
def test_length_decides_nothing(question, answer, want):
    assert P.pair_defect(question, answer) == want


def test_tool_defects_and_places(spark, sessions):
    good = "The reader takes the lock too late, so move it before the loop."
    rows = [
        (1, [message("system", "s"), message("user", "Why is it so slow in the loop?"), message("assistant", "", [("a", "read", "{}"), ("b", "read", "{}")]), message("tool", "r", answers="b"), message("tool", "r", answers="zz"), message("assistant", good)]),
        (2, [message("tool", "r", answers="late"), message("user", "Why is it so slow in the loop?"), message("assistant", "x", [("late", "read", None), (None, "read", None)]), message("tool", "r", answers="late"), message("tool", "r")]),
        (3, None), (4, []), (5, [message("user", "Why?"), message("user", "And how is it in the loop?"), message("assistant", good)]),
    ]
    df = sessions(rows, "rec_id").selectExpr("*", "'x' as defect", "1 as msg_no")
    got = sorted((r.rec_id, r.msg_no, r.defect) for r in P.certain_defects(df).collect())
    assert got == [(1, 2, "tool_unanswered"), (1, 4, "tool_orphan"), (2, 0, "tool_orphan"), (2, 1, "empty"), (2, 2, "tool_unanswered"), (2, 4, "tool_orphan"), (5, 0, "empty")]
    assert P.broken_pairs(df.limit(0)).count() == 0


def test_truncated_answers(spark, sessions):
    whole = ["The reader takes the lock too late, so move it.", "Run the tests again after the change.", "It fails on an empty list."]
    rows = [(k, [message("user", f"Why does part {k} fail in the loop of the reader?"), message("assistant", f"Case {k} of the reader. " + whole[k % 3])]) for k in range(60)]
    rows.append((100, [message("user", "Why does it fail in the reader?"), message("assistant", "The reader takes the lock too late, so the writer that holds the fro")]))
    got = {(r.rec_id, r.defect) for r in P.broken_pairs(sessions(rows, "rec_id")).collect()}
    assert got == {(100, "truncated")}
