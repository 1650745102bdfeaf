import random

import pytest
from pyspark.sql import functions as F

from tracewright.llm import truncation as T


@pytest.fixture(scope="module")
def corpus():
    random.seed(8)
    words = "reader writer lock loop queue cache branch index the of a in on with".split()
    sentence = lambda: (" ".join(random.choice(words) for _ in range(random.randint(5, 12))) + ".").capitalize()
    rows, cut = [], set()
    for k in range(300):
        text = " ".join(sentence() for _ in range(random.randint(2, 5)))
        if k % 10 == 0:
            text = text[: random.randint(len(text) // 3, len(text) - 5)]
            while text[-1] in ". ":
                text = text[:-1]
            cut.add((k, 0, "end"))
        rows.append((k, 0, "assistant", text))
    for k in range(300, 600):
        lines = [f"$ verify part-{k} --quiet"] + [f"INFO  step {random.randint(1, 99)}: do_thing done" for _ in range(random.randint(3, 9))] + [f"{random.randint(1, 9)} failed, {random.randint(1, 9)} passed in 3 s."]
        text = "\n".join(lines)
        if k % 10 == 0:
            text = text[: random.randint(len(text) // 3, len(text) - 25)].rstrip()
            text = text[:-1] if text.endswith("done") else text
            cut.add((k, 0, "end"))
        elif k % 10 == 1:
            text = text[random.randint(30, len(text) // 2) :].lstrip()
            text = text[1:] if text.startswith(("INFO", "step")) else text
            cut.add((k, 0, "start"))
        rows.append((k, 0, "stderr", text))
    rows += [(700 + k, 0, "stderr", "timeout after 900s") for k in range(30)]
    rows += [(900, 0, "assistant", None), (901, 0, "assistant", " \n"), (902, 0, "assistant", "A long one. " * 20_000), (903, 0, "tool", "x…")]
    return rows, cut | {(903, 0, "end")}


def test_planted_cuts_are_found(spark, corpus):
    rows, cut = corpus
    df = spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string").selectExpr("*", "1 as size", "'x' as head")
    out = T.cut_texts(df).collect()
    assert len(out) == len(rows) - 2
    got = {(r.rec_id, r.item_no, side) for r in out for side in ("start", "end") if r[f"cut_{side}"]}
    assert len(cut & got) >= 0.9 * len(cut) and len(got - cut) <= 0.05 * len(cut) + 2


def test_near_copies_show_a_cut_at_a_full_stop(spark):
    long = "The gateway refuses any cache that the old reader signed with part pkg/reader.py and keeps it in the queue for later use by others."
    rows = [(k, 0, "assistant", f"Sentence number {k} of the reader ends here.") for k in range(50)] + [(100, 0, "assistant", long), (101, 0, "assistant", long[: long.index("reader.py") + 7]), (102, 0, "assistant", long)]
    got = {r.rec_id for r in T.cut_texts(spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")).where("cut_end").collect()}
    assert got == {101}


def test_empty(spark):
    assert T.cut_texts(spark.createDataFrame([], "rec_id bigint, item_no int, kind string, text string")).count() == 0


def test_copies_of_a_cut_text_are_no_evidence(spark):
    cut = "The gateway refuses any cache that the old reader signed and keeps it in the"
    rows = [(k, 0, "assistant", f"Sentence number {k} of the reader ends here.") for k in range(60)] + [(100 + k, 0, "assistant", cut) for k in range(30)]
    log = lambda n: "\n".join([f"$ verify part-{n} --quiet", *[f"INFO  step {j}: do_thing done" for j in range(5)]])
    rows += [(200 + k, 0, "stderr", log(k) + f"\n{k % 9} failed, {k % 7} passed in 3 s.") for k in range(60)]
    rows += [(300 + k, 0, "stderr", log(7) + "\nINFO  step 6: do_th") for k in range(30)] + [(400 + k, 0, "stderr", "timeout after 900s") for k in range(30)]
    got = {r.rec_id for r in T.cut_texts(spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")).where("cut_end").collect()}
    assert got == {*range(100, 130), *range(300, 330)}


def test_prefixes_meet_over_partition_borders(spark):
    words = "the gateway refuses any cache that the old reader signed with part then keeps it queued and never tells anyone".split()
    more = [f"w{k}x" for k in range(60)]
    rows = [(k, 0, "assistant", "The " + " ".join(words[1:] + more[:k]) + ".") for k in range(2)] + [(k, 0, "assistant", "The " + " ".join(words[1:] + more[:k])) for k in range(2, 60)]
    texts = spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")
    for conf, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.shuffle.partitions", "30")):
        spark.conf.set(conf, value)
    try:
        features = T._features(texts).where("tag = 0")
        got = {r.rec_id for r in T._aligned(texts, features).where("early").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == set(range(2, 59))


def test_a_longer_copy_shows_a_lost_beginning_of_prose(spark):
    long = "the gateway refuses any cache that bob the old reader signed with part seven and keeps it in the queue for later use by others."
    rows = [(k, 0, "assistant", f"Sentence number {k} of the reader ends here.") for k in range(50)] + [(100, 0, "assistant", long), (101, 0, "assistant", long[long.index("bob") :])]
    got = {r.rec_id for r in T.cut_texts(spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")).where("cut_start").collect()}
    assert got == {101}


def test_a_near_copy_with_an_edited_opening_shows_the_cut(spark):
    random.seed(3)
    words = [f"{random.choice('abcdefgh')}{k}word" for k in range(110)]
    long = "The reader " + " ".join(words) + "."
    edited = "A keeper " + " ".join(words[:100]) + "."  # some 800 characters, closed by a full stop of its own
    open_end = "A keeper " + " ".join(words[:99]) + " " + words[99][:3]
    lost = " ".join(words[6:50] + ["other"] + words[51:]) + "."
    rows = [(k, 0, "assistant", f"Sentence number {k} of the reader ends here.") for k in range(50)] + [(100, 0, "assistant", long), (101, 0, "assistant", edited), (102, 0, "assistant", open_end), (103, 0, "assistant", lost)]
    texts = spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")
    features = T._features(texts).where("tag = 0").withColumn("open", F.col("rec_id") > 100)
    pairs = T._near_pairs(features)
    keys = {r.text_key: r.rec_id for r in features.select("text_key", "rec_id").collect()}
    assert {(keys[r.text_key], r.mark) for r in T._near_aligned(T._ends(texts, features, pairs), pairs).collect()} == {(102, "early"), (103, "late")}
    assert {r.rec_id for r in T.cut_texts(texts).where("cut_end").collect()} == {102}


def test_logs_that_end_with_a_whole_line_are_whole(spark):
    """Logs without the usual closing count as cut only if their last line is broken."""
    random.seed(4)
    step = lambda: f"INFO  step {random.randint(1, 99)}: {random.choice(['load', 'bind', 'drain'])}_thing done"
    rows = []
    for k in range(120):
        lines = [f"$ verify part-{k} --quiet", *[step() for _ in range(random.randint(3, 9))]]
        if k % 3:
            lines.append(f"{k % 9} failed, {k % 7} passed in 3 s.")
        rows.append((k, 0, "stderr", "\n".join(lines) + ("\n" + "INFO  step 7: load_thing done"[: 8 + k // 6] if k % 20 == 0 else "")))
    got = {r.rec_id for r in T.cut_texts(spark.createDataFrame(rows, "rec_id bigint, item_no int, kind string, text string")).where("cut_end or cut_start").collect()}
    assert got == {k for k in range(120) if k % 20 == 0}
