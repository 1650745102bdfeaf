import pytest

from tests.conftest import message
from tracewright.llm import splits as S

PROMPT = "Please look at the   Widget in core/app.py and tell me why it breaks"


@pytest.fixture(scope="module")
def tables(spark):
    from tests.conftest import MSG

    tasks = spark.createDataFrame([("cd-0123456789ab", PROMPT), ("kn-ffffffffffff", None), ("kn-aaaaaaaaaaaa", "Another prompt that is fairly long")], "id string, prompt string")
    rows, k = [], 0
    for g in ["cd-0123456789ab", " CD - 0123456789AB", "task:cd-0123456789ab", "replay/cd_0123456789ab#3", "cd-0123456789ab.json", "cd-999999999999", "0cd-0123456789abf"]:
        rows.append((k, [message("user", "x")], g, "Frontier"))
        k += 1
    for text in [f"Hi, {PROMPT.upper()} thanks", PROMPT.replace(" ", "\n"), "nothing", None]:
        rows.append((k, [message("system", "s"), message("user", text)], None, "cursor "))
        k += 1
    rows += [(k, None, None, None), (k + 1, [], "grp", None)]
    rows += [(100 + j, [message("user", "y")], f"g{j % 300}" if j % 3 else "hot", ["a", "b"][j % 2]) for j in range(900)]
    return spark.createDataFrame(rows, f"sample_id bigint, messages array<{MSG}>, _group string, source string").selectExpr("*", "1 as component", "'x' as split", "2 as weight"), tasks


def test_task_links(tables):
    got = {(r.sample_id, r.task_id) for r in S.task_links(*tables).collect()}
    assert got == {(k, "cd-0123456789ab") for k in (0, 1, 2, 3, 4, 7, 8)}


def test_groups_stay_together_and_all_rows_are_placed(tables):
    rows = S.split_assignments(*tables).collect()
    groups = {r.sample_id: r._group for r in tables[0].select("sample_id", "_group").collect()}
    assert len(rows) == len(groups) and {r.split for r in rows} <= {"train", "validation", "test"}
    by: dict = {}
    for r in rows:
        if groups[r.sample_id]:
            by.setdefault(groups[r.sample_id], set()).add(r.split)
    assert all(len(v) == 1 for v in by.values())
    task_rows = {r.split for r in rows if r.sample_id in (0, 1, 2, 3, 4, 7, 8)}
    assert len(task_rows) == 1
    share = sum(r.split == "train" for r in rows) / len(rows)
    assert 0.7 < share < 0.9


def test_empty_tables(tables):
    sessions, tasks = tables
    assert S.task_links(sessions.limit(0), tasks).count() == 0
    assert S.split_assignments(sessions.limit(0), tasks.limit(0)).count() == 0
    assert S.split_assignments(sessions, tasks.limit(0)).count() == sessions.count()


def test_contraction_takes_several_coin_rounds(spark):
    """Cycles, long paths, a star and a clique: components as by union-find, after more than one round."""
    from tracewright.llm.components import components, contract

    edges = [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(120)]  # a path
    edges += [(f"c{k:03d}", f"c{(k + 1) % 60:03d}") for k in range(60)]  # a cycle
    edges += [("hub", f"leaf{k}") for k in range(300)] + [(f"q{i}", f"q{j}") for i in range(8) for j in range(i)] + [("loop", "loop"), (None, "x")]
    df = spark.createDataFrame(edges, "u string, v string")
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u and v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    assert {(r.vertex, r.component) for r in components(df).collect()} == {(v, find(v)) for v in parent}
    steps = contract(df.where("u is not null"))
    assert len(steps) > 2 and all(s.count() for s in steps)


def test_a_row_of_several_tasks_of_one_component(spark, tables):
    """Rows whose first message holds two prompts tie two tasks together; other rows keep to their own."""
    from tests.conftest import MSG

    tasks = spark.createDataFrame([("cd-0123456789ab", "alpha prompt of the first"), ("kn-ffffffffffff", "beta prompt of the second"), ("kn-aaaaaaaaaaaa", "beta prompt of the second")], "id string, prompt string")
    rows = [(1, [message("user", "Alpha prompt of the first; BETA prompt of the second")], None), (2, [message("user", "x")], "CD 0123456789AB"), (3, [message("user", "so: beta prompt of the second")], None)]
    sessions = spark.createDataFrame(rows, f"sample_id bigint, messages array<{MSG}>, _group string").selectExpr("*", "'a' as source")
    one, two, three = "cd-0123456789ab", "kn-ffffffffffff", "kn-aaaaaaaaaaaa"
    assert {(r.sample_id, r.task_id) for r in S.task_links(sessions, tasks).collect()} == {(1, one), (1, two), (1, three), (2, one), (3, two), (3, three)}
    assert len({r.split for r in S.split_assignments(sessions, tasks).collect()}) == 1


def test_shares_hold_within_each_source(tables):
    rows = S.split_assignments(tables[0].where("sample_id >= 100 and _group <> 'hot'"), tables[1]).collect()
    for source in ("a", "b"):
        some = [r.split for r in rows if r.source == source]
        for split, share in S.SPLITS:
            assert abs(some.count(split) / len(some) - share) < 0.03
