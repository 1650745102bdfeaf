import json
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.sources import readers as R
from tracewright.sources import sessiondb, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lenient_and_strict_lines(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"messages":[{"role":"user","content":"hi"}],"_split":"eval","source":"x"}\n\n{bad\n{"messages":null}\n{"other":1}\n')
    r = R.jsonl_lenient(spark, p).collect()
    assert len(r) == 1 and r[0].messages[0].content == "hi" and r[0]._split == "eval"
    good = write(tmp_path / "b.jsonl", '{"a":1}\n\n{"a":2}\n')
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert [x.a for x in R.jsonl_strict(spark, good, schema).orderBy("_ord").collect()] == [1, 2]
    with pytest.raises(Exception, match="malformed line"):
        R.jsonl_strict(spark, p, schema).collect()


def test_proxy_folder(spark, tmp_path):
    def rec(name, n, **kw):
        ms = [{"role": "user", "content": "q"}] + [{"role": "assistant", "content": str(k)} for k in range(n)]
        write(tmp_path / "t" / name, json.dumps({"timestamp": name, "upstream": "openrouter", "request": {"model": "m", "messages": ms}, "response": {"message": {"role": "assistant", "content": "end"}}, **kw}))

    rec("1.json", 1), rec("2.json", 3), rec("3.json", 3), rec("4.json", 9, replay={"task_id": "t", "pass": False}), rec("5.json", 9, replay={"task_id": "held", "pass": True}), rec("x.txt", 20)
    held = spark.createDataFrame([("held",)], "task_id string")
    r = R.collapse_traces(R.proxy_folder(spark, str(tmp_path / "t")), held).collect()
    assert len(r) == 1 and r[0].file.endswith("2.json") and r[0].source == "frontier" and len(r[0].messages) == 5


def test_transcripts(spark, tmp_path):
    line = lambda role, text: json.dumps({"role": role, "message": {"content": [{"type": "text", "text": text}]}}) + "\n"
    body = line("user", "<user_query>one</user_query>") + line("assistant", "x" * 250) + line("user", "<user_query>two</user_query>") + line("assistant", "short")
    for name in ("p/a.jsonl", "p/index.jsonl", "p/subagents/b.jsonl"):
        write(tmp_path / name, body)
    r = R.transcripts(spark, str(tmp_path)).collect()
    assert [(x.prompt, len(x.answer)) for x in r] == [("one", 250)]


def test_parse_input_and_shapes(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, '{"a":3}'), (3, '{"a":4}\n\n{"a":5}\n')], "k int, t string")
    assert sorted((r.k, r.record_no, json.loads(r.record)["a"]) for r in R.parse_input(df, "t").collect()) == [(1, 0, 1), (1, 1, 2), (2, 0, 3), (3, 0, 4), (3, 1, 5)]
    for bad in ("", '{"a":1}\nnope\n{"b":2}'):
        with pytest.raises(Exception, match="empty input|bad line"):
            R.parse_input(spark.createDataFrame([(1, bad)], "k int, t string"), "t").collect()
    shapes = ['{"request":{"messages":[{"role":"user"}]},"response":{"message":{"role":"assistant"}}}', '{"messages":[{"role":"user"}]}', '[{"role":"user"}]', '{"role":"assistant","content":[{"type":"text"}]}', '{"role":"user","content":[{"type":"text"}]}', '{"x":1}']
    got = [r.m for r in spark.createDataFrame(list(enumerate(shapes)), "k int, t string").orderBy("k").select(R.extract_session(F.col("t")).alias("m")).collect()]
    assert [None if m is None else len(json.loads(m)) for m in got] == [2, 1, 1, 1, None, None]


def test_texts_csv_values(spark, tmp_path):
    write(tmp_path / "c/a.PY", "x = 1"), write(tmp_path / "c/node_modules/b.py", "no"), write(tmp_path / "c/d.bin", "no")
    assert [r.path.rsplit("/", 1)[1] for r in R.text_corpus(spark, str(tmp_path / "c")).collect()] == ["a.PY"]
    p = write(tmp_path / "m.csv", "  # note\n\nid, amount\n1,$2\n # x\n2,3\n")
    assert [tuple(r) for r in R.messy_csv(spark, p).orderBy("id").collect()] == [("1", "$2"), ("2", "3")]
    q = write(tmp_path / "n.csv", "a,b\n1.5,x\nbad,y\n")
    assert sorted((r.a for r in R.csv_column(spark, q, "a").collect()), key=str) == [1.5, None]
    kv = spark.createDataFrame([("A = 1\n# c\n\nB=x=y\nA=2\n",)], "t string")
    assert {r.key: r.value for r in R.key_values(kv, "t").collect()} == {"A": "2", "B": "x=y"}
    with pytest.raises(Exception, match="line 2"):
        R.key_values(spark.createDataFrame([("A=1\nnope\n",)], "t string"), "t").collect()


def test_loaders(spark, tmp_path):
    assert R.load_any(spark, write(tmp_path / "a.json", '[1, {"b": 2}]')).count() == 2 and R.load_any(spark, write(tmp_path / "b.json", '{"x": 1}')).count() == 1
    assert R.load_any(spark, write(tmp_path / "c.jsonl", "1\n\n2\n")).count() == 2
    with pytest.raises(Exception, match="d.jsonl:3: bad JSON"):
        R.load_any(spark, write(tmp_path / "d.jsonl", "1\n\n{bad\n")).collect()
    with pytest.raises(ValueError, match="no loader"):
        R.load_any(spark, "x.bin")
    p = write(tmp_path / "w.jsonl", '{"task_id":"a"}\n{"task_id":"b","weight":0.0}\n{"task_id":"c","weight":null}\n')
    assert {r.task_id: r.weight for r in R.task_manifest(spark, p).collect()} == {"a": 1.0, "b": 0.0, "c": None}


def test_git_log(spark):
    log = "\x1eabc\x1fpar\x1f1700000000\x1fSubject\x1fBody\x1f\n3\t1\ta.py\n-\t-\tlogo.png\n\x1edef\x1f\x1f1700000001\x1fS2\x1f\x1f"
    commits, stat = R.git_log(spark.createDataFrame([(log,)], "value string"))
    assert sorted(r.sha for r in commits.collect()) == ["abc", "def"] and sorted((r.added, r.path) for r in stat.collect()) == [("-", "logo.png"), ("3", "a.py")]


def test_session_database(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE part (id TEXT, message_id TEXT, session_id TEXT, time_created INTEGER, data TEXT)")
        db.executemany("INSERT INTO part VALUES (?, ?, ?, ?, ?)", [(f"p{k}", "m", f"s{k % 3}", k, json.dumps({"k": k})) for k in range(100)])
        db.execute("CREATE TABLE message (id TEXT, session_id TEXT, time_created INTEGER, data TEXT)")
    sessiondb.register(spark)
    df = spark.read.format("sessiondb").option("path", path).option("table", "part").load()
    assert df.count() == 100 and df.where("session_id = 's1' and time_created > 50").count() == sum(1 for k in range(51, 100) if k % 3 == 1)
    assert spark.read.format("sessiondb").option("path", path).option("table", "message").load().count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "train", None), (2, None, "eval", 1)], "a int, b string, _split string, c int").withColumn("_raw", F.concat(F.lit("line "), "a"))
    assert len(sinks.write_splits(df, str(tmp_path / "o"))) == 2 and len(sinks.write_splits(df.where("a = 1"), str(tmp_path / "q"))) == 1
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "o/train")).collect()]
    assert lines == [{"a": 1, "b": "é", "c": None}]
    sinks.write_clean(df, str(tmp_path / "r"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["line 1", "line 2"]
    assert sinks.manifest(df.where("a = 1")).first().bytes == len('{"a":1,"b":"é","c":null}'.encode()) + 1 and sinks.manifest(df.limit(0)).first().lines == 0
    up = sinks.upsert(spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string"), "id")
    assert sorted(map(tuple, up.collect())) == [(1, "x"), (2, "z"), (3, "w")]
    failed = spark.createDataFrame([("t", "knowledge", False, [("p", "r")]), ("u", "code", False, [("p", "r")])], "task_id string, type string, passed boolean, turns array<struct<prompt:string,reference:string>>")
    assert [(m.role, m.content) for m in sinks.distilled(failed).first().messages] == [("user", "p"), ("assistant", "r")]


def test_tag_traces(spark):
    traces = spark.createDataFrame([(1, 5, None), (2, 15, None), (3, 5, ("old",))], "record_id int, at int, replay struct<task_id:string>")
    tasks = spark.createDataFrame([("a", 0, 10), ("b", 4, 6)], "task_id string, start int, end int")
    assert {r.record_id: r.replay_task for r in sinks.tag_traces(traces, tasks, "at", 10).collect()} == {1: "b", 2: None, 3: "old"}
