import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from decidra.operators import records
from decidra.sources import adapters, readers, sinks
from decidra.streaming import ledger

S = StructType([StructField("id", StringType()), StructField("n", IntegerType())])


def test_jsonl_and_rejects(spark, tmp_path, rows):
    (tmp_path / "a.jsonl").write_text('{"id":"x","n":1}\n\n  \n[1]\n{"id":"y"\n{"id":"z","n":null}\n')
    good, bad = readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), S)
    assert rows(good) == [("x", 1), ("z", None)] and bad.count() == 2
    with pytest.raises(ValueError, match="a.jsonl"):
        readers.read_jsonl_strict(spark, str(tmp_path / "a.jsonl"), S)
    (tmp_path / "b.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="no records"):
        readers.read_jsonl_strict(spark, str(tmp_path / "b.jsonl"), S)


def test_wrapped_documents(spark, tmp_path, rows):
    (tmp_path / "w.json").write_text(json.dumps({"cases": [{"id": "a", "n": 1}, {"id": "b"}]}, indent=1))
    (tmp_path / "l.json").write_text(json.dumps([{"id": "a", "n": 1}]))
    assert rows(readers.read_wrapped(spark, str(tmp_path / "w.json"), "cases", S)) == [("a", 1), ("b", None)]
    assert rows(readers.read_wrapped(spark, str(tmp_path / "l.json"), None, S)) == [("a", 1)]


def test_csv_trees_and_siblings(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text('id,n\n"a,b",1\n')
    (tmp_path / "q.csv").write_text("id,n\nc,2\n")
    assert rows(readers.read_tagged_csv(spark, {"p": str(tmp_path / "p.csv"), "q": str(tmp_path / "q.csv")}, S)) == [("a,b", 1, "p"), ("c", 2, "q")]
    (tmp_path / "t/u").mkdir(parents=True)
    (tmp_path / "t/u/b.sv").write_bytes(b"two \xff")
    (tmp_path / "t/u/a.sv").write_text("one")
    files = readers.read_text_tree(spark, str(tmp_path / "t"), "*.sv")
    assert readers.joined_siblings(files).first().text == "one\n\ntwo \ufffd"


def test_shards_precedence_and_ids(spark, tmp_path, rows):
    for i, ids in enumerate((["a", "b"], ["b", "d"])):
        (tmp_path / f"shard_{i}.jsonl").write_text("\n".join(json.dumps({"id": x, "n": i}) for x in ids))
    shards = readers.read_shards(spark, str(tmp_path / "shard_*.jsonl"), S)
    base = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], S)
    assert rows(readers.shard_coverage(shards, base, "id")) == [("extra", 1), ("missing", 1), ("repeated", 1)]
    assert rows(readers.first_by_precedence([base.filter("id = 'b'"), shards.select("id", "n")], "id"), "id", "n") == [("a", 0), ("b", 0), ("d", 1)]
    assert rows(readers.ids_in_text(spark.createDataFrame([("see x:1, x:2 x:1",), (None,)], "t string"), F.col("t"), r"x:\d")) == [("x:1",), ("x:2",)]
    df = spark.createDataFrame([("r", "s1", "s2"), ("r", "s1", None)], "repo string, a string, b string")
    assert rows(readers.commit_list(df, "repo", ["a", "b"])) == [("r", "s1"), ("r", "s2")]


def test_manifests():
    assert readers.read_manifest("name: 'x'\n  nested: 1\n# c: d\n- e: f\nbad line\nv: 2") == {"name": "x", "v": "2"}
    assert readers.read_manifest(None) == {}


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([("b", 2), ("a", None)], S)
    sinks.write_jsonl(df, str(tmp_path / "o"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part*"))) == '{"id":"a","n":null}\n{"id":"b","n":2}\n'
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_jsonl(df, str(tmp_path / "o"))
    kept, rejected = sinks.split_rejects(df, F.array_compact(F.array(F.when(F.col("n").isNull(), F.lit("no n")))))
    assert rows(kept) == [("b", 2)] and rejected.first().errors == ["no n"]
    sinks.append_log(df, str(tmp_path / "log"))
    sinks.append_log(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    root = str(tmp_path / "pub")
    (tmp_path / "pub").mkdir()
    sinks.publish(df, root, "v1")
    sinks.publish(df.limit(1), root, "v2")
    assert sinks.latest(spark, root).count() == 1
    with pytest.raises(FileExistsError):
        sinks.publish(df, root, "v1")
    with pytest.raises(ValueError, match="empty"):
        sinks.publish(df.limit(0), root, "v3")
    assert sinks.latest(spark, root).count() == 1
    assert sinks.markdown(df.orderBy("id")).splitlines()[0] == "| id | n |"


def test_adapters(spark):
    hwe = spark.createDataFrame([(1, "o/r", None, "Reset is wrong", "body", None, ["hw/dv/t.sv", "rtl/a.sv"], None, "diff"), (2, None, None, None, None, None, None, None, None)], "id int, repo string, base_commit string, title string, body string, level2 string, modified_files array<string>, reproducer_signal string, test_patch string")
    r, bare = adapters.issues(hwe).orderBy("id").collect()
    gold = json.loads(r.gold)
    assert r.id == "hwe:1" and gold["next_action"]["probabilities"]["testbench"] == 0.5 and gold["root_cause_type"]["probabilities"]["reset_initialization"] == 1
    assert gold["evidence_sufficient"]["probabilities"] == {"false": 0, "true": 1} and r.outcome.modified_files == ["hw/dv/t.sv", "rtl/a.sv"] and r.provenance.quality == "gold"
    assert json.loads(r.state)["previous_actions"] == [] and json.loads(bare.gold)["next_action"]["probabilities"]["abstain"] == 1 and json.loads(bare.gold)["evidence_sufficient"]["probabilities"]["false"] == 1
    mutants = spark.createDataFrame([("r", "m", "width", "sim_ok", None, "log"), ("r", "m2", "x", "failed", None, "")], "repo string, module string, bug_type string, simulation_status string, rtl string, log string")
    assert [x.id for x in adapters.simulated_mutants(mutants).collect()] == ["rtl-augmented:r:m:width"]
    asked = adapters.instructions(spark.createDataFrame([(0, "fix the syntax"), (1, None)], "line int, instruction string")).collect()
    assert [json.loads(x.gold)["evidence_sufficient"]["probabilities"]["true"] for x in asked] == [1, 0]
    assert adapters.bug_fixtures(spark.createDataFrame([("runtime", " 1 ", "v", "type error", "d", "e", "m")], "kind string, bug_id string, language string, bug_type string, description string, error string, rtl string")).first().id == "rootcause:runtime:1"
    tree = spark.createDataFrame([("buggy_rtl", "x/g/a.sv", "t", "a handshake")], "variant string, path string, text string, notes string")
    made = adapters.assertion_tree(tree).first()
    assert made.source_group == "hiersva:g:a" and made.provenance.synthetic and json.loads(made.gold)["root_cause_type"]["probabilities"]["timing_protocol"] == 1
    assert adapters.prompt_tree(spark.createDataFrame([("d/fsm/p1_prompt.txt", "t")], "path string, text string")).first().id == "chipbench:fsm:p1"


def test_questions(spark):
    five = adapters.question_table(spark)
    assert [r.qid for r in adapters.question_table(spark, scores=False).collect()] == ["next_action", "root_cause_type", "evidence_sufficient"]
    q = json.loads(adapters.questions_json(five))
    assert {k: v["type"] for k, v in q.items()} == records.QUESTION_TYPES and q["risk"]["criteria"] == ["0", "1", "2", "3"] and len(q["next_action"]["criteria"]) == 9


def test_ledger_guards(spark, tmp_path, rows):
    home = str(tmp_path / "ledger")
    todo = spark.createDataFrame([(k,) for k in "abcde"] + [(None,)], "id string")
    ledger.apply_in_order(spark.createDataFrame([("a",), ("b",)], "id string"), 0, home, "id", todo, 2)
    for wrong in (["d", "c", "e"], ["a", "b"], ["d", "e"]):
        with pytest.raises(ledger.LedgerError):
            ledger.apply_in_order(spark.createDataFrame([(k,) for k in wrong], "id string"), 1, home, "id", todo, 2)
    ledger.apply_in_order(spark.createDataFrame([("d",), ("c",)], "id string"), 1, home, "id", todo, 2)
    assert rows(ledger.read(spark, home)) == [("a",), ("b",), ("c",), ("d",)] and ledger.next_batch(todo, ledger.read(spark, home), "id", 2) == ["e"]
    (tmp_path / "ledger" / ".tmp_1").mkdir()
    ledger.lock(spark, home)
    assert not (tmp_path / "ledger" / ".tmp_1").exists()
    with pytest.raises(ledger.LedgerError):
        ledger.lock(spark, home)
    ledger.unlock(spark, home)
    ledger.lock(spark, home)
    ledger.check_resume(spark, home, {"data": "1", "model": "m", "epochs": "2"})
    ledger.check_resume(spark, home, {"data": "1", "model": "m", "epochs": "3"}, may_change=("epochs",))
    with pytest.raises(ledger.LedgerError, match="data: saved '1', now '2'"):
        ledger.check_resume(spark, home, {"data": "2", "model": "m", "epochs": "2"})
    steps = spark.createDataFrame([(k, k == 23) for k in range(24)], "step int, last boolean")
    assert [r.step for r in ledger.periodic(steps, "step", 10, "last").collect()] == [0, 10, 20, 23]


def test_empty_batches_and_reruns(spark, tmp_path, rows):
    home, one = str(tmp_path / "l"), spark.createDataFrame([("a", 1)], S)
    assert ledger.read(spark, home) is None
    ledger.apply_once(one, 0, home, "id")
    ledger.apply_once(one, 1, home, "id")  # brings nothing new
    ledger.apply_once(spark.createDataFrame([("b", 2)], S), 2, home, "id")
    ledger.apply_once(spark.createDataFrame([("b", 3)], S), 2, home, "id")  # the same batch again
    assert rows(ledger.read(spark, home), "id", "n") == [("a", 1), ("b", 3)]


def test_ledger_applies_once_and_resumes(spark, tmp_path, rows):
    src = tmp_path / "in"
    src.mkdir()
    spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3)], S).coalesce(1).write.parquet(str(src / "p0"))
    stream = lambda: spark.readStream.schema(S).option("recursiveFileLookup", True).parquet(str(src))
    home, ck = str(tmp_path / "ledger"), str(tmp_path / "ck")
    ledger.run(stream(), home, ck, "id")
    assert rows(ledger.read(spark, home), "id", "n") == [("a", 1), ("b", 2)]
    spark.createDataFrame([("b", 9), ("c", 3)], S).coalesce(1).write.parquet(str(src / "p1"))
    ledger.run(stream(), home, ck, "id")
    assert rows(ledger.read(spark, home), "id", "n") == [("a", 1), ("b", 2), ("c", 3)]
    ledger.apply_once(spark.createDataFrame([("b", 9), ("c", 3)], S), 1, home, "id")  # a replayed batch
    assert ledger.read(spark, home).count() == 3
    todo = ledger.todo(spark.createDataFrame([("a", 0), ("z", 0)], S), ledger.read(spark, home), "id")
    assert rows(todo) == [("z", 0)]
    assert ledger.rebuilt(spark.createDataFrame([("a",), ("z",)], "id string"), ledger.read(spark, home), "id", ["n"]).count() == 2
