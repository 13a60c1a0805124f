"""Rules, judgments, replays and fingerprints on small cases, dirty ones among them."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from decidra.operators import fingerprints, metrics, replay, rules
from decidra.operators import judgments as J

RULES = (("a", "title", "red|blue", 2.0, "a colour"), ("b", "body", r"\bx\b", 1.0, "an x"), ("a", "body", "^deep", 0.5, "deep"), ("c", "lost", ".", 9.0, "no channel"))
CATS = ("a", "b", "unknown")


def test_rules_score_and_say_why(spark):
    df = spark.createDataFrame([(1, "RED", "line\nDeep x"), (2, None, None), (3, "green", "xx")], "k int, title string, body string")
    hits = rules.fired(rules.rule_table(spark, RULES), {"title": F.col("title"), "body": F.col("body")})
    t = df.select("k", hits.alias("h")).select("k", rules.scores(F.col("h"), CATS, {"title": 1.5}).alias("t"), rules.trace(F.col("h")).alias("why"), rules.strongest_channel(F.col("h"), ("title", "body")).alias("c"))
    r = {x.k: x for x in t.withColumn("p", rules.with_reserve(F.col("t"), CATS, F.lit(0.2))).collect()}
    assert r[1].t == [3.5, 1.0, 0.0] and r[1].p == pytest.approx([3.5 / 4.5 * 0.8, 1 / 4.5 * 0.8, 0.2])
    assert r[1].why == ["a: +2.0 (title: a colour)", "b: +1.0 (body: an x)", "a: +0.5 (body: deep)"] and r[1].c == "title"
    assert r[2].p == r[3].p == [0, 0, 1] and r[2].c == "none"
    totals = spark.createDataFrame([([5.0, 1.0], True), ([5.0, 3.0], True), ([2.0, 0.0], True), ([5.0, 1.0], None)], "t array<double>, ok boolean")
    assert [x[0] for x in totals.select(rules.reserve_of(F.col("t"), F.col("ok"))).collect()] == [0.05, 0.15, 0.30, 0.15]


def test_ladders_take_the_first_rule(spark):
    table = rules.rule_table(spark, (("3", "labels", "^p1$", 0.0, "P1"), ("2", "body", "leak", 0.0, "LEAK"), ("1", "labels", "p", 0.0, "P")))
    df = spark.createDataFrame([(["x", "P1"], "leak"), (["p2"], "a leak"), (["p2", None], None), (None, None)], "labels array<string>, body string")
    got = df.select(rules.priority_ladder(table, {"body": F.col("body")}, {"labels": F.col("labels")}, ("NONE", "0", "default")).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [("P1", "3", "label"), ("LEAK", "2", "text"), ("P", "1", "label"), ("NONE", "0", "default")]


def test_anchors_and_identifiers(spark):
    df = spark.createDataFrame([("k", "fix rst_core", "see data_bus and rst_core or when", "wire data_bus;\nrst_core rst_core\ndata_bus rst_core"), ("n", None, None, None)], "k string, title string, body string, text string")
    got = rules.ranked_anchors(df, "k", F.col("title"), F.col("body"), F.col("text"), ("when",)).orderBy("place").collect()
    assert [(r.line, r.ident, r.in_title, r.n) for r in got] == [(2, "rst_core", True, 3), (1, "data_bus", False, 2)]
    assert df.select(rules.visible_identifiers(F.col("body"), F.col("text"), ("when",))).collect()[0][0] == ["data_bus", "rst_core"]


def test_targets_by_type(spark):
    q = {"c": {"type": "choice", "criteria": {"x": "", "y": ""}}, "n": {"type": "noul"}, "s": {"type": "score", "criteria": ["lo", "hi"]}, "t": {"type": "other"}, "m": {"type": "noul"}, "b": {"type": "choice", "criteria": None}}
    g = {"c": {"probabilities": {"y": 1.0004}}, "n": {"probabilities": {"true": 0.5}}, "s": {"probabilities": {"0": 0.25, "1": 0.75}}, "t": {"probabilities": {"a": 1}}, "b": {"probabilities": {"a": 1}}}
    df = spark.createDataFrame([("k", json.dumps(q), json.dumps(json.dumps(g))), ("e", None, None), ("x", "[]", "{")], "id string, questions string, gold string")
    got = {r.qid: (r.outcome, r.target) for r in J.targets(df).collect()}
    assert got == {"c": ("ok", [0, 1]), "n": ("ok", [0.5, 0.5]), "s": ("ok", [0.25, 0.75]), "t": ("type", None), "m": ("no target", None), "b": ("distribution", None)}


def test_judgments_and_reviews(spark):
    S = "qid string, keys array<string>, probabilities array<double>, label string, score double, confidence double, rationale string, evidence array<string>"
    four = ["0", "1", "2", "3"]
    data = [
        ("ok", four, [0.1, 0.4, 0.4, 0.1], "1", 1.5, 0.5, "r", ["e"]),
        ("bad", four, [-0.1, 0.6, 0.4, 0.2], "3", 9.0, 1.5, " ", [" "]),
        ("keys", ["0", "1"], [0.5, 0.5], None, None, None, None, None),
        ("none", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, S)
    bad = {r.qid: r.p for r in df.select("qid", J.judgment_problems(*map(F.col, ("keys", "probabilities", "label", "confidence", "rationale", "evidence"))).alias("p")).collect()}
    assert bad == {"ok": [], "bad": ["negative", "sum", "argmax", "confidence", "rationale", "evidence"], "keys": ["keys", "label", "confidence", "rationale", "evidence"], "none": ["missing"]}
    r = {x.qid: x for x in J.reviewed(df).collect()}
    assert r["ok"].corrections == [] and r["ok"].flags == [] and r["ok"].new_score == pytest.approx(1.5)
    assert r["bad"].new_label == "1" and r["bad"].corrections == ["probabilities", "label", "score"] and r["bad"].flags == ["invalid_confidence"]
    assert r["none"].new_probabilities == [0.25] * 4


def test_small_contracts(spark, rows):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,)], "k int")
    assert rows(J.subset_chain([("b", b), ("a", a), ("b2", b)], "k")) == [("a", "b2", 1), ("b", "a", 0)]
    assert rows(J.row_counts({"a": a}, {"a": 3})) == [("a", 3, 3, True)]
    led = spark.createDataFrame([("s", True, 1), ("s", False, 9), ("t", False, 1)], "s string, lost boolean, n int")
    assert rows(J.skip_gate(led, "s", F.col("lost"), "n", 0.05)) == [("s", 10, 1, 0.1, True), ("t", 1, 0, 0.0, False)]
    text = spark.createDataFrame([('{"diff": 1, "a": "different"}',), (json.dumps(json.dumps({"patch": 1})),), (None,)], "t string")
    assert [x[0] for x in text.select(J.banned_keys(F.col("t"), ("diff", "patch"))).collect()] == [["diff"], ["patch"], []]
    kept, out = J.excluded(spark.createDataFrame([(1, True, None), (2, None, None), (3, False, "x")], "k int, m boolean, r string"), F.col("m"), F.col("r"))
    assert rows(kept, "k") == [(2,), (3,)] and rows(out, "k", "reason") == [(1, "marked as excluded")]


def test_transcripts(spark):
    df = spark.createDataFrame([("PASS\nFAIL",), ("FAIL then PASS",), ("PASS",), ("errors: 0",), ("errors: 3\nPASS",), ("PASS\nERROR x",), (None,)], "t string")
    got = [tuple(r) for r in df.select(replay.signals(F.col("t"), "PASS", "FAIL", "errors: ([0-9]+)", "ERROR").alias("s")).select("s.verdict", "s.pass_at", "s.fail_at", "s.summary", "s.error_lines").collect()]
    assert got == [("failed", 4, 9, None, 0), ("failed", 14, 4, None, 0), ("passed", 4, -1, None, 0), ("passed", 9, -1, 0, 0), ("failed", 14, 9, 3, 0), ("failed", 4, 0, None, 1), ("unknown", -1, -1, None, 0)]


def test_classes_of_pairs(spark):
    data = [
        ("v", "s1", "before", "failed"), ("v", "s1", "after", "passed"), ("v", "s2", "before", "passed"), ("u", "s1", "before", "passed"), ("u", "s1", "after", "passed"),
        ("c", "s1", "before", "compile_failed"), ("c", "s1", "after", "compile_failed"), ("f", "s1", "before", "failed"), ("f", "s1", "after", "failed"),
        ("n", "s1", "before", "timeout"), ("n", "s1", "after", "passed"), ("t", "s1", "before", "tool_missing"),
    ]
    a = spark.createDataFrame(data, "case string, backend string, side string, verdict string")
    got = {r["case"]: r["class"] for r in replay.classified(a).collect()}
    assert got == {"v": "verified", "u": "undetected", "c": "cannot build", "f": "survives", "n": "unusable", "t": "tool missing"}
    s = {r["case"]: r for r in replay.summaries(a, replay.classified(a)).collect()}
    assert s["v"].deciding == "s1" and s["v"].verdicts == {"s1": "failed", "s2": "passed"} and s["v"].verified and not s["u"].verified


def test_fingerprints(spark, tmp_path, rows):
    (tmp_path / "a.bin").write_bytes(b"x" * 3_000_000)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.bin").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in fingerprints.file_digests(spark, str(tmp_path)).collect()}
    assert got == {"a.bin": (3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest()), "b.bin": (0, hashlib.sha256(b"").hexdigest())}
    pins = spark.createDataFrame([("a.bin", got["a.bin"][1][:12]), ("b.bin", "00"), ("c.bin", "")], "name string, sha256 string")
    assert rows(fingerprints.pinned(fingerprints.file_digests(spark, str(tmp_path)), pins)) == [("a.bin", True), ("b.bin", False), ("c.bin", False)]
    ids = spark.createDataFrame([("s", "b"), ("s", "a"), ("t", "c"), (None, "d"), ("t", None)], "split string, id string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    parts = fingerprints.sorted_digest(ids, "split", "id")
    assert rows(parts) == [("none", 1, sha("d")), ("s", 2, sha("a\nb")), ("t", 1, sha("c"))]
    assert fingerprints.rolled_up(parts, "split", "sha256").first()[0] == sha(fingerprints.canonical({"none": sha("d"), "s": sha("a\nb"), "t": sha("c")}))
    texts = spark.createDataFrame([('{"b": 1, "a": {"d": "é", "c": [1, 2]}}',), ("{",), (None,)], "t string")
    assert [r[0] for r in texts.select(fingerprints.canonical_json(F.col("t"))).collect()] == ['{"a":{"c":[1,2],"d":"\\u00e9"},"b":1}', None, None]
    h = hashlib.sha256(b"a\0AA\0b\0B\0" + b'{"v":1}').hexdigest()
    assert fingerprints.content_fingerprint([("b", b"B"), ("a", b"AA")], {"v": 1}) == h
    assert fingerprints.guarded("x", sha("x")[:12]) == "x"
    with pytest.raises(ValueError):
        fingerprints.guarded("x", "0000")


def test_fitted_temperatures_find_the_valley(spark):
    import random

    r = random.Random(1)
    data = []
    for k, true in (("a", 2.0), ("b", 0.8), (None, 3.0)):
        for _ in range(60):
            z = [r.gauss(0, 3) for _ in range(r.choice([2, 4, 20]))]
            e = [2.718281828 ** ((x - max(z)) / true) for x in z]
            data.append((k, z, [x / sum(e) for x in e]))
    data += [("few", [1.0, 0.0], [1.0, 0.0])] * 3
    df = spark.createDataFrame(data, "k string, z array<double>, t array<double>")
    got = {x.k: x.temperature for x in metrics.fitted_temperatures(df, "k", F.col("z"), F.col("t")).collect()}
    assert got == pytest.approx({"a": 2.0, "b": 0.8, None: 3.0, "few": 1.0}, abs=0.006)


def test_budgets_equal_a_loop_whatever_the_parts(spark):
    import random

    from decidra.operators import windows

    r = random.Random(3)
    data = [(r.choice(["a", "a", "a", "b", None]), i, r.choice([None, 0, r.randint(1, 90)])) for i in range(200)]
    df = spark.createDataFrame(data, "g string, i int, n long")
    plain = {x.i: x.taken for x in windows.prefix_budget(df, ["g"], ["i"], "n", 700).collect()}
    kept = {x.i: x.taken for x in windows.reserved_budget(df, ["g"], ["i"], "n", 1500, 5, 40).collect()}
    for g in ("a", "b", None):
        rows = [(i, n or 0) for k, i, n in data if k == g]
        left, spent = 700, 0
        for at, (i, n) in enumerate(rows):
            assert plain[i] == min(n, max(0, left))
            left -= n
            later = sum(min(m, 5) for _, m in rows[at + 1 :])
            own = max(0, min(n, 40, 1500 - spent - later))
            assert kept[i] == own
            spent += own


def test_manifests_with_nested_members():
    from decidra.sources import readers

    text = "name: 'a: b' # note\nlist:\n  - x\n  - \"y z\"\nouter:\n  inner:\n    k: 1\n  m: 2\n# c\nlast: v\nurl: http://x\nbad line\n"
    assert readers.read_manifest(text) == {"name": "a: b", "list.0": "x", "list.1": "y z", "outer.inner.k": "1", "outer.m": "2", "last": "v", "url": "http://x"}
    assert readers.read_manifest(None) == {} and readers.read_manifest("\x00\n:::") == {}
