from collections import Counter

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from decidra.functions import text as tx
from decidra.operators import leakage, lineage, metrics, records, redaction, windows


def test_merged_intervals(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 8, 9), ("a", 20, 21), ("b", 1, 2)], "k string, s int, e int")
    assert rows(windows.merged_intervals(df, ["k"], "s", "e", 3)) == [("a", 1, 9, 3), ("a", 20, 21, 1), ("b", 1, 2, 1)]


def test_overlaps_against_brute_force(spark, rows):
    r = random.Random(1)
    mk = lambda n: [(r.choice("xy"), i, s := r.randint(0, 200), s + r.randint(0, 60)) for i in range(n)]
    a, b = mk(40), mk(40)
    got = windows.overlaps(spark.createDataFrame(a, "k string, i int, a_start int, a_end int"), spark.createDataFrame(b, "k string, j int, b_start int, b_end int"), ["k"], 25)
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted(map(tuple, got.select("i", "j").collect())) == want


def test_greedy_chunks_against_a_loop(spark):
    r = random.Random(2)
    data = [(r.choice("abc"), i, r.randint(1, 60)) for i in range(200)]
    got = {(x.g, x.i): x.chunk for x in windows.greedy_chunks(spark.createDataFrame(data, "g string, i int, n int"), "g", "i", "n", 100, 5, 10).collect()}
    for g in "abc":
        chunk, used, k = 1, 0, 0
        for _, i, n in sorted(x for x in data if x[0] == g):
            if k and (used + n + 10 > 100 or k >= 5):
                chunk, used, k = chunk + 1, 0, 0
            used, k = used + n, k + 1
            assert got[g, i] == chunk


def test_reserved_budget_against_a_loop(spark):
    r = random.Random(3)
    data = [(r.choice("ab"), i, r.choice([None, *range(0, 90)])) for i in range(80)]
    got = {x.i: x.taken for x in windows.reserved_budget(spark.createDataFrame(data, "g string, i int, n int"), ["g"], ["i"], "n", 600, 10, 50).collect()}
    for g in "ab":
        own = sorted((i, n or 0) for h, i, n in data if h == g)
        spent = 0
        for at, (i, n) in enumerate(own):
            later = sum(min(x, 10) for _, x in own[at + 1 :])
            take = max(0, min(n, 50, 600 - later - spent))
            spent += take
            assert got[i] == take


def test_whole_groups_until(spark):
    import hashlib

    groups = [("g%d" % i, i % 4 + 1) for i in range(30)]
    got = {r.g for r in windows.whole_groups_until(spark.createDataFrame(groups, "g string, n long"), "g", "n", 0.25).filter("held_out").collect()}
    total, want = 0, set()
    for g, n in sorted(groups, key=lambda x: hashlib.sha256(x[0].encode()).hexdigest()):
        if total >= -(-sum(n for _, n in groups) // 4):
            break
        want.add(g)
        total += n
    assert got == want


def test_length_batches_hold_each_row_once(spark):
    out = windows.length_batches(spark.range(1, 101).withColumn("n", F.col("id")), "id", "n", 9, 4, 3).collect()
    assert len({r.id for r in out}) == 100 and max(sum(1 for r in out if (r.pool, r.batch) == k) for k in {(r.pool, r.batch) for r in out}) == 4


def test_components_against_union_find(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)]
    parent = list(range(61))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = {x.node: x.root for x in lineage.components(spark.range(61).select(F.col("id").alias("node")), spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in range(61)}


def test_components_of_nothing(spark):
    assert lineage.components(spark.createDataFrame([], "node long"), spark.createDataFrame([], "u long, v long")).collect() == []


def test_similar_classes_against_brute_force(spark):
    r = random.Random(5)
    base = [[f"line number {i} {j}" for j in range(12)] for i in range(6)]
    texts = []
    for i in range(60):
        ls = list(base[i % 6])
        for _ in range(r.randint(0, 6)):
            ls[r.randrange(12)] = f"changed {r.randint(0, 40)} line"
        texts.append((i, "\n".join(ls)))
    texts += [(100, None), (101, ""), (102, texts[0][1])]
    sets = lineage.line_sets(spark.createDataFrame(texts, "k int, t string"), "k", tx.stripped_lines(F.col("t"), 3))
    near = lineage.similar_classes(sets, 0.4)
    keys = {x.cls: x.k for x in sets.collect()}
    got = {tuple(sorted((keys[x.cls_a], keys[x.cls_b]))): x.jaccard for x in near.collect()}
    names = {frozenset(t.split("\n")): k for k, t in texts if t}
    want = {}
    ss = list(names)
    for i, a in enumerate(ss):
        for b in ss[i + 1 :]:
            j = len(a & b) / len(a | b)
            if j >= 0.4:
                want[tuple(sorted((names[a], names[b])))] = j
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_calibration_bins_are_open_below(spark, rows):
    df = spark.createDataFrame([(0.0,), (1e-9,), (1 / 15,), (0.99,), (1.0,)], "c double").withColumn("b", metrics.calibration_bin(F.col("c")))
    assert [r.b for r in df.orderBy("c").collect()] == [None, 1, 1, 15, 15]


def test_calibration_error_counts_all_rows(spark):
    df = spark.createDataFrame([("x", 0.0, 1.0), ("x", 0.9, 1.0), ("x", 0.9, 0.0)], "g string, confidence double, correct double")
    r = metrics.calibration_error(df, ["g"]).first()
    assert r.n == 3 and r.ece == pytest.approx(2 / 3 * 0.4)


def test_grouped_report_equals_plain_means(spark):
    df = spark.createDataFrame([("a", [0.8, 0.2], [1.0, 0.0]), ("b", [0.4, 0.6], [1.0, 0.0]), (None, [0.5, 0.5], [0.0, 1.0])], "t string, p array<double>, g array<double>")
    out = {(r.grouping, r.value): r for r in metrics.grouped_report(metrics.observations(df, F.lit("choice"), F.col("p"), F.col("g")), ["t"]).collect()}
    assert out["overall", ""].n == 3 and out["overall", ""].accuracy == pytest.approx(1 / 3)
    assert out["t", "a"].brier_score == pytest.approx(0.08) and out["t", ""].n == 1


def test_temperature_grid_prefers_the_true_temperature(spark):
    import math

    target = [1 / (1 + math.exp(-1)), 1 - 1 / (1 + math.exp(-1))]
    df = spark.createDataFrame([("q", [2.0, 0.0], target)] * 12 + [("few", [1.0, 0.0], [1.0, 0.0])], "k string, z array<double>, t array<double>")
    got = {r.k: r.temperature for r in metrics.temperature_grid(df, "k", F.col("z"), F.col("t")).collect()}
    assert got == {"q": pytest.approx(2.0), "few": 1.0}


def test_first_and_last_delivery(spark, rows):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), (None, 0, "y"), ("b", None, "z"), ("b", 5, "w")], "id string, o int, v string")
    assert rows(records.first_delivery(df, "id", ["o"])) == [("a", 1, "x"), ("b", None, "z")]
    assert rows(records.first_delivery(df, "id", ["o"], last=True)) == [("a", 2, None), ("b", 5, "w")]


def test_merge_needs_equal_keys(spark):
    a, b = spark.createDataFrame([("x", 1)], "id string, n int"), spark.createDataFrame([("y", 1)], "id string, m int")
    with pytest.raises(ValueError, match="one side only"):
        records.checked_merge(a, b, "id", ["m"])
    assert records.checked_merge(a, b.withColumn("id", F.lit("x")), "id", ["m"]).first().m == 1


def test_changed_fields_and_gates(spark, rows):
    a, b = spark.createDataFrame([("x", None, 1)], "id string, p string, q int"), spark.createDataFrame([("x", None, 2)], "id string, p string, q int")
    assert rows(records.changed_fields(a, b, "id", ["p", "q"])) == [("x", "q")]
    g = records.usage_gates(spark.createDataFrame([(True, None), (False, True)], "a boolean, b boolean"), {"one": F.col("a"), "two": F.col("b")})
    assert rows(g, "one", "two") == [(False, False), (True, False)]


def test_decisions_of_objects_only(spark):
    gold = '{"risk": {"probabilities": {"1": 0.75, "0": 0.25}, "label_source": "llm_judge"}}'
    df = spark.createDataFrame([("a", "s", gold), ("b", "s", "[]"), ("c", "s", None), ("d", "s", gold[:30])], "id string, source string, gold string")
    got = records.decisions(df).collect()
    assert [(r.id, r.qid, r["keys"], r.probabilities) for r in got] == [("a", "risk", ["0", "1"], [0.25, 0.75])]


def test_label_weights(spark):
    df = spark.createDataFrame([("llm_judge",), ("other",), (None,)], "s string")
    assert [r.w for r in df.select(records.label_weight(F.col("s")).alias("w")).collect()] == [0.25, 0.2, 0.2]


def test_line_bags_and_patches(spark, rows):
    a = spark.createDataFrame([(1, "x\nx\ny"), (2, "z")], "k int, t string")
    b = spark.createDataFrame([(1, "x\ny\ny"), (2, "z")], "k int, t string")
    assert rows(leakage.bag_difference(leakage.line_bag(a, "k", F.col("t")), leakage.line_bag(b, "k", F.col("t")), "k")) == [(1, "x", 1)]
    p = spark.createDataFrame([(1, "-old\n+new", "old\nk", "new\nk"), (2, "-none\n+new", "old", "new"), (3, "-old\n+new", "old\nk", "new\nk2")], "k int, p string, b string, a string")
    assert rows(leakage.patch_check(p, "k", F.col("p"), F.col("b"), F.col("a"))) == [(1, True, True), (2, False, False), (3, True, False)]


def test_lines_found_elsewhere(spark, rows):
    a = spark.createDataFrame([(1, "shared line\nown line x"), (2, "nothing here"), (3, None), (4, "shared line\n shared line ")], "k int, t string")
    b = spark.createDataFrame([("x", "shared line\nshared line"), ("y", "shared line"), ("z", None)], "k string, t string")
    assert rows(leakage.lines_found_in(a, "k", F.col("t"), b, F.col("t"))) == [(1, 1), (4, 1)]


def test_prefixes(spark, rows):
    docs = spark.createDataFrame([(1, "say abcde now"), (2, "abc"), (3, None)], "d int, t string")
    items = spark.createDataFrame([(7, "abcdefg"), (8, "ab"), (9, None)], "i int, t string")
    assert rows(leakage.contained_prefixes(docs, "d", F.col("t"), items, "i", F.col("t"), 5)) == [(1, 7)]
    assert rows(leakage.contained_prefixes(docs, "d", F.col("t"), items.limit(0), "i", F.col("t"), 5)) == []


def test_redaction_in_comments_only(spark):
    df = spark.createDataFrame([("assign AddTerm = 1; // AddTerm here",), (None,)], "t string")
    got = df.select(redaction.comment_redactor(["AddTerm"])("t").alias("x")).collect()
    assert got[0].x.text == "assign AddTerm = 1; // [redacted] here" and got[0].x.found == ["AddTerm"] and got[1].x.text is None


def test_token_diff(spark):
    data = [("a = b + 1;", "a = b - 1;"), (None, None), ("x " * 5000, "x " * 5001), ("output a, b;", "output a; output b;"), ("", "y")]
    df = spark.createDataFrame(data, "a string, b string")
    got = [tuple(r.x) for r in df.select(redaction.token_diff(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [(1, 0, True, "+", "-"), (0, 0, False, "", ""), (1, 0, True, "", "x"), (0, 1, False, "", ""), (1, 0, True, "", "y")]


@given(st.lists(st.sampled_from("abc;"), max_size=12), st.lists(st.sampled_from("abc;"), max_size=12))
def test_hunks_turn_one_list_into_the_other(p, q):
    hunks = redaction.edit_hunks(p, q)
    gone, come = Counter(" ".join(a for a, _ in hunks).split()), Counter(" ".join(b for _, b in hunks).split())
    assert Counter(p) - gone + come == Counter(q) and not gone - Counter(p)
    assert bool(hunks) == (p != q)
