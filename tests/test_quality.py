import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from decidra.functions import text as tx
from decidra.operators import excerpts, quality
from decidra.operators import records as R


def head(types, **change):
    q = {k: {"type": t, "instructions": "x"} for k, t in types.items()}
    q.update(change)
    return json.dumps(q)


def test_contract_errors(spark, rows):
    good = json.dumps({k: {"probabilities": {"a": 0.5, "b": 0.5}} for k in R.QUESTION_TYPES})
    bad = json.dumps({k: {"probabilities": {"a": 0.7, "b": 0.5}} if k == "risk" else {} for k in R.QUESTION_TYPES})
    data = [
        ("ok", "s", head(R.QUESTION_TYPES), good),
        ("sum", "s", head(R.QUESTION_TYPES, risk={"type": "choice"}), bad),
        (None, None, "[]", "{"),
        ("keys", "s", head({"risk": "score"}), "{}"),
    ]
    got = rows(quality.contract_errors(spark.createDataFrame(data, "id string, state string, questions string, gold string")))
    assert got == [("keys", "gold keys"), ("keys", "question keys"), ("sum", "risk: sum"), ("sum", "risk: type"), (None, "gold"), (None, "id"), (None, "question keys"), (None, "state")]


def test_ladders_flags_and_maps(spark):
    df = spark.createDataFrame([(1, None), (None, True)], "a int, b boolean")
    got = df.select(quality.flags({"one": F.col("a") == 1, "two": F.col("b")}).alias("f"), quality.fixed_pair([(F.col("b"), 0.75)], 0.25).alias("p")).collect()
    assert [r.f for r in got] == [["one"], ["two"]] and [r.p for r in got] == [{"false": 0.75, "true": 0.25}, {"false": 0.25, "true": 0.75}]
    m = spark.range(1).select(quality.extended(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(3))).alias("m")).first().m
    assert m == {"a": 1, "b": 3}
    assert spark.range(1).select(quality.excluded_by(F.lit(None).cast("array<string>"), ["x"]).alias("x")).first().x == []


def test_sets_and_partitions(spark, rows):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "c"), ("h", "a"), ("h", "a"), (None, "a"), ("h", None)], "g string, s string")
    assert rows(quality.shared_between_splits(df, "g", "s")) == [("a", "b", 1), ("a", "c", 1), ("b", "c", 1)]
    classes, base = spark.createDataFrame([(1,), (1,), (9,)], "m int"), spark.createDataFrame([(1,), (2,)], "m int")
    assert rows(quality.is_partition(classes, "m", base)) == [("in several", 1), ("unassigned", 1), ("unknown", 1)]


def test_prefix_and_self_answers(spark, rows):
    df = spark.createDataFrame([("a\nb", "a\nb\nc"), ("b", "a\nb"), (None, "a")], "x string, y string")
    assert [r.p for r in df.select(quality.is_prefix(F.col("x"), F.col("y")).alias("p")).collect()] == [True, False, None]
    p = spark.createDataFrame([(1, "+assign value = 1;\n+// comment line here", "set assign value = 1; please // comment line here")], "k int, p string, b string")
    assert rows(quality.self_answering(p, "k", F.col("p"), F.col("b"))) == [(1, "assign value = 1;")]


def test_signals_and_levels(spark, rows):
    m = spark.createDataFrame([("f", "a", "s"), ("f", "b", "s"), ("f", "b", "t"), ("g", "c", None)], "fam string, member string, sig string")
    assert rows(quality.uniform_signals(m, "fam", "sig")) == [("f", "s", 2, True), ("f", "t", 1, False)]
    assert rows(quality.filled_levels(m, "fam", F.col("sig"), ["s", "z"])) == [("f", "s", 2), ("f", "z", 0), ("g", "s", 0), ("g", "z", 0)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 900), st.integers(1, 120), st.lists(st.integers(-5, 1000), max_size=6))
def test_windows_are_ordered_and_inside(n, size, anchors):
    w = excerpts.choose_windows(n, size, anchors)
    assert all(1 <= a <= b <= n for a, b in w) and all(x[1] < y[0] for x, y in zip(w, w[1:])) and bool(w) == (n > 0)
    assert not w or w[0][0] == 1


def test_excerpts_render_what_they_say(spark):
    r = random.Random(0)
    texts = ["\n".join(f"l{i}" for i in range(1, n + 1)) for n in (1, 5, 70, 400)]
    df = spark.createDataFrame([(t, len(t.split("\n")), [r.randint(1, 400)]) for t in texts], "t string, n int, a array<int>").withColumn("w", excerpts.windows_of(F.col("n"), F.lit(20), F.col("a")))
    for x in df.select("t", "w", excerpts.rendered(F.col("t"), F.col("w")).alias("r"), excerpts.overlapping(F.col("w")).alias("o"), excerpts.covered_lines(F.col("w")).alias("c")).collect():
        shown = [ln for ln in x.r.split("\n") if not ln.startswith("...")]
        hidden = sum(int(ln.split()[1]) for ln in x.r.split("\n") if ln.startswith("..."))
        assert shown == [ln for a, b in x.w for ln in x.t.split("\n")[a - 1 : b]] and not x.o and x.c == len(shown)
        assert hidden + len(shown) == len(x.t.split("\n"))


def test_lines_keep_inner_blank_lines(spark):
    got = spark.createDataFrame([("a\n\n",), ("\n",), ("",)], "t string").select(tx.lines(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [["a", ""], [""], [""]]
