import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from decidra.functions import dist, hashing, schedule
from decidra.functions import text as tx


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, v if not isinstance(v, (list, str, float, int)) else F.lit(v) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).cast("array<double>"))
    return df.select(column.alias("x")).first()["x"]


def test_metrics_of_the_choice_fixture(spark):
    p, g = F.col("p"), F.col("g")
    vals = {"p": [0.8, 0.2], "g": [0.7, 0.3]}
    assert one(spark, dist.correct(F.lit("choice"), p, g), **vals) == 1
    assert one(spark, dist.dot(p, g), **vals) == pytest.approx(0.62)
    assert one(spark, dist.brier(p, g), **vals) == pytest.approx(0.02)
    assert one(spark, dist.total_variation(p, g), **vals) == pytest.approx(0.1)
    assert one(spark, dist.kl(g, p), **vals) == pytest.approx(0.7 * math.log(0.7 / 0.8) + 0.3 * math.log(0.3 / 0.2))


def test_yes_no_heads_are_thresholded_at_one_half(spark):
    p, g = F.col("p"), F.col("g")
    assert one(spark, dist.correct(F.lit("noul"), p, g), p=[0.5, 0.5], g=[0.2, 0.8]) == 1
    assert one(spark, dist.correct(F.lit("choice"), p, g), p=[0.5, 0.5], g=[0.2, 0.8]) == 0


def test_normalize(spark):
    assert one(spark, dist.normalize(F.col("p")), p=[-1.0, 1.0, 3.0]) == [0.0, 0.25, 0.75]
    assert one(spark, dist.normalize(F.col("p")), p=[0.0, 0.0]) == [0.5, 0.5]
    assert one(spark, dist.normalize(F.array().cast("array<double>"))) == []
    assert one(spark, dist.normalize(F.lit(None).cast("array<double>"))) is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-2, 5), min_size=1, max_size=6))
def test_normalized_sums_to_one(spark, p):
    out = one(spark, dist.normalize(F.col("p")), p=p)
    assert sum(out) == pytest.approx(1) and min(out) >= 0


def test_ties_go_to_the_first_option(spark):
    assert one(spark, dist.argmax(F.col("p")), p=[0.2, 0.4, 0.4]) == 1
    assert one(spark, dist.argmax(F.array().cast("array<double>"))) is None


def test_one_hot_needs_mass_and_margin(spark):
    assert one(spark, dist.one_hot_or_soft(F.col("p")), p=[0.8, 0.2]) == [1.0, 0.0]
    assert one(spark, dist.one_hot_or_soft(F.col("p")), p=[0.6, 0.4]) == [0.6, 0.4]


def test_uniform_over_active_and_fallback(spark):
    keys = F.array(F.lit("a"), F.lit("b"), F.lit("abstain"))
    assert one(spark, dist.uniform_over(keys, F.array(F.lit("b"), F.lit("b"), F.lit("z")))) == [0.0, 1.0, 0.0]
    assert one(spark, dist.uniform_over(keys, F.array().cast("array<string>"))) == [0.0, 0.0, 1.0]
    assert one(spark, dist.uniform_over(F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>"))) == [0.0, 1.0]


def test_softmax_and_cross_entropy(spark):
    assert one(spark, dist.softmax(F.col("z"), F.lit(1.0)), z=[0.0, math.log(3)]) == pytest.approx([0.25, 0.75])
    assert one(spark, dist.cross_entropy(F.col("z"), F.col("t"), F.lit(1.0)), z=[0.0, math.log(3)], t=[0.0, 1.0]) == pytest.approx(-math.log(0.75))


def test_permutation(spark):
    assert one(spark, dist.permuted(F.col("p"), F.array(F.lit(2), F.lit(0), F.lit(1))), p=[0.1, 0.7, 0.2]) == [0.2, 0.1, 0.7]


def test_problems(spark):
    assert one(spark, dist.problems(F.col("p"), 1e-3), p=[-0.1, 0.9]) == ["negative", "sum"]
    assert one(spark, dist.problems(F.lit(None).cast("array<double>"), 1e-3)) == ["missing"]


def test_training_steps(spark):
    runs = spark.createDataFrame([(17, 4, 2, 4, 0), (17, 4, 2, 4, 5), (0, 4, 2, 1, 0), (None, 4, 2, 1, 0), (1, 8, 8, 3, 0)], "examples long, micro_batch int, accumulate int, epochs int, cap int")
    got = [tuple(r) for r in schedule.training_steps(runs).select("micro_batches", "updates", "steps").collect()]
    assert got == [(5, 3, 12), (5, 3, 5), (None, None, None), (None, None, None), (1, 1, 3)]


def test_warmup_cosine(spark):
    assert one(spark, schedule.warmup_cosine(F.lit(0), 100, 0.05)) == pytest.approx(0.2)
    assert one(spark, schedule.warmup_cosine(F.lit(100), 100, 0.05)) == pytest.approx(0)
    assert one(spark, schedule.warmup_cosine(F.lit(3), 0, 0.05)) == 1


def test_resume_and_temperatures(spark):
    m = lambda **kv: F.create_map(*[F.lit(x) for p in kv.items() for x in p])
    assert one(spark, schedule.config_problems(m(epochs="4", dtype="bf16"), m(epochs="5", dtype="bf16"))) == []
    assert one(spark, schedule.config_problems(m(epochs="4", dtype="bf16"), m(epochs="3", dtype="fp16"))) == ["dtype", "epochs"]
    assert one(spark, schedule.valid_temperatures(F.col("t")), t=[1.0, 0.5, 5.0]) is True
    assert one(spark, schedule.valid_temperatures(F.col("t")), t=[1.0, 0.4, 5.0]) is False


def test_stable_hashes(spark):
    import hashlib

    u = int(hashlib.sha256(b"7:family").hexdigest()[:8], 16) / 0xFFFFFFFF
    assert one(spark, hashing.stable_split(F.lit("family"), 7)) == ("train" if u < 0.7 else "validation" if u < 0.85 else "test")
    assert one(spark, hashing.stable_split(F.lit(None).cast("string"), 7)) is None
    assert one(spark, hashing.numbered_id(F.lit(7), F.lit("x"))) == "case_007_" + hashlib.sha256(b"x").hexdigest()[:8]


def test_id_set_hash_ignores_order_and_sees_changes(spark):
    h = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string").agg(hashing.id_set_hash(F.col("id")).alias("h")).first()["h"]
    assert h("abc") == h("cba") != h("abd") and len(h("a")) == 64


def test_text_rules(spark):
    assert one(spark, tx.first_match(F.lit("An Error in the TRACE"), tx.ROOT_CAUSE_RULES, "unknown")) == "timing_protocol"  # 'race' inside 'trace'
    assert one(spark, tx.first_match(F.lit(None).cast("string"), tx.ROOT_CAUSE_RULES, "unknown")) == "unknown"
    for path, action in (("hw/dv/x.sv", "testbench"), ("a\\constraint\\b.v", "rtl"), ("x/top.sdc", "constraints"), ("README.md", "specification"), ("x.sv", "rtl"), ("run.tcl", "simulation"), ("x", "rtl")):
        got = one(spark, tx.path_action(F.lit(path)))
        assert got == ("constraints" if "constraint\\" in path else action)


def test_clip_and_lines(spark):
    assert one(spark, tx.clip(F.lit(" abcdef "), 3)) == "abc" + tx.TRUNCATED
    assert one(spark, tx.clip(F.lit(None).cast("string"), 3)) == ""
    assert one(spark, tx.lines(F.lit("a\r\nb\n"))) == ["a", "b"]
    assert one(spark, tx.stripped_lines(F.lit(" aa \naa\n\nb"), 1)) == ["aa"]


def test_text_keys(spark):
    assert one(spark, tx.harness_key(F.lit("a // x\n b12 /* y\n z */ c"))) == "a bN c"
    assert one(spark, tx.title_key(F.lit("\n Fix  The Bug \nmore"))) == "fix the bug"
    assert one(spark, tx.module_names(F.lit("module a(x);\n  module b;\n// module c"))) == ["a", "b"]
    assert one(spark, tx.failure_signature(F.lit("ok\nError in rtl/x.sv line 12\nERROR in rtl/y.sv line 7"))) == ["error in <src> line N".lower()]
    assert one(spark, tx.first_line_with(F.lit("ok\n  Fatal: x "), "fatal")) == "Fatal: x"
    assert one(spark, tx.last_match_end(F.lit("PASS a PASS b"), "PASS")) == 11
    assert one(spark, tx.last_match_end(F.lit("none"), "PASS")) == -1
    assert one(spark, tx.labelled_streams(stdout=F.lit("x"), stderr=F.lit(" "))) == "[stdout]\nx"


def test_patches(spark):
    patch = "--- a/x\n+++ b/x\n@@ -3,2 +3,3 @@\n keep\n-old\n+new\n+more\n@@ -9 +10 @@\n-z"
    assert one(spark, tx.patch_lines(F.lit(patch), "+")) == ["new", "more"]
    assert one(spark, tx.patch_lines(F.lit(patch), "-")) == ["old", "z"]
    assert [tuple(r) for r in one(spark, tx.hunk_ranges(F.lit(patch)))] == [(3, 4), (9, 9)]
    assert one(spark, tx.top_modules(F.lit("module top;\n  child u1(a);\nendmodule\nmodule child(a);\nendmodule"))) == ["top"]
