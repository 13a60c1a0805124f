"""Queries read every form and every row of their input."""

import json
from pathlib import Path

import pytest

from decidra.operators import nested, records
from decidra.plans import registry

TABLES = Path("/root/testdata/sf0.01")
here = pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")

def equal(spark, name, sql):
    import duckdb

    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    got = registry.queries()[name](spark, str(TABLES))
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in got.columns]
    norm = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    found = sorted(str([norm(x) for x in r]) for r in got.collect())
    assert found and found == sorted(str([norm(r[i]) for i in at]) for r in rel.fetchall())


@here
@pytest.mark.parametrize("name", ("training_mass", "tier_counts", "base_questions", "probability_audit", "score_expectation", "dominant_category", "temperature_grid", "option_permute", "weighted_mean", "prior_disagreement", "level_counts", "within_one_level", "skip_ledger", "contract_errors", "record_validation", "token_lengths", "jaccard_pairs", "batch_report", "field_immutability"))
def test_queries_over_all_rows_equal_their_sql(spark, name):
    equal(spark, name, registry.oracle_sql()[name])


@here
def test_no_form_of_gold_is_left_out(spark):
    """The records with heads are those whose gold is valid JSON as a whole and neither empty nor a scalar, counted with the JSON library."""
    import duckdb

    def tree(text):
        for _ in range(9):
            try:
                text = json.loads(text) if isinstance(text, str) else text
            except ValueError:
                return None
        return text

    gold = [tree(r[0]) for r in duckdb.sql(f"select gold from '{TABLES}/veribugbench_5q.parquet'").fetchall()]
    want = sum(len(g) if isinstance(g, dict) else sum(isinstance(h, dict) and h.get("qid") is not None for h in g) for g in gold if isinstance(g, (dict, list)))
    v = spark.read.parquet(f"{TABLES}/veribugbench_5q.parquet")
    assert records.decisions(v).count() == want > 0
    assert sum(isinstance(g, list) for g in gold) > 10


def test_decisions_of_all_forms(spark, rows):
    keyed = {"risk": {"type": "score", "probabilities": {"1": 0.75, "0": 0.25}, "score": 0.75, "label": "1"}, "urgency": None}
    listed = [{"qid": "risk", "type": "score", "probabilities": [{"option": "1", "p": 0.75}, {"option": "0", "p": 0.25}], "score": 0.75, "label": "1"}, {"qid": "urgency"}, {"lost": 1}]
    inside = {"risk": json.dumps(keyed["risk"] | {"probabilities": json.dumps(keyed["risk"]["probabilities"])}), "urgency": None}
    forms = [json.dumps(keyed), json.dumps(listed), json.dumps(json.dumps(keyed)), json.dumps(json.dumps(json.dumps(listed))), json.dumps(inside)]
    df = spark.createDataFrame([(str(i), "s", t, t) for i, t in enumerate(forms)], "id string, source string, gold string, questions string")
    want = sorted(x for i in range(len(forms)) for x in [(str(i), "risk", ["0", "1"], [0.25, 0.75], 0.75, "1"), (str(i), "urgency", None, None, None, None)])
    assert rows(records.decisions(df), "id", "qid", "keys", "probabilities", "score", "label") == want
    assert rows(records.question_heads(df), "id", "qid", "type") == [x for i in range(len(forms)) for x in [(str(i), "risk", "score"), (str(i), "urgency", None)]]


def test_heads_that_are_dirty():
    plain = nested.heads_of(json.dumps({"q": {"probabilities": [i / 66 for i in range(12)]}}))[0]
    assert plain["keys"] == [str(i) for i in range(12)] and plain["probabilities"][11] == 11 / 66
    assert [nested.heads_of(t) for t in (None, "", "null", '"x"', '{"q": NaN}', '{"q": {}} x', '[{"qid": "q"}')] == [None] * 7
    deep = '{"q": {"label": "a", "x": ' + "[" * 50_000 + "]" * 50_000 + "}}"
    assert [(h["qid"], h["label"]) for h in nested.heads_of(deep)] == [("q", "a")]


def test_fields_that_change_and_return(spark, tmp_path, rows):
    one = lambda i, source, split, day: (i, source, (split,), f"2025-01-0{day}")
    data = [one("a", "A", "train", 1), one("a", "B", "train", 2), one("a", "A", "train", 3), one("b", None, "test", 1), one("b", "A", "test", 2), one("c", "A", None, 1), one("c", "A", "test", 2), one("d", None, None, 1), one("d", None, None, 2)]
    spark.createDataFrame(data, "id string, source string, provenance struct<split: string>, ingested_at string").write.parquet(f"{tmp_path}/veribugbench_5q.parquet")
    assert rows(registry.queries()["field_immutability"](spark, str(tmp_path))) == [("a", "source"), ("b", "source"), ("c", "split")]
