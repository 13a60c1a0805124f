import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from decidra.operators import nested

SCHEMA = "id string, questions string, gold string, provenance struct<trust_flags: array<string>, reviews: array<struct<reviewer: string, verdict: string, findings: array<struct<code: string, line: int>>>>>, node string, extra int"


def table(spark, data):
    return spark.createDataFrame([(*r, "clash", 1) for r in data], SCHEMA)


def leaves(value, path=()):
    if isinstance(value, dict):
        return [q for k, x in value.items() for q in leaves(x, (*path, k))]
    if isinstance(value, list):
        return [q for i, x in enumerate(value) for q in leaves(x, (*path, i))]
    return [(path, value)]


json_values = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(json_values, st.sampled_from([None, 2]), st.booleans())
def test_triples_are_the_leaves_of_the_parsed_text(value, indent, ascii_only):
    text = json.dumps(value, indent=indent, ensure_ascii=ascii_only)
    got = [(p, v) for p, kind, v in nested.triples(text) if kind not in ("object", "array")]
    want = [(p, None if v is None else str(v).lower() if isinstance(v, bool) else v if isinstance(v, str) else str(v)) for p, v in leaves(value)]
    assert got == want


@settings(max_examples=150, deadline=None)
@given(json_values, st.integers(0, 60))
def test_cut_texts_yield_nothing_unless_they_are_still_json(value, cut):
    text = json.dumps(value)[:cut]
    try:
        json.loads(text)
        valid = True
    except ValueError:
        valid = False
    assert (nested.triples(text) is not None) == valid


@pytest.mark.parametrize("text", ["", " ", "{", "[1,]", '{"a":}', '{"a" 1}', "{,}", "[1 2]", "nul", "01", '"a', "{}{}", "]", ":", "NaN", '{"a":1,}'])
def test_invalid_texts(text):
    assert nested.triples(text) is None


def test_children_of_all_shapes(spark, rows):
    keyed = {"q1": {"type": "choice", "criteria": {"a": "x", "b": None}}, "q2": {"criteria": ["low", "high"]}, "q3": {"criteria": [{"key": "k", "text": "t"}]}, "q4": {}, "q5": None, "q6": {"criteria": {}}}
    listed = [{"qid": "q1", "probabilities": {"a": 0.5, "b": 0.5}}, {"qid": "q2", "probabilities": [{"option": "o", "p": 1}]}, {"probabilities": {"lost": 1}}]
    prov = (["f", "g"], [("r", "v", [("c", 1), ("d", 2)]), ("s", None, None), ("t", "v", [])])
    data = [
        ("a", json.dumps(keyed), json.dumps(json.dumps(listed)), prov),
        ("a", json.dumps(keyed), json.dumps(json.dumps(listed)), prov),  # delivered twice
        ("a", None, "{}", None),
        ("b", json.dumps(keyed)[:-1], "null", ([], None)),
        ("c", json.dumps(json.dumps(json.dumps({"q": {"criteria": json.dumps({"z": 1})}}))), "", (None, [])),
        (None, json.dumps(keyed), None, None),
    ]
    got = rows(nested.child_rows(nested.flatten_decisions(table(spark, data), values=False)))
    want = [("a", "question", "", f"q{i}") for i in range(1, 7)]
    want += [("a", "criterion", "q1", "a"), ("a", "criterion", "q1", "b"), ("a", "criterion", "q2", "0"), ("a", "criterion", "q2", "1"), ("a", "criterion", "q3", "k")]
    want += [("a", "gold", "", "q1"), ("a", "gold", "", "q2"), ("a", "probability", "q1", "a"), ("a", "probability", "q1", "b"), ("a", "probability", "q2", "o")]
    want += [("a", "trust_flag", "", "0"), ("a", "trust_flag", "", "1"), ("a", "review", "", "0"), ("a", "review", "", "1"), ("a", "review", "", "2"), ("a", "finding", "0", "0"), ("a", "finding", "0", "1")]
    want += [("c", "question", "", "q"), ("c", "criterion", "q", "z")]
    assert got == sorted(want, key=repr)


def test_tables_keep_values_and_links(spark, rows):
    gold = json.dumps({"risk": {"score": 1.5, "label": "1", "confidence": "x", "probabilities": {"0": 0.25}}})
    flat = nested.flatten_decisions(table(spark, [("a", None, gold, (None, [("r", "keep", [("c", 7)])])), ("a", None, gold, None)]))
    assert rows(nested.node_table(flat, "gold", {"score": "score:double", "label": "label:string", "confidence": "confidence:double"}, item="qid")) == [("a", "risk", 0, 1.5, "1", None)]
    assert rows(nested.node_table(flat, "probability", {"p": ":double"}, "qid", "option")) == [("a", "risk", "0", 0, 0.25)]
    assert rows(nested.node_table(flat, "finding", {"code": "code:string", "line": "line:int"}, "review", "at")) == [("a", "0", "0", 0, "c", 7)]


def test_empty_table_and_long_text(spark):
    assert nested.child_rows(nested.flatten_decisions(table(spark, []), values=False)).count() == 0
    big = json.dumps({f"q{i}": {"criteria": {"a": "x" * 50}} for i in range(20_000)})
    deep = "[" * 5000 + "]" * 5000
    got = nested.child_rows(nested.flatten_decisions(table(spark, [("a", big, deep, None)]), values=False))
    assert got.filter("node = 'question'").count() == 20_000 and got.filter("node = 'gold'").count() == 0


def test_a_hot_id_with_many_versions(spark):
    r = random.Random(0)
    data = [("hot", json.dumps({f"q{r.randint(0, 9)}": {}}), None, None) for _ in range(300)] + [("cold", json.dumps({"q": {}}), None, None)]
    got = nested.child_rows(nested.flatten_decisions(table(spark, data), values=False))
    assert got.groupBy("id").count().orderBy("id").collect()[1]["count"] == 10
    assert got.count() == got.distinct().count()


def test_lone_surrogates_do_not_fail(spark):
    got = nested.child_rows(nested.flatten_decisions(table(spark, [("a", '{"\\ud800": {}}', None, None)]), values=False))
    assert got.count() == 1


def test_columns_are_named_by_relative_path(spark):
    spec = (nested.NodeSpec("row", ("doc", "*")),)
    flat = nested.flatten(spark.createDataFrame([("a", '[{"x": {"y": 1}, "z": [5, 6]}]')], "k string, j string"), F.col("k"), {"doc": F.col("j")}, spec)
    assert flat.first().rows[0].cols == {"x.y": "1", "z.0": "5", "z.1": "6"}
