"""Problems 1 and 4 against brute force, and their edge cases."""

import json
import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from decidra.llm import components, cross_split, near_dups, rtl
from decidra.llm import textkernel as K

RECORDS = "id string, state string, provenance struct<split: string>, source string, text string, cid int"
BATCHES = "row_no long, id string, buggy_rtl string, project string, text string"


def likeness(a, b):
    def runs(t):
        t = re.sub(r"//[^\n]*|/\*.*?\*/", " ", t, flags=re.S).lower()
        k = re.findall(r"\w+|[^\s\w]", t)
        return {tuple(k[i : i + 3]) for i in range(len(k) - 2)}

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def design(r, n=60):
    return "\n".join(f"assign s{r.randint(0, 400)} = {r.choice(['a', 'b', 'c'])}{r.randint(0, 99)} {r.choice('&|^+')} t{r.randint(0, 300)};" for _ in range(n))


def edited(r, text, edits):
    lines = text.split("\n")
    for _ in range(edits):
        lines[r.randrange(len(lines))] = f"assign s{r.randint(0, 999)} = q{r.randint(0, 999)};"
    out = "\n".join(lines)
    return r.choice([out, out.upper(), out.replace(";", " ; // note"), "/* head\n */ " + out])


def corpus(seed, families=12, size=5):
    r = random.Random(seed)
    boiler = design(r, 25)
    texts = {}
    for f in range(families):
        base = design(r) + "\n" + boiler
        for m in range(size):
            texts[f"f{f}m{m}"] = base if m == 0 else edited(r, base, r.choice([0, 1, 2, 4, 40]))
    texts["copy1"] = texts["copy2"] = texts["f0m0"]
    return texts


def frames(spark, texts, r):
    records, batches = [], []
    for i, (k, t) in enumerate(texts.items()):
        split = r.choice(["train", " Train", "validation", "TEST ", "calibration", None, "other"])
        form = r.choice(["object", "bare", "array", "twice", "batch"])
        state = {"object": json.dumps({"buggy_rtl": t, "x": 1}), "bare": t, "array": json.dumps([{"buggy_rtl": t}]), "twice": json.dumps(json.dumps({"buggy_rtl": t})), "batch": json.dumps({"buggy_rtl": ""})}[form]
        records.append((k, state, (split,), "s", "clash", 1))
        if r.random() < 0.2:
            records.append((k, state, (r.choice(["train", "test"]),), "s", "clash", 1))
        batches.append((i, k, t if form == "batch" or r.random() < 0.5 else None, "p", "clash"))
    for extra in ((None, "module x; a b c d endmodule", ("train",)), ("empty", "", ("train",)), ("nul", None, None), ("short", "a b", ("test",)), ("nosplit", list(texts.values())[0], None)):
        records.append((*extra, "s", None, None))
    batches += [(900, None, "x y z w", None, None), (901, "only", list(texts.values())[1], None, None), (902, "only", None, None, None)]
    return records, batches


@pytest.fixture(scope="module")
def case(spark):
    texts = corpus(3)
    records, batches = frames(spark, texts, random.Random(8))
    return texts, records, batches, spark.createDataFrame(records, RECORDS), spark.createDataFrame(batches, BATCHES)


def truth(texts):
    everything = {**texts, "only": list(texts.values())[1], "nosplit": list(texts.values())[0]}
    return {tuple(sorted(p)) for p in combinations(everything, 2) if likeness(everything[p[0]], everything[p[1]]) >= 0.7}


def test_near_duplicates_equal_brute_force(case):
    texts, _, _, records, batches = case
    got = {tuple(r) for r in near_dups.near_duplicate_pairs(records, batches).collect()}
    assert got == truth(texts)


def test_cross_split_equals_brute_force(case):
    texts, data, _, records, batches = case
    splits = {}
    for k, _, s, *_ in data:
        if k and s and s[0]:
            splits.setdefault(k, set()).add(s[0].strip().lower())
    train = {k for k, s in splits.items() if "train" in s}
    held = {k for k, s in splits.items() if s & {"validation", "calibration", "test"}}
    want = {(a, b) for a, b in truth(texts) if a in train and b in held or a in held and b in train} | {(k, k) for k in train & held}
    got = {tuple(r) for r in cross_split.cross_split_pairs(records, batches).collect()}
    assert got == want
    report = cross_split.overlap_report(records, batches).collect()
    assert sum(r.records for r in report) == sum(len(s & {"validation", "calibration", "test"}) for s in splits.values())


@pytest.mark.parametrize("hot", [None, 1])
def test_report_by_classes_counts_the_pairs(spark, case, monkeypatch, hot):
    """Also for ids with several texts, and with every key of the joins cut into blocks."""
    texts, _, batch_rows, records, _ = case
    if hot:
        monkeypatch.setattr(K, "HOT_ROWS", hot)
        monkeypatch.setattr(K, "PART", 1)
    r = random.Random(4)
    more = [(2000 + i, r.choice(list(texts)), r.choice(list(texts.values())), None, None) for i in range(40)]
    batches = spark.createDataFrame(batch_rows + more, BATCHES)
    pairs = [tuple(x) for x in cross_split.cross_split_pairs(records, batches).collect()]
    rows = {(x.id, x.split.strip().lower(), x.source or "unknown") for x in records.select("id", "provenance.split", "source").collect() if x.id and x.split}
    train = {i for i, s, _ in rows if s == "train"}
    want = {}
    for i, s, source in rows:
        if s in cross_split.HELD_OUT:
            n = len({b if a == i else a for a, b in pairs if i in (a, b)} & train)
            got = want.setdefault((s, source), [0, 0, 0])
            want[s, source] = [got[0] + 1, got[1] + (n > 0), got[2] + n]
    found = {(x.split, x.source): [x.records, x.overlapping, x.pairs] for x in cross_split.overlap_report(records, batches).collect()}
    assert found == want and sum(x[2] for x in want.values()) > 20
    if hot:
        assert {tuple(x) for x in near_dups.near_duplicate_pairs(records, case[4]).collect()} == truth(texts)


def test_empty_tables(spark):
    a, b = spark.createDataFrame([], RECORDS), spark.createDataFrame([], BATCHES)
    assert near_dups.near_duplicate_pairs(a, b).count() == 0
    assert cross_split.cross_split_pairs(a, b).count() == 0


def test_a_very_long_text(spark):
    r = random.Random(1)
    t = "\n".join(f"assign s{i} = t{r.randint(0, 10**6)};" for i in range(40_000))
    rows = [(f"i{k}", t.replace("s1 ", f"z{k} "), ("train" if k else "test",), "s", "", 0) for k in range(3)]
    got = near_dups.near_duplicate_pairs(spark.createDataFrame(rows, RECORDS), spark.createDataFrame([], BATCHES))
    assert got.count() == 3


def test_state_forms():
    assert rtl.rtl_of_state(None) is None and rtl.rtl_of_state("module m;") == "module m;"
    assert rtl.rtl_of_state('{"buggy_rtl": null}') is None and rtl.rtl_of_state('{"buggy_rtl": {"a": 1}}') is None
    assert rtl.rtl_of_state('[{"x": 1}, {"buggy_rtl": "r"}]') == "r" and rtl.rtl_of_state("[]") is None
    assert rtl.rtl_of_state(json.dumps(json.dumps({"buggy_rtl": "r"}))) == "r" and rtl.rtl_of_state("17") is None
    often = "[" * 3 + "\"r\"" + "]" * 3
    for _ in range(6):
        often = json.dumps(often)
    assert rtl.rtl_of_state(often) == "r" and rtl.rtl_of_state("[" * 100_000 + "]" * 100_000) is None
    twelve = json.dumps({"buggy_rtl": "r"})
    for _ in range(12):
        twelve = json.dumps(twelve)
    assert rtl.rtl_of_state(twelve) == "r"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab1_ é;(\t\n-ẞ中 ", max_size=30), min_size=1, max_size=6))
def test_tokens_equal_the_pattern(texts):
    hashes, bounds = K.token_hashes(texts, symbols=True)
    names = {}
    for i, t in enumerate(texts):
        want = re.findall(r"\w+|[^\s\w]", t.lower())
        own = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(own) == len(want)
        for h, w in zip(own, want):
            assert names.setdefault(h, w) == w


def test_long_words_and_blank_batches():
    h, b = K.token_hashes(["", " \n", "x" * 3000 + " y", ""], symbols=False)
    assert b.tolist() == [0, 0, 0, 2, 2] and len(set(h.tolist())) == 2
    assert K.token_hashes([], symbols=False)[1].tolist() == [0]
    assert K.shingle_sets(["a b", "a b c"], 3, True)[0].size == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([5, 20, 60, 79, 90, 111, 130, 300]), st.sampled_from(["rare", "mixed", "hot"]))
def test_likely_sets_share_enough_signatures(seed, n, kind):
    """Whatever the frequencies, two sets over the threshold share the signatures that are asked for."""
    r = np.random.default_rng(seed)
    sketch = np.full(1 << near_dups.SKETCH_BITS, near_dups.scaled(np.float64(2)), np.uint8)
    pool = np.unique(r.integers(0, 1 << 63, 3 * n, dtype=np.uint64))
    level = {"rare": [2], "mixed": [2, 5, 20, 90, 3000], "hot": [90, 3000]}[kind]
    sketch[near_dups._bucket(pool)] = near_dups.scaled(r.choice(level, len(pool)).astype(np.float64))
    a = pool[:n]
    drop = int(n * 0.3 * r.random())
    b = np.concatenate((a[drop:], pool[n : n + int(drop * r.random())])) if drop else a
    a, b = np.sort(a), np.sort(b)
    j = K.jaccard(a, b)
    if j < 0.7:
        return
    x, y = (near_dups.signatures(s, sketch, 1000.0, 0.7) for s in (a, b))
    wanted = min(near_dups.SHARED, int(np.ceil(min(len(a), len(b)) * 0.7 - 1e-9)))
    assert len(np.intersect1d(x, y)) >= wanted


def test_components_grow_and_merge(spark):
    edges = lambda *e: spark.createDataFrame(list(e), "u string, v string")
    one, new = components.extend(None, edges(("b", "c"), ("c", "d"), ("x", "x"), (None, "q")))
    assert {tuple(r) for r in one.table().collect()} == {("b", "b"), ("c", "b"), ("d", "b"), ("x", "x"), ("q", "q")} and new.count() == 5
    two, new = components.extend(one, edges(("d", "a"), ("x", "y")))
    assert {tuple(r) for r in two.table().collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "x"), ("q", "q")}
    assert {r.node for r in new.collect()} == {"a", "y"}
    path, _ = components.extend(None, edges(*[(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)]))
    assert path.table().select("root").distinct().count() == 1
