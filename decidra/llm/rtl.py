"""RTL texts of decision and batch records as classes of equal shingle sets.

The RTL of an id is the non-empty ``buggy_rtl`` of its batch rows or the RTL
inside its ``state`` (an object, an array, a re-encoded string or bare RTL).
Comments, case and layout do not count: a text is its set of runs of
``SHINGLE`` consecutive tokens.  Ids with equal sets form one class, so exact
copies never meet in a join; pairs are searched between classes only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decidra.llm import textkernel as K
from decidra.session import drop_scratch, scratch

SHINGLE = 3
LIKENESS = 0.7
#: Rows of a Python batch of texts with their shingles.
ROWS = 2000
#: Most class numbers that are broadcast (about 16 bytes each).
MOST_SENT = 1_000_000


def rtl_of_state(state: str | None) -> str | None:
    """The RTL inside a state text, or None.

    JSON is decoded as often as it was encoded; of an array the first element
    with RTL counts; a text that is no JSON is RTL itself.
    """
    if state is None:
        return None
    try:
        return _rtl_in(state)
    except RecursionError:  # a tree too deep to hold RTL where it belongs
        return None


def _rtl_in(value: object) -> str | None:
    while isinstance(value, str):
        try:
            value = json.loads(value)  # a string in JSON is longer than what it holds, so this ends
        except ValueError:
            return value
    if isinstance(value, dict):
        found = value.get("buggy_rtl")
        return found if isinstance(found, str) else None
    if isinstance(value, list):
        return next((x for x in map(_rtl_in, value) if x and x.strip()), None)
    return None


def normalised(text: str, cased: bool = False) -> str:
    """Text without comments, in lower case unless cased, blanks collapsed: the tokens stay as they are."""
    text = K.strip_comments(text)
    return " ".join((text if cased else text.lower()).split())


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _rtl_rows(from_state: bool, cased: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, texts = [], []
                for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = rtl_of_state(raw) if from_state else raw
                    if i is not None and text and not text.isspace():
                        ids.append(i)
                        texts.append(normalised(text, cased))
                sets = K.shingle_sets(texts, SHINGLE, symbols=True)
                keep = [j for j, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[j] for j in keep], pa.string()),
                        pa.array([set_id(sets[j]) for j in keep], pa.binary()),
                        pa.array([len(sets[j]) for j in keep], pa.int32()),
                        pa.array([texts[j] for j in keep], pa.string()),
                    ],
                    names=["id", "sid", "n", "text"],
                )

    return run


@dataclass
class RtlClasses:
    """members: distinct (id, sid). classes: one row (cid, sid, n, text) for each different shingle set."""

    members: DataFrame
    classes: DataFrame


def rtl_rows(records: DataFrame, batches: DataFrame, cased: bool = False) -> DataFrame:
    """(id, sid, n, text) of every row with RTL, the text in lower case unless cased; null ids, null, empty and too short texts yield none."""
    schema = "id string, sid binary, n int, text string"
    return (
        records.select(F.col("id").cast("string").alias("id"), F.col("state").alias("text"))
        .mapInArrow(_rtl_rows(True, cased), schema)
        .unionByName(batches.select(F.col("id").cast("string").alias("id"), F.col("buggy_rtl").alias("text")).mapInArrow(_rtl_rows(False, cased), schema))
    )


def rtl_classes(records: DataFrame, batches: DataFrame, restrict: DataFrame | None = None) -> RtlClasses:
    """Classes of the RTL of both tables; with restrict (id), only the classes of those ids.

    Each text is parsed once: the rows are written to the shared folder, members
    read back two narrow columns and classes one text per set.
    """
    rows = scratch(rtl_rows(records, batches), "rtl-rows")
    members = rows.select("id", "sid").distinct()
    if restrict is not None:
        members = members.join(restrict.select("id").distinct(), "id", "left_semi")
    members = scratch(members, "rtl-members")
    wanted = members.select("sid").distinct()
    by_set = rows.groupBy("sid").agg(F.first("n").alias("n"), F.first("text").alias("text"))
    if restrict is not None:
        by_set = by_set.join(wanted, "sid", "left_semi")
    classes = scratch(by_set.withColumn("cid", F.monotonically_increasing_id()), "rtl-classes")
    drop_scratch(rows)
    return RtlClasses(members, classes)


def _verify(likeness: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = batch.column("text_a").to_pylist() + batch.column("text_b").to_pylist()
                place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
                sets = K.shingle_sets(list(place), SHINGLE, symbols=True)
                n = batch.num_rows
                sims = [K.jaccard(sets[place[texts[i]]], sets[place[texts[n + i]]]) for i in range(n)]
                keep = pa.array([s >= likeness for s in sims], pa.bool_())
                out = pa.RecordBatch.from_arrays([batch.column("cid_a"), batch.column("cid_b"), pa.array(sims, pa.float64())], names=["cid_a", "cid_b", "likeness"])
                yield out.filter(keep)

    return run


def verified(pairs: DataFrame, classes: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """Of candidate pairs (cid_a, cid_b) those whose exact Jaccard similarity is at least likeness.

    Only texts of candidates travel: the classes are first reduced to these, by a
    broadcast of their numbers if there are at most MOST_SENT, else by a semi-join.
    """
    pairs = scratch(pairs, "pairs")
    needed = scratch(pairs.select(F.explode(F.array("cid_a", "cid_b")).alias("cid")).distinct(), "pair-ids")
    if needed.count() <= MOST_SENT:
        needed = F.broadcast(needed)
    texts = scratch(classes.select("cid", "text").join(needed, "cid", "left_semi"), "pair-texts")
    return (
        pairs.join(texts.select(F.col("cid").alias("cid_a"), F.col("text").alias("text_a")), "cid_a")
        .join(texts.select(F.col("cid").alias("cid_b"), F.col("text").alias("text_b")), "cid_b")
        .select("cid_a", "cid_b", "text_a", "text_b")
        .mapInArrow(_verify(likeness), "cid_a long, cid_b long, likeness double")
    )
