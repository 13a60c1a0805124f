"""Problem 1: equal or nearly equal records across splits, by banded minwise hashing.

Each class of equal shingle sets gets BANDS bucket keys of BAND_ROWS minwise
hashes.  Only a train class and a validation, calibration or test class that
share BUCKETS_SHARED buckets become a candidate; candidates are verified by exact
Jaccard similarity.  A pair at the threshold 0.7 is missed with probability 7e-6,
one at 0.75 with 1e-8; one of 0.2 becomes a candidate with 3e-4.

Defined results: null ids and ids without a split of interest yield nothing;
records without RTL overlap only by their id; rows delivered twice count once;
empty tables give empty results; other columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.llm import rtl
from decidra.llm import textkernel as K
from decidra.session import drop_scratch, scratch

BANDS, BAND_ROWS, BUCKETS_SHARED = 80, 5, 2
TRAIN, HELD_OUT = "train", ("validation", "calibration", "test")

_MULTIPLIERS = (K.mix64(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)).reshape(BANDS, BAND_ROWS)


def split_of(c: Column) -> Column:
    """A split name without surrounding white space, in lower case."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys (sets x BANDS) of non-empty hash sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS), np.uint64)
    buffer = np.empty_like(flat)
    for b in range(BANDS):
        key = np.full(len(sets), np.uint64(b + 1))
        for r in range(BAND_ROWS):
            np.multiply(flat, _MULTIPLIERS[b, r], out=buffer)
            key = K.mix64(key ^ np.minimum.reduceat(buffer, starts))
        out[:, b] = key
    return out


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, rtl.ROWS):
            batch = whole.slice(at, rtl.ROWS)
            keys = band_keys(K.shingle_sets(batch.column("text").to_pylist(), rtl.SHINGLE, symbols=True))
            repeat = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64))] + [batch.column(c).take(repeat) for c in ("cid", "n", "trained", "held")], names=["band", "cid", "n", "trained", "held"])


def split_flags(records: DataFrame) -> DataFrame:
    """(id, trained, held) of the ids with a row of one of the four splits."""
    split = split_of(F.col("provenance.split"))
    return records.select(F.col("id").cast("string").alias("id"), (split == TRAIN).alias("trained"), split.isin(*HELD_OUT).alias("held")).filter("id is not null and (trained or held)").groupBy("id").agg(F.max("trained").alias("trained"), F.max("held").alias("held"))


@dataclass
class Overlaps:
    """flags (id, trained, held); links (cid_a, cid_b) between alike classes of both sides, both ways, a class with itself if it has both; sides (cid, id, trained, held)."""

    flags: DataFrame
    links: DataFrame
    sides: DataFrame


def class_overlaps(records: DataFrame, batches: DataFrame, likeness: float = rtl.LIKENESS) -> Overlaps:
    """What overlaps between train and the held-out splits, by classes of equal shingle sets."""
    flags = split_flags(records)
    found = rtl.rtl_classes(records, batches, restrict=flags)
    members = found.members.join(flags, "id")
    by_set = members.groupBy("sid").agg(F.max("trained").alias("trained"), F.max("held").alias("held"))
    classes = scratch(found.classes.join(by_set, "sid"), "split-classes")
    drop_scratch(found.classes)
    bands = scratch(classes.select("cid", "n", "trained", "held", "text").mapInArrow(_bands, "band long, cid long, n int, trained boolean, held boolean"), "bands")
    a = bands.filter("trained").select("band", F.col("cid").alias("cid_t"), F.col("n").alias("n_t"))
    b = bands.filter("held").select("band", F.col("cid").alias("cid_h"), F.col("n").alias("n_h"))
    sized = F.least("n_t", "n_h") >= F.greatest("n_t", "n_h") * F.lit(likeness)
    candidates = (
        K.spread_join(a, b, "band", "cid_t", a.filter(K.part_of("cid_t")).select("band"))
        .filter((F.col("cid_t") != F.col("cid_h")) & sized)
        .groupBy(F.least("cid_t", "cid_h").alias("cid_a"), F.greatest("cid_t", "cid_h").alias("cid_b"), (F.col("cid_t") < F.col("cid_h")).alias("way"))
        .agg(F.count("*").alias("shared"))
        .filter(F.col("shared") >= BUCKETS_SHARED)
        .select("cid_a", "cid_b")
        .distinct()
    )
    near = rtl.verified(candidates, classes, likeness).select("cid_a", "cid_b")
    within = classes.filter("trained and held").select(F.col("cid").alias("cid_a"), F.col("cid").alias("cid_b"))
    links = scratch(near.unionByName(within), "split-links")
    sides = scratch(members.join(classes.select("sid", "cid"), "sid").select("cid", "id", "trained", "held"), "split-members")
    for done in (bands, classes, found.members):  # nothing below reads them
        drop_scratch(done)
    both_ways = links.unionByName(links.filter("cid_a <> cid_b").select(F.col("cid_b").alias("cid_a"), F.col("cid_a").alias("cid_b")))
    return Overlaps(flags, both_ways, sides)


def cross_split_pairs(records: DataFrame, batches: DataFrame, likeness: float = rtl.LIKENESS) -> DataFrame:
    """(id_a, id_b), id_a <= id_b: ids of both sides of the train boundary with likeness, and ids on both sides."""
    found = class_overlaps(records, batches, likeness)
    pairs = (
        found.links.join(found.sides.filter("trained").select(F.col("cid").alias("cid_a"), F.col("id").alias("id_t")), "cid_a")
        .join(found.sides.filter("held").select(F.col("cid").alias("cid_b"), F.col("id").alias("id_h")), "cid_b")
        .filter("id_t <> id_h")
        .select(F.least("id_t", "id_h").alias("id_a"), F.greatest("id_t", "id_h").alias("id_b"))
    )
    on_both = found.flags.filter("trained and held").select(F.col("id").alias("id_a"), F.col("id").alias("id_b"))
    return pairs.unionByName(on_both).distinct()


def partners(found: Overlaps) -> DataFrame:
    """(id, n): for each held-out id how many train ids are alike, itself included if it is on both sides; ids without any are left out.

    No pair of ids is made: train ids are counted by class, and a class counts the
    classes it is linked to.  Only ids that stand in several classes, whose counts
    would not add up, go one by one.
    """
    several = scratch(found.sides.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").select("id"), "several-classes")
    plain, mixed = found.sides.join(several, "id", "left_anti"), scratch(found.sides.join(several, "id", "left_semi"), "mixed-members")
    counts = scratch(plain.filter("trained").groupBy("cid").agg(F.count("*").alias("t")).select(F.col("cid").alias("cid_a"), "t"), "class-counts")
    links = found.links  # cid_a: the train side, cid_b: the held-out side
    many = mixed.filter("trained").select(F.col("cid").alias("cid_a"), F.col("id").alias("other"))
    of_class = links.join(counts, "cid_a").groupBy(F.col("cid_b").alias("cid")).agg(F.sum("t").alias("t"))
    mixed_of_class = links.join(many, "cid_a").select(F.col("cid_b").alias("cid"), "other").distinct().groupBy("cid").agg(F.count("*").alias("m"))
    own = F.col("trained").cast("long")
    alone = plain.filter("held").join(of_class, "cid", "left").join(mixed_of_class, "cid", "left").select("id", (F.coalesce("t", F.lit(0)) + F.coalesce("m", F.lit(0)) - own).alias("n"))
    near = mixed.filter("held").select("id", F.col("cid").alias("cid_b")).join(links, "cid_b").select("id", "cid_a").distinct()
    sums = near.join(counts, "cid_a").groupBy("id").agg(F.sum("t").alias("n"))
    others = near.join(many, "cid_a").filter("id <> other").select("id", "other").distinct().groupBy("id").agg(F.count("*").alias("n"))
    itself = found.flags.filter("trained and held").select("id", F.lit(1).cast("long").alias("n"))
    return alone.unionByName(sums).unionByName(others).unionByName(itself).groupBy("id").agg(F.sum("n").alias("n")).filter("n > 0")


def overlap_report(records: DataFrame, batches: DataFrame, likeness: float = rtl.LIKENESS) -> DataFrame:
    """By split and source of the held-out record: its distinct ids, those with an overlap, and the pairs.

    A source that is null counts as 'unknown'.  An id delivered under several
    splits or sources counts under each of them.
    """
    rows = records.select(F.col("id").cast("string").alias("id"), split_of(F.col("provenance.split")).alias("split"), F.coalesce("source", F.lit("unknown")).alias("source")).filter("id is not null").distinct()
    held = rows.filter(F.col("split").isin(*HELD_OUT))
    return (
        held.join(partners(class_overlaps(records, batches, likeness)), "id", "left")
        .groupBy("split", "source")
        .agg(F.count("*").alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
    )
