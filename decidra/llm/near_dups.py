"""Problem 4: near-duplicates by token-combination prefixes.

Tokens (here: shingle hashes) are ordered from rare to frequent.  A set of n
tokens with likeness t to another may miss at most n - ceil(t n) tokens, so a
prefix of SHARED tokens more must share SHARED tokens with the partner's prefix.
For rare tokens that token alone is the signature.  Frequent tokens would give long
posting lists; for these, combinations of k tokens of one token group are
indexed, and as k - 1 tokens of a group may match without making a combination,
the prefix is extended until the sum over groups of (tokens - k + 1) reaches the
bound.  Then two likely sets share at least SHARED signatures: if over the groups
of the prefix that ends first the matching tokens made fewer, more tokens than
allowed would be missing.  Candidates are verified by exact Jaccard similarity.

The guarantee needs n large enough to make up for the k - 1 lost tokens of
each group, and combinations of huge sets would explode, so sets of at most
SHORT or more than LONG tokens are indexed by single tokens; sets that could be
partners of those are indexed both ways.  Which tokens are frequent only decides
on cost, never on results; it is counted over all classes.

Defined results: null ids, null, empty and too short RTL yield nothing; repeated
rows count once; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decidra.llm import rtl
from decidra.llm import textkernel as K
from decidra.session import drop_scratch, scratch

#: Tokens seen in more sets than PAIR_FROM are indexed as pairs, in more than TRIPLE_SHARE of all sets as triples.
PAIR_FROM, TRIPLE_FROM, TRIPLE_SHARE = 6, 200, 0.02
#: Groups of the tokens that are indexed as pairs and as triples: many small groups make few combinations, but each loses k - 1 tokens.
GROUPS = {2: 32, 3: 8}
#: Signatures that a candidate must share; prefixes are longer by as many tokens less one.
SHARED = 6
#: Counters of the frequency sketch: 2 to this power, one byte each, whatever the data.
SKETCH_BITS = 24
#: The counters travel in blocks of 2 to this power.
BLOCK_BITS = 16
LONG = 4000


def short_bound(likeness: float) -> int:
    """The least n from which n tokens cover a prefix even if each group loses k - 1 of them."""
    return math.ceil((sum((k - 1) * g for k, g in GROUPS.items()) + SHARED) / likeness) + 1


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sketch of one task's sets, as compressed blocks of counters."""
    total, waiting, held = np.zeros(1 << SKETCH_BITS, np.uint16), [], 0

    def add() -> None:
        nonlocal held
        if waiting:
            buckets, n = np.unique(np.concatenate(waiting), return_counts=True)
            total[buckets] = np.minimum(total[buckets] + n, 0xFFFF).astype(np.uint16)
            waiting.clear()
        held = 0

    for whole in batches:
        for at in range(0, whole.num_rows, rtl.ROWS):
            for s in K.shingle_sets(whole.slice(at, rtl.ROWS).column("text").to_pylist(), rtl.SHINGLE, symbols=True):
                waiting.append(_bucket(s))
                held += len(s)
            if held > 2_000_000:
                add()
    add()
    if total.any():
        blocks = total.reshape(-1, 1 << BLOCK_BITS)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([zlib.compress(b.tobytes(), 1) for b in blocks], pa.binary())], names=["block", "counts"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks added up, with counts on a logarithmic scale of one byte."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(packed), np.uint16)
            sums[k] = sums[k] + counts if k in sums else counts.astype(np.uint64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([scaled(x).tobytes() for x in sums.values()], pa.binary())], names=["block", "counts"])


def scaled(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(8 * np.log2(1.0 + counts)), 255).astype(np.uint8)


def frequency_sketch(classes: DataFrame) -> np.ndarray:
    """About how many sets have a token, by token bucket, over all classes: an array of fixed size.

    A bucket that several tokens share counts them together, so a rare token may
    pass for a more frequent one, which costs time and never a result.
    """
    schema = "block int, counts binary"
    blocks = classes.select("text").mapInArrow(_count, schema).repartition("block").mapInArrow(_merge, schema)
    out = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    for row in blocks.toArrow().to_pylist():  # a fixed number of blocks
        out[row["block"]] = np.frombuffer(row["counts"], np.uint8)
    return out.ravel()


def signatures(tokens: np.ndarray, sketch: np.ndarray, triple_from: float, likeness: float) -> np.ndarray:
    """Signatures of one sorted distinct token array."""
    n = len(tokens)
    need = min(n, n - math.ceil(likeness * n - 1e-9) + SHARED)
    count = sketch[_bucket(tokens)]
    order = np.argsort(count, kind="stable")
    ranked, count = tokens[order], count[order]
    shared = count > scaled(np.float64(1))  # a token that one set alone has can't lead to a partner
    short = short_bound(likeness)
    single, combined = n <= short / likeness or n > LONG * likeness, short < n <= LONG
    out = [K.mix64(ranked[:need][shared[:need]])] if single else []
    if combined:
        k = 1 + (count > scaled(np.float64(PAIR_FROM))).astype(np.int64) + (count > scaled(np.float64(triple_from)))
        rare = int(np.count_nonzero(k == 1))
        alone = min(rare, need)
        out.append(K.mix64(ranked[:alone][shared[:alone]] ^ np.uint64(0x5BD1E995)))
        if rare < need:
            rest, covered, held = ranked[rare:], rare, {}
            sizes = k[rare:]
            groups = ((rest >> np.uint64(7)) % np.where(sizes == 2, GROUPS[2], GROUPS[3]).astype(np.uint64)).astype(np.int64) * 4 + sizes
            end = 0
            for g, size in zip(groups.tolist(), sizes.tolist()):
                if covered >= need:
                    break
                own = held.setdefault(g, [])
                own.append(end)
                covered += len(own) >= size
                end += 1
            picks2, picks3 = [], []
            for g, own in held.items():
                (picks2 if g % 4 == 2 else picks3).extend(combinations(own, g % 4))
            for picks in (picks2, picks3):
                if picks:
                    chosen = np.sort(rest[np.array(picks)], axis=1)
                    sig = chosen[:, 0]
                    for j in range(1, chosen.shape[1]):
                        sig = K.mix64(sig) + chosen[:, j]
                    out.append(K.mix64(sig))
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0]


def _signatures(sketch: np.ndarray, triple_from: float, likeness: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rtl.ROWS):
                batch = whole.slice(at, rtl.ROWS)
                sigs = [signatures(s, sketch, triple_from, likeness) for s in K.shingle_sets(batch.column("text").to_pylist(), rtl.SHINGLE, symbols=True)]
                repeat = pa.array(np.repeat(np.arange(len(sigs)), [len(s) for s in sigs]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), batch.column("cid").take(repeat), batch.column("n").take(repeat)], names=["sig", "cid", "n"])

    return run


def near_classes(classes: DataFrame, likeness: float = rtl.LIKENESS) -> DataFrame:
    """(cid_a, cid_b, likeness) of all pairs of classes with at least that likeness."""
    sketch = frequency_sketch(classes)
    triple_from = max(TRIPLE_FROM, TRIPLE_SHARE * classes.count())
    signed = lambda df: df.select("cid", "n", "text").mapInArrow(_signatures(sketch, triple_from, likeness), "sig long, cid long, n int")
    postings = signed(classes)
    a, b = (postings.select("sig", F.col("cid").alias(f"cid_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    fewer, more = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    candidates = (
        K.spread_join(a, b, "sig", "cid_a", signed(classes.filter(K.part_of("cid"))).select("sig"))
        .filter((F.col("cid_a") < F.col("cid_b")) & (fewer >= more * F.lit(likeness)))
        .groupBy("cid_a", "cid_b")
        .agg(F.count("*").alias("shared"), F.first(F.least(F.lit(SHARED), F.ceil(fewer * F.lit(likeness) - F.lit(1e-9)))).alias("wanted"))
        .filter("shared >= wanted")
        .select("cid_a", "cid_b")
    )
    return rtl.verified(candidates, classes, likeness)


def near_duplicates(records: DataFrame, batches: DataFrame, likeness: float = rtl.LIKENESS) -> tuple[DataFrame, DataFrame]:
    """Members (cid, id) of the classes of equal sets, and links (cid_a, cid_b, likeness) between different classes."""
    found = rtl.rtl_classes(records, batches)
    members = scratch(found.members.join(found.classes.select("sid", "cid"), "sid").select("cid", "id"), "members")
    links = scratch(near_classes(found.classes, likeness), "links")
    drop_scratch(found.members)
    drop_scratch(found.classes)
    return members, links


def near_duplicate_pairs(records: DataFrame, batches: DataFrame, likeness: float = rtl.LIKENESS) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of ids with likeness, exact copies included."""
    members, links = near_duplicates(records, batches, likeness)
    a, b = (members.select(F.col("cid").alias(f"cid_{x}"), F.col("id").alias(f"id_{x}")) for x in "ab")
    near = links.select("cid_a", "cid_b").join(a, "cid_a").join(b, "cid_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).filter("id_a <> id_b")
    shared = members.groupBy("cid").agg(F.count("*").alias("size")).filter("size > 1").select(F.col("cid").alias("cid_a"))
    copies = a.join(shared, "cid_a", "left_semi").join(b.withColumnRenamed("cid_b", "cid_a"), "cid_a").filter("id_a < id_b").select("id_a", "id_b")
    return near.unionByName(copies).distinct()
