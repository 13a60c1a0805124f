"""Problem 7: evaluation texts inside training text, by greedy string tiling.

Document and item share seeds, runs of SEED words.  Where the item's words
covered by seeds could reach the coverage asked for, or a long run may exist, the
pair is tiled: running Karp-Rabin finds the longest matches of unmarked words,
marks them in both texts, and goes on with shorter ones down to SEED words.  A
pair is a leak if one tile has LONG_RUN words, or if the tiles together cover
COVERAGE of the item, in whatever order its passages stand.

Every document is read and cut into words once, however many items there are.  A
Bloom filter of the items' seeds, of at most 2**MOST_BITS bits, tells which
documents may share any; of these only the stretches under such seeds are kept.
Pairs are found by a join of seeds.  A leaked item shares at least ``needed`` of
its seed places; its most frequent half as many are not joined, so phrases that a
large part of the corpus holds make no pairs, and of the others a pair must share
the other half.  Items, seeds and
documents stay in tables; only the filter passes the driver.

Defined results: null and empty texts never match; items of fewer than SEED words
never match; null ids are dropped; repeated rows give one result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decidra.llm import textkernel as K
from decidra.session import scratch

SEED, LONG_RUN, COVERAGE = 5, 12, 0.6
#: The filter has BITS_PER_SEED bits for each seed of the items, between these powers of two, and PROBES of them are asked.
BITS_PER_SEED, LEAST_BITS, MOST_BITS, PROBES = 32, 16, 28, 4
#: It travels in blocks of 2 to this power bits.
BLOCK_BITS = 16
ROWS = 2000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Stands between stretches of a document; no word has this hash.
_BREAK = np.uint64(0)


def needed(words: int, coverage: float = COVERAGE, long_run: int = LONG_RUN) -> int:
    """How many of its seed places an item of so many words shares at least with a document that it leaked into."""
    return max(1, min(long_run - SEED + 1, math.ceil(coverage * words / SEED - 1e-9)))


def _spots(seeds: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield (K.mix64(seeds ^ np.uint64(0x632BE59BD9B4E019 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - bits)).astype(np.int64)


def _seeds_of(words: np.ndarray) -> np.ndarray:
    return K.run_hashes(words, np.array([0, len(words)], np.int64), SEED)[0]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            ids, texts = (c.to_pylist() for c in whole.slice(at, ROWS).columns)
            kept, words = [], []
            for a, b in K.chunks(texts):
                hashes, bounds = K.token_hashes(texts[a:b], symbols=False)
                for i in range(b - a):
                    own = hashes[bounds[i] : bounds[i + 1]]
                    if len(own) >= SEED:
                        kept.append(ids[a + i])
                        words.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "words"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seeds = [_seeds_of(np.array(w, np.int64).view(np.uint64)) for w in batch.column(1).to_pylist()]
        repeat = pa.array(np.repeat(np.arange(len(seeds)), [len(x) for x in seeds]))
        flat = np.concatenate(seeds).view(np.int64) if seeds else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(repeat), pa.array(flat)], names=["iid", "seed"])


def _filled(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, np.bool_)
        for batch in batches:
            for spot in _spots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                held[spot] = True
        blocks = np.packbits(held).reshape(-1, 1 << (BLOCK_BITS - 3))
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(blocks[i].tobytes(), 1) for i in some], pa.binary())], names=["block", "bits"])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(zlib.decompress(packed), np.uint8)
            out[k] = out[k] | own if k in out else own
    yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([x.tobytes() for x in out.values()], pa.binary())], names=["block", "bits"])


def seed_filter(seeds: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A Bloom filter of the seeds, packed, and its size as a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, count) * BITS_PER_SEED))))
    blocks = seeds.select("seed").mapInArrow(_filled(bits), "block int, bits binary").repartition("block").mapInArrow(_united, "block int, bits binary")
    out = np.zeros((1 << (bits - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for row in blocks.toArrow().to_pylist():  # a fixed number of blocks
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel(), bits


def _stretches(packed: np.ndarray, bits: int, least: int):
    """Of each document with at least so many hits the words under its hits, where they stand, and the distinct hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                ids, texts = (c.to_pylist() for c in whole.slice(at, ROWS).columns)
                out: list[list] = [[], [], [], []]
                for a, b in K.chunks(texts):
                    words, bounds = K.token_hashes(texts[a:b], symbols=False)
                    seeds, places = K.run_hashes(words, bounds, SEED)
                    left = np.arange(len(seeds))
                    for spot in _spots(seeds, bits):
                        left = left[(packed[spot[left] >> 3] >> (7 - (spot[left] & 7)).astype(np.uint8)) & 1 == 1]
                    cuts = np.searchsorted(left, places)
                    for d in np.flatnonzero(np.diff(cuts) >= least).tolist():
                        hits = left[cuts[d] : cuts[d + 1]]
                        under = np.unique((hits - places[d])[:, None] + np.arange(SEED))
                        own = words[bounds[d] + under]
                        ends = np.flatnonzero(np.diff(under) > 1) + 1
                        out[0].append(ids[a + d])
                        out[1].append(np.insert(own, ends, _BREAK).view(np.int64))
                        out[2].append(np.insert(under, ends, -1).astype(np.int32))
                        out[3].append(np.unique(seeds[hits]).view(np.int64))
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc_id", "words", "places", "hits"])

    return run


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(base)))))


def _prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, from which that of any run follows."""
    n = len(words)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * _powers(_INVERSE, n)[1:], dtype=np.uint64)))
    return sums * _powers(_BASE, n)


def _windows(prefix: np.ndarray, size: int) -> np.ndarray:
    power = np.uint64(pow(_BASE, size, 1 << 64))
    return prefix[size:] - prefix[:-size] * power


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Which windows of a size hold no marked word."""
    sums = np.concatenate(([0], np.cumsum(marked)))
    return sums[size:] == sums[:-size] if size < len(sums) else np.zeros(0, bool)


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED, doc_prefix: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(start in doc, start in item, words) of the greedy tiling, longest first; doc_prefix has the document's prefix hashes if they are known."""
    out: list[tuple[int, int, int]] = []
    n, m = len(doc), len(item)
    if min(n, m) < least:
        return out
    doc_marked, item_marked = np.zeros(n, bool), np.zeros(m, bool)
    doc_prefix = _prefix_hashes(doc) if doc_prefix is None else doc_prefix
    item_prefix = _prefix_hashes(item)
    size = max(least, min(n, m))
    while True:
        free_doc, free_item = _free(doc_marked, size), _free(item_marked, size)
        item_windows = _windows(item_prefix, size)
        doc_windows = _windows(doc_prefix, size)
        at_doc = np.flatnonzero(free_doc & np.isin(doc_windows, item_windows[free_item]))
        found = []
        if len(at_doc):
            where: dict[int, list[int]] = {}
            for j in np.flatnonzero(free_item).tolist():
                where.setdefault(int(item_windows[j]), []).append(j)
            for i in at_doc.tolist():
                for j in where[int(doc_windows[i])]:
                    if i and j and doc[i - 1] == item[j - 1] and not doc_marked[i - 1] and not item_marked[j - 1]:
                        continue  # it is part of a match that begins earlier
                    k = 0
                    while i + k < n and j + k < m and doc[i + k] == item[j + k] and not doc_marked[i + k] and not item_marked[j + k]:
                        k += 1
                    if k >= size:
                        found.append((-k, i, j))
        for k, i, j in sorted(found):
            if not doc_marked[i : i - k].any() and not item_marked[j : j - k].any():
                out.append((i, j, -k))
                doc_marked[i : i - k] = True
                item_marked[j : j - k] = True
        if size == least:
            # cut matches may have left parts that are still long enough
            if not found:
                return sorted(out, key=lambda t: (-t[2], t[0], t[1]))
        else:
            size = max(least, size // 2)


def may_leak(shared: np.ndarray, words: int, coverage: float, long_run: int) -> bool:
    """Whether the shared seed places of an item, in order, cover enough of its words or make a run that is long enough."""
    if len(shared) == 0:
        return False
    gaps = np.diff(shared)
    covered = SEED + int(np.minimum(gaps, SEED).sum())
    breaks = np.flatnonzero(gaps != 1)
    longest = int(np.diff(np.concatenate(([-1], breaks, [len(shared) - 1]))).max()) + SEED - 1
    return longest >= long_run or covered >= coverage * words


def _slices(column: pa.Array) -> list[np.ndarray]:
    """The arrays of a list column, without copies."""
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[i:j] for i, j in zip(at[:-1], at[1:])]


def _tile(coverage: float, long_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, doc, prefix, seeds = None, np.empty(0, np.uint64), None, np.empty(0, np.uint64)
        for batch in batches:
            rows: list[tuple] = []
            of_item: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            did, doc_id, iid, item_id = (batch.column(c).to_pylist() for c in ("did", "doc_id", "iid", "item_id"))
            words, places, items = (_slices(batch.column(c)) for c in ("words", "places", "item"))
            for r in range(batch.num_rows):
                if did[r] != last:
                    last, doc, prefix = did[r], words[r].view(np.uint64), None
                    seeds = np.unique(_seeds_of(doc))
                if iid[r] not in of_item:
                    item = items[r].view(np.uint64)
                    of_item[iid[r]] = item, _seeds_of(item)
                item, own = of_item[iid[r]]
                spot = np.searchsorted(seeds, own)
                spot[spot == len(seeds)] = 0
                if not len(seeds) or not may_leak(np.flatnonzero(seeds[spot] == own), len(item), coverage, long_run):
                    continue
                if prefix is None:
                    doc = doc.copy()
                    prefix = _prefix_hashes(doc)
                rows += [(last, doc_id[r], iid[r], item_id[r], len(item), int(places[r][x]), y, k) for x, y, k in tiles(doc, item, SEED, prefix)]
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.int32()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["did", "doc_id", "iid", "item_id", "item_words", "doc_start", "item_start", "words"])

    return run


def leak_tiles(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, long_run: int = LONG_RUN) -> DataFrame:
    """(did, doc_id, iid, item_id, item_words, doc_start, item_start, words): the tiles of the pairs that may be leaks; starts and lengths are in words, did and iid number the rows."""
    narrow = lambda df, key: df.select(F.col(key).cast("long").alias(key), "text").filter(f"{key} is not null and text is not null")
    known = scratch(narrow(items, "item_id").mapInArrow(_item_words, "item_id long, words array<long>").distinct().withColumn("iid", F.monotonically_increasing_id()), "leak-items")
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("words") - SEED + 1), F.lit(0)).alias("seeds"), F.coalesce(F.min(F.size("words")), F.lit(0)).alias("least")).first()
    seeds = scratch(known.select("iid", "words").mapInArrow(_item_seeds, "iid long, seed long"), "leak-seeds")
    packed, bits = seed_filter(seeds, size["seeds"])
    least = needed(size["least"], coverage, long_run)
    found = narrow(documents, "doc_id").mapInArrow(_stretches(packed, bits, least), "doc_id long, words array<long>, places array<int>, hits array<long>")
    found = scratch(found.withColumn("did", F.monotonically_increasing_id()), "leak-documents")
    hits = found.select("did", F.explode("hits").alias("seed"))
    frequent = hits.groupBy("seed").agg(F.count("*").alias("df"))
    share = F.greatest(F.lit(1), F.least(F.lit(long_run - SEED + 1), F.ceil(F.lit(coverage) * F.size("words") / SEED - F.lit(1e-9))))
    ranked = seeds.join(frequent, "seed").withColumn("r", F.row_number().over(Window.partitionBy("iid").orderBy(F.desc("df"), "seed")))
    # of the needed places half may be among the most frequent ones, which are left out; the other half must be seen
    index = ranked.join(known.select("iid", share.alias("needed"), F.ceil(share / 2).alias("wanted")), "iid").filter("r > needed - wanted").select("seed", "iid", "wanted")
    pairs = hits.join(index, "seed").groupBy("did", "iid").agg(F.count("*").alias("n"), F.first("wanted").alias("wanted")).filter("n >= wanted").select("did", "iid")
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but much work
    tiled = pairs.repartition(tasks, "did").join(found.select("did", "doc_id", "words", "places"), "did").join(known.select("iid", "item_id", F.col("words").alias("item")), "iid")
    schema = "did long, doc_id long, iid long, item_id long, item_words int, doc_start int, item_start int, words int"
    return tiled.select("did", "doc_id", "words", "places", "iid", "item_id", "item").sortWithinPartitions("did").mapInArrow(_tile(coverage, long_run), schema)


def leaks(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, long_run: int = LONG_RUN) -> DataFrame:
    """(doc_id, item_id, longest, covered, coverage) of the pairs with a tile of long_run words or enough coverage; of rows with equal ids the pair that covers most."""
    pairs = (
        leak_tiles(documents, items, coverage, long_run)
        .groupBy("did", "iid", "doc_id", "item_id")
        .agg(F.max("words").alias("longest"), F.sum("words").alias("covered"), F.max("item_words").alias("item_words"))
        .withColumn("coverage", F.col("covered") / F.col("item_words"))
        .filter((F.col("longest") >= long_run) | (F.col("coverage") >= coverage))
    )
    return pairs.groupBy("doc_id", "item_id").agg(F.max("longest").alias("longest"), F.max("covered").alias("covered"), F.max("coverage").alias("coverage"))


def long_run_leaks(documents: DataFrame, items: DataFrame, long_run: int = LONG_RUN) -> DataFrame:
    """(doc_id, item_id) of the pairs that share a run of at least long_run words."""
    return leaks(documents, items, long_run=long_run).filter(F.col("longest") >= long_run).select("doc_id", "item_id")
