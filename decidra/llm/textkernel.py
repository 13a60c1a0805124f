"""Vectorised token and shingle hashing shared by the text operators.

A batch of texts is lower-cased, laid out as one array of code points and cut
into tokens with array operations, so no Python loop runs over characters or
tokens.  Tokens hash to 64 bits; runs of tokens hash the token hashes.

Words are runs of letters, digits and underscores in any script.  With
``symbols=True`` every other visible character is a token of its own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.session import scratch

#: Keys of more rows are joined in blocks of about so many; hot keys are told from one row of PART.
HOT_ROWS, PART = 1024, 64
#: Characters laid out at once; longer texts form a batch of their own.
BATCH_CHARS = 2_000_000

_COMMENT = re.compile(r"//[^\n]*|/\*.*?(?:\*/|\Z)", re.S)

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_tables: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) over unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x += _M1
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def _char_classes() -> np.ndarray:
    """By code point: 0 blank or invisible, 1 word character, 2 other visible character."""
    if "classes" not in _tables:
        word = re.compile(r"\w")
        out = np.zeros(0x110000, dtype=np.uint8)
        for i in range(0x110000):
            if 0xD800 <= i <= 0xDFFF:
                continue
            c = chr(i)
            if word.match(c):
                out[i] = 1
            elif not c.isspace() and unicodedata.category(c) not in ("Cc", "Cf", "Cn", "Co", "Zl", "Zp", "Zs"):
                out[i] = 2
        _tables["classes"] = out
    return _tables["classes"]


def _ascii_classes() -> np.ndarray:
    if "ascii" not in _tables:
        out = np.zeros(128, dtype=np.uint8)
        for i in range(33, 127):
            out[i] = 1 if chr(i).isalnum() or chr(i) == "_" else 2
        _tables["ascii"] = out
    return _tables["ascii"]


def _powers(n: int) -> np.ndarray:
    have = _tables.get("powers")
    if have is None or len(have) < n:
        size = max(256, 1 << (max(n, 1) - 1).bit_length())
        steps = np.full(size, np.uint64(0xD6E8FEB86659FD93))
        steps[0] = 1
        have = _tables["powers"] = np.multiply.accumulate(steps)
    return have


def strip_comments(text: str) -> str:
    """``//`` and ``/* */`` comments become a blank; an unclosed ``/*`` runs to the end."""
    return _COMMENT.sub(" ", text) if "/" in text else text


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most BATCH_CHARS characters, or of one longer text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def token_hashes(texts: Sequence[str], symbols: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in order, and for each text where its tokens begin.

    The second array has one entry more than there are texts.
    """
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
    joined = "".join(lowered)
    if joined.isascii():
        cp = np.frombuffer(joined.encode("ascii"), dtype=np.uint8)
        kind = _ascii_classes()[cp]
    else:
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _char_classes()[cp]
    if not symbols:
        kind = np.where(kind == 1, kind, 0).astype(np.uint8)
    n = len(cp)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 0, kind[:-1]
    inner = ends[:-1]
    before[inner[inner < n]] = 0
    starts = np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))
    if len(starts) == 0:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = np.diff(np.append(starts, n))
    offset = np.arange(starts[0], n, dtype=np.int64) - np.repeat(starts, lengths)
    value = (cp[starts[0] :].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)
    value ^= value >> np.uint64(29)
    value *= _powers(int(lengths.max()))[offset]
    value[kind[starts[0] :] == 0] = 0
    hashes = mix64(np.add.reduceat(value, starts - starts[0]))
    return hashes, np.concatenate(([0], np.searchsorted(starts, ends, side="left"))).astype(np.int64)


def run_hashes(tokens: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k consecutive tokens within each text, and their bounds by text."""
    n = len(tokens) - k + 1
    counts = np.maximum(np.diff(bounds) - (k - 1), 0)
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    h = tokens[:n].copy()
    for j in range(1, k):
        h *= np.uint64(0xD1342543DE82EF95)
        h += tokens[j : n + j]
        h ^= h >> np.uint64(32)
    keep = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(keep, bounds[:-1][counts > 0], 1)
    np.add.at(keep, (bounds[:-1] + counts)[counts > 0], -1)
    return mix64(h[np.cumsum(keep)[:n] > 0]), np.concatenate(([0], np.cumsum(counts)))


def shingle_sets(texts: Sequence[str], k: int, symbols: bool) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of k tokens (shorter texts: empty)."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        runs, at = run_hashes(*token_hashes(texts[a:b], symbols), k)
        for i in range(b - a):
            own = np.sort(runs[at[i] : at[i + 1]])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            out.append(own)
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two sorted distinct arrays; 0 if both are empty."""
    if len(a) == 0 or len(b) == 0:
        return 0.0
    both = np.sort(np.concatenate((a, b)), kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(a) + len(b) - shared)


def part_of(number: str) -> Column:
    """Whether a row is in the part, 1 of PART by the hash of a number, from which hot keys are told."""
    return F.pmod(F.xxhash64(number, F.lit(7)), F.lit(PART)) == 0


def spread_join(a: DataFrame, b: DataFrame, key: str, spread: str, part: DataFrame) -> DataFrame:
    """The inner join of a and b on a key, a hot key's rows of a cut by the hash of spread into blocks of about HOT_ROWS rows.

    Which keys are hot is told from part, the keys of the rows of a that part_of
    chooses; it decides on the plan only, never on results.  A hot key's rows of b
    go to each of its blocks: 1 / HOT_ROWS of the pairs that the key makes anyhow.
    """
    seen = part.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") * PART > HOT_ROWS)
    blocks = scratch(seen.select(key, F.ceil(F.col("_n") * PART / HOT_ROWS).cast("int").alias("_blocks")), "hot-keys")
    if blocks.isEmpty():
        return a.join(b, key)
    left = a.join(blocks, key, "left").withColumn("_block", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_blocks")), F.lit(0)).cast("int")).drop("_blocks")
    right = b.join(blocks, key, "left").withColumn("_block", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))).drop("_blocks")
    return left.join(right, [key, "_block"]).drop("_block")
