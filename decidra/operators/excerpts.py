"""Excerpts of long files: which windows of lines to show, and how they are rendered."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from decidra.functions import text as tx

RANGES = "array<struct<start: int, end: int>>"


def choose_windows(n: int, size: int, anchors: Sequence[int], header: int = 60, most: int = 8, gap: int = 40) -> list[tuple[int, int]]:
    """At most ``most`` ranges (from 1, inclusive) of a file of n lines: its header, windows of ``size`` lines around the anchors in their order, then evenly spread ones; ranges up to ``gap`` lines apart are joined.

    A file of no lines has none; anchors outside are left out.
    """
    if n <= 0:
        return []
    around = lambda c: (max(1, c - size // 2), min(n, max(1, c - size // 2) + size - 1))
    chosen = [(1, min(n, header))]
    spread = [1 + round((n - 1) * (i + 1) / (most + 1)) for i in range(most)]
    for center in [*[a for a in anchors if 1 <= a <= n], *spread]:
        if len(chosen) >= most:
            break
        if not any(a <= center <= b for a, b in chosen):
            chosen.append(around(center))
    out: list[tuple[int, int]] = []
    for a, b in sorted(chosen):
        if out and a <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def windows_of(n: Column, size: Column, anchors: Column) -> Column:
    """``choose_windows`` as a column over (lines, window size, array of anchors); null anchors as none."""

    @F.pandas_udf(RANGES)
    def choose(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, c in batches:
            yield pd.Series([[{"start": s, "end": e} for s, e in choose_windows(int(x), int(y), [] if z is None else list(z))] for x, y, z in zip(a, b, c)])

    return choose(n, size, anchors)


def rendered(text: Column, ranges: Column) -> Column:
    """The lines of the ranges, with a banner that counts the lines left out before each and at the end."""
    ls = tx.lines(text)
    ends = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["end"]))
    block = lambda r, i: F.concat(
        F.when(r["start"] - F.get(ends, i) > 1, F.concat(F.lit("... "), (r["start"] - F.get(ends, i) - 1).cast("string"), F.lit(" lines left out ...\n"))).otherwise(F.lit("")),
        F.array_join(F.slice(ls, r["start"], r["end"] - r["start"] + 1), "\n"),
    )
    rest = F.size(ls) - F.element_at(ends, -1)
    body = F.array_join(F.transform(ranges, block), "\n")
    return F.when(rest > 0, F.concat(body, F.lit("\n... "), rest.cast("string"), F.lit(" lines left out ..."))).otherwise(body)


def overlapping(ranges: Column) -> Column:
    """Whether successive ranges of an ordered array overlap."""
    return F.exists(F.sequence(F.lit(1), F.greatest(F.size(ranges), F.lit(1))), lambda i: F.coalesce(F.get(ranges, i)["start"] <= F.get(ranges, i - 1)["end"], F.lit(False)))


def covered_lines(ranges: Column) -> Column:
    """Number of lines in ranges that don't overlap."""
    return F.aggregate(ranges, F.lit(0), lambda a, r: a + r["end"] - r["start"] + 1)
