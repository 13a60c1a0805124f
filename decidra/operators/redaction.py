"""Operators that need a callback per match or a longest common subsequence; Arrow batches in Python."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_COMMENT = re.compile(r"//[^\n]*|/\*.*?\*/", re.S)
#: What counts as a token of RTL, and hunks that only move a port's direction.
TOKEN = r"[A-Za-z_]\w*|\d+'[bhd][0-9a-fA-FxXzZ_]+|\d+|[^\s\w]"
PORT_ONLY = r"[;,]?\s*(?:output|input|inout)"
_TOKEN = re.compile(TOKEN, re.A)
_PORT = re.compile(PORT_ONLY)


def comment_redactor(names: list[str], placeholder: str = "[redacted]"):
    """A column function: the text with the names replaced inside comments only, and the sorted distinct names found."""
    pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")\b") if names else None

    @F.pandas_udf("text string, found array<string>")
    def redact(texts: pd.Series) -> pd.DataFrame:
        out, found = [], []
        for t in texts:
            seen: set[str] = set()

            def inside(m: re.Match) -> str:
                seen.update(pattern.findall(m[0]))
                return pattern.sub(placeholder, m[0])

            out.append(t if t is None or pattern is None else _COMMENT.sub(inside, t))
            found.append(sorted(seen))
        return pd.DataFrame({"text": out, "found": found})

    return redact


def edit_hunks(p: list[str], q: list[str]) -> list[tuple[str, str]]:
    """(removed, added) of each place where two token lists differ; what they begin and end with alike is set aside first, so lists of any length are compared."""
    head = 0
    while head < min(len(p), len(q)) and p[head] == q[head]:
        head += 1
    tail = 0
    while tail < min(len(p), len(q)) - head and p[-1 - tail] == q[-1 - tail]:
        tail += 1
    a, b = p[head : len(p) - tail], q[head : len(q) - tail]
    if not a or not b:
        return [(" ".join(a), " ".join(b))] if a or b else []
    return [(" ".join(a[i:j]), " ".join(b[k:n])) for kind, i, j, k, n in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if kind != "equal"]


def token_diff(a: Column, b: Column) -> Column:
    """Struct (n_edits, formatting, localised, removed, added) of the token difference of two texts; null texts as ''.

    Hunks that only move a port's direction count as formatting and are left out
    of the rest; a difference is localised if one other hunk remains.  Removed and
    added have the tokens of the remaining hunks.
    """

    @F.pandas_udf("n_edits int, formatting int, localised boolean, removed string, added string")
    def diff(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for left, right in batches:
            rows = []
            for x, y in zip(left, right):
                hunks = edit_hunks(_TOKEN.findall(x or ""), _TOKEN.findall(y or ""))
                real = [h for h in hunks if not any(_PORT.fullmatch(side) for side in h)]
                rows.append((len(real), len(hunks) - len(real), len(real) == 1, " ".join(r for r, _ in real if r), " ".join(x for _, x in real if x)))
            yield pd.DataFrame(rows, columns=["n_edits", "formatting", "localised", "removed", "added"])

    return diff(a, b)
