"""Deeply nested semi-structured records as related flat tables.

A JSON text is parsed as a stream of events into path-value-ordinal triples: the
steps from the root (member names and element positions), the value, and its
place.  ``NodeSpec`` names the repeated ancestors: a pattern of steps in which
``*`` stands for any member or element.  Triples are grouped by their deepest
repeated ancestor, and each group is pivoted into one row: the keys of the
ancestors, which keep the link to the parent, and the values below it as columns.
All triples of a record arise in one task, so grouping and pivoting need no
shuffle.

Defined results: a text that is not valid JSON as a whole yields no rows, nor do
null, empty and scalar texts; JSON re-encoded as a string is decoded, at the root
and wherever a repeated ancestor or its container is expected; null and empty
containers have no children; of a repeated member name all values are visited and
the last one of a column stands; records with a null key are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.session import scratch

_PUNCT = re.compile(r'[ \t\n\r]*([{}\[\],:"]|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)')
_BLANK = re.compile(r"[ \t\n\r]*\Z")
ROWS = 2000


def triples(text: str, again: Sequence[tuple[str, ...]] = (), base: tuple = ()) -> list[tuple[tuple, str, str | None]] | None:
    """(path, kind, value) of every member and element of a JSON text in document order; None if it is not valid JSON.

    A step of a path is a member name or an element's position.  kind is object,
    array, string, number, boolean or null.  ``again`` has the patterns of places
    at which a string that holds JSON is decoded.
    """
    out: list[tuple[tuple, str, str | None]] = []
    path: list = list(base)
    stack: list[str] = []  # open brackets; the last step of path belongs to the last of them
    pos, n = 0, len(text)
    match = _PUNCT.match
    want = "value"  # value, first (value or the closing bracket), name, first-name, colon, more, end
    while want != "end":
        m = match(text, pos)
        if m is None:
            return None
        token = m[1]
        pos = m.end()
        if want == "more":
            if token == ",":
                if stack[-1] == "[":
                    path[-1] += 1
                    want = "value"
                else:
                    want = "name"
                continue
            if token != ("]" if stack[-1] == "[" else "}"):
                return None
            stack.pop()
            path.pop()
            want = "more" if stack else "end"
            continue
        if want == "first-name" and token == "}":
            stack.pop()
            path.pop()
            want = "more" if stack else "end"
            continue
        if want in ("name", "first-name"):
            if token != '"':
                return None
            try:
                path[-1], pos = scanstring(text, pos, True)
            except ValueError:
                return None
            m = match(text, pos)
            if m is None or m[1] != ":":
                return None
            pos = m.end()
            want = "value"
            continue
        if want == "first" and token == "]":
            stack.pop()
            path.pop()
            want = "more" if stack else "end"
            continue
        # a value
        c = token[0]
        if c == "{":
            out.append((tuple(path), "object", None))
            stack.append("{")
            path.append(None)
            want = "first-name"
            continue
        if c == "[":
            out.append((tuple(path), "array", None))
            stack.append("[")
            path.append(0)
            want = "first"
            continue
        if c == '"':
            try:
                value, pos = scanstring(text, pos, True)
            except ValueError:
                return None
            here = tuple(path)
            inner = None
            if value[:1] in ("{", "[", '"', " ", "\n", "\t", "\r") and any(matches(p, here) for p in again):
                inner = triples(value, again, here)
            if inner is None:
                out.append((here, "string", value))
            else:
                out.extend(inner)
        elif c in "}],:":
            return None
        else:
            out.append((tuple(path), "null" if c == "n" else "boolean" if c in "tf" else "number", None if c == "n" else token))
        want = "more" if stack else "end"
    return out if _BLANK.match(text, pos) else None


def matches(pattern: Sequence[str], path: tuple) -> bool:
    if len(pattern) != len(path):
        return False
    for p, s in zip(pattern, path):
        if p != "*" and p != s:
            return False
    return True


@dataclass(frozen=True)
class NodeSpec:
    """A repeated ancestor: its table's name, the pattern of its path (the first step is the part), the member of an element that holds its key ('' for its position), and whether keyless elements have their position as key.

    ``parent`` says which ``*`` of the pattern, counted from 0, is the parent's key; None for a child of the record.
    """

    node: str
    pattern: tuple[str, ...]
    key: str = ""
    parent: int | None = None
    plain_by_position: bool = False

    def key_of(self, step, kind: str, members: dict[str, str | None]) -> str | None:
        if isinstance(step, str):
            return step
        if not self.key or (self.plain_by_position and kind != "object"):
            return str(step)
        return members.get(self.key)


def shape(record: dict[str, str | None], specs: Sequence[NodeSpec]) -> list[tuple[str, str, str, int, dict[str, str | None]]]:
    """The rows (node, parent key, item key, ordinal, columns) of one record, given as its JSON texts by part."""
    by_part: dict[str, list[NodeSpec]] = {}
    for s in specs:
        by_part.setdefault(s.pattern[0], []).append(s)
    rows = []
    for part, text in record.items():
        own = by_part.get(part)
        if not own or not text:
            continue
        again = {s.pattern[:i] for s in own for i in range(1, len(s.pattern) + 1)}
        found = triples(text, tuple(again), (part,))
        if not found:
            continue
        by_length = {len(s.pattern): s for s in own}  # at most one spec of a length fits a path; checked below
        same_length = len(by_length) < len(own)
        groups: dict[tuple, tuple[NodeSpec, str, dict[str, str | None], int]] = {}
        seen_in: dict[tuple, int] = {}
        lengths = sorted(by_length, reverse=True)
        for path, kind, value in found:
            at = len(path)
            for length in lengths:
                if length > at:
                    continue
                head = path[:length]
                entry = groups.get(head)
                if entry is None:
                    if length < at:
                        continue  # below something that is no node
                    spec = by_length[length] if not same_length else next((s for s in own if matches(s.pattern, head)), None)
                    if spec is None or not matches(spec.pattern, head):
                        continue
                    ordinal = seen_in[head[:-1]] = seen_in.get(head[:-1], -1) + 1
                    groups[head] = (spec, kind, {"": value} if value is not None else {}, ordinal)
                else:
                    if length == at:
                        entry[2].clear()
                        entry[2].update({"": value} if value is not None else {})
                    elif kind not in ("object", "array"):
                        entry[2][".".join(map(str, path[length:]))] = value
                break
        keys = {head: spec.key_of(head[-1], kind, members) for head, (spec, kind, members, _) in groups.items()}
        for head, (spec, _, members, ordinal) in groups.items():
            item = keys[head]
            parent: str | None = ""
            if spec.parent is not None:
                stars = [i for i, p in enumerate(spec.pattern) if p == "*"]
                parent = keys.get(head[: stars[spec.parent] + 1])
            if item is not None and parent is not None:
                rows.append((spec.node, parent, item, ordinal, members))
    return rows


def _flat(parts: Sequence[str], specs: Sequence[NodeSpec], values: bool):
    def text(xs: list[str]) -> pa.Array:
        try:
            return pa.array(xs, pa.string())
        except UnicodeEncodeError:  # lone surrogates
            return pa.array([x.encode("utf-8", "replace").decode() for x in xs], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                columns = [batch.column(p).to_pylist() for p in parts]
                starts, digests, repeats = [0], [], []
                node, parent, item, ordinal = [], [], [], []
                maps = [0]
                names, contents = [], []
                for i in range(batch.num_rows):
                    rows = shape({p: c[i] for p, c in zip(parts, columns)}, specs)
                    if not values:
                        rows = list({r[:3]: r for r in rows}.values())
                    for a, b, c, d, e in rows:
                        node.append(a)
                        parent.append(b)
                        item.append(c)
                        if values:
                            ordinal.append(d)
                            names.extend(e)
                            contents.extend(e.values())
                            maps.append(len(names))
                    starts.append(len(node))
                    keys = {"\x1f".join(r[:3]) for r in rows}
                    digests.append(int.from_bytes(hashlib.blake2b("\x1e".join(sorted(keys)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True))
                    repeats.append(len(keys) < len(rows))
                fields = [text(node), text(parent), text(item)]
                labels = ["node", "parent_key", "item_key"]
                if values:
                    filled = [x if x is not None else None for x in contents]
                    fields += [pa.array(ordinal, pa.int32()), pa.MapArray.from_arrays(pa.array(maps, pa.int32()), text(names), text(filled))]
                    labels += ["ordinal", "cols"]
                rows_array = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(fields, labels))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(digests, pa.int64()), pa.array(repeats, pa.bool_()), rows_array], names=["id", "digest", "repeats", "rows"])

    return run


def flatten(df: DataFrame, key: Column, parts: dict[str, Column], specs: Sequence[NodeSpec], values: bool = True) -> DataFrame:
    """(id, digest, repeats, rows) per record: rows are the child rows of all nodes, with their columns if values are asked for; digest is that of their distinct keys, repeats whether a key comes again."""
    extra = ", ordinal: int, cols: map<string,string>" if values else ""
    schema = f"id string, digest long, repeats boolean, rows array<struct<node: string, parent_key: string, item_key: string{extra}>>"
    narrow = df.select(key.cast("string").alias("id"), *[c.alias(p) for p, c in parts.items()]).filter("id is not null")
    return narrow.mapInArrow(_flat(list(parts), list(specs), values), schema)


def child_rows(flat: DataFrame) -> DataFrame:
    """The distinct (id, node, parent_key, item_key).

    Only records that hold a key more than once, and ids that were delivered more
    than once, go through a distinct; the others are exploded where they are.
    """
    keys = F.transform("rows", lambda r: F.struct(r["node"].alias("node"), r["parent_key"].alias("parent_key"), r["item_key"].alias("item_key")))
    flat = scratch(flat.select("id", "digest", "repeats", keys.alias("rows")), "flat")
    again = flat.groupBy("id").agg(F.count("*").alias("n"), F.bool_or("repeats").alias("repeats")).filter("n > 1 or repeats").select("id")
    once = flat.join(again, "id", "left_anti")
    more = flat.join(again, "id", "left_semi").dropDuplicates(["id", "digest"])
    return once.select("id", F.inline("rows")).unionByName(more.select("id", F.inline("rows")).distinct())


def node_table(flat: DataFrame, node: str, columns: dict[str, str], parent: str | None = None, item: str = "item") -> DataFrame:
    """One flat table: id, the parent's key under its name, the item's key, its ordinal, and the chosen columns with their types; repeated rows once.

    A value that the type can't hold is null.
    """
    one = flat.select("id", F.explode(F.filter("rows", lambda r: r["node"] == node)).alias("r"))
    picked = [F.col("r.cols")[source].try_cast(kind).alias(name) for name, (source, kind) in ((n, s.rsplit(":", 1)) for n, s in columns.items())]
    return one.select("id", *([F.col("r.parent_key").alias(parent)] if parent else []), F.col("r.item_key").alias(item), F.col("r.ordinal").alias("ordinal"), *picked).distinct()


#: The tables of a decision record.
DECISION_NODES = (
    NodeSpec("question", ("questions", "*"), key="qid"),
    NodeSpec("criterion", ("questions", "*", "criteria", "*"), key="key", parent=0, plain_by_position=True),
    NodeSpec("gold", ("gold", "*"), key="qid"),
    NodeSpec("probability", ("gold", "*", "probabilities", "*"), key="option", parent=0, plain_by_position=True),
    NodeSpec("trust_flag", ("trust_flags", "*")),
    NodeSpec("review", ("reviews", "*")),
    NodeSpec("finding", ("reviews", "*", "findings", "*"), parent=0),
)


def flatten_decisions(records: DataFrame, values: bool = True) -> DataFrame:
    """The child rows of decision records: questions and gold from their JSON, flags and reviews from provenance."""
    keep = {"ignoreNullFields": "false"}
    parts = {"questions": F.col("questions"), "gold": F.col("gold"), "trust_flags": F.to_json("provenance.trust_flags", keep), "reviews": F.to_json("provenance.reviews", keep)}
    return flatten(records, F.col("id"), parts, DECISION_NODES, values)


def _loaded(text: str | None):
    """The value of a JSON text, its numbers as text, re-encoded JSON decoded; None if it is not valid JSON as a whole, a string that holds none as it is."""
    if not text:
        return None

    def refuse(x):
        raise ValueError(x)

    try:
        value = json.loads(text, parse_int=str, parse_float=str, parse_constant=refuse)
    except ValueError:
        return None
    except RecursionError:
        value = _built(triples(text))
    return _decoded(value)


def _built(found: list[tuple[tuple, str, str | None]] | None):
    """The value that the triples of a text describe, however deep."""
    at: dict[tuple, dict | list] = {}
    root = None
    for path, kind, value in found or ():
        node = {} if kind == "object" else [] if kind == "array" else value == "true" if kind == "boolean" else value
        if kind in ("object", "array"):
            at[path] = node
        if not path:
            root = node
        elif isinstance(held := at[path[:-1]], dict):
            held[path[-1]] = node
        else:
            held.append(node)
    return root


def _decoded(value):
    inner = _loaded(value) if isinstance(value, str) and value[:1] in ("{", "[", '"', " ", "\n", "\t", "\r") else None
    return value if inner is None else inner


def _scalar(value) -> str | None:
    return value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else None


def _number(value) -> float | None:
    try:
        return float(value) if isinstance(value, str) else None
    except ValueError:
        return None


def _elements(value, key: str, plain_by_position: bool = False) -> list[tuple[str, object]]:
    """The children (key, value) of an object, or of a list whose elements carry their key."""
    if isinstance(value, dict):
        return [(k, _decoded(v)) for k, v in value.items()]
    out = []
    for i, v in enumerate(value if isinstance(value, list) else ()):
        v = _decoded(v)
        k = _scalar(v.get(key)) if isinstance(v, dict) else str(i) if plain_by_position else None
        if k is not None:
            out.append((k, v))
    return out


def _options(value) -> tuple[list[str], list[float | None]] | None:
    """Options and probabilities: by option, or in the order of the list if it has no options."""
    value = _decoded(value)
    if not isinstance(value, (dict, list)):
        return None
    found = dict(_elements(value, "option", plain_by_position=True))
    p = {k: _number(v.get("p") if isinstance(v, dict) else v) for k, v in found.items()}
    keys = list(p) if isinstance(value, list) and not any(isinstance(v, dict) for v in found.values()) else sorted(p)
    return keys, [p[k] for k in keys]


def _head(qid: str, value) -> dict:
    h = value if isinstance(value, dict) else {}
    options = _options(h.get("probabilities"))
    criteria = _decoded(h.get("criteria"))
    return {
        "qid": qid,
        "type": _scalar(h.get("type")),
        "label_source": _scalar(h.get("label_source")),
        "keys": options and options[0],
        "probabilities": options and options[1],
        "score": _number(h.get("score")),
        "label": _scalar(h.get("label")),
        "confidence": _number(h.get("confidence")),
        "criteria": [k for k, _ in _elements(criteria, "key", plain_by_position=True)] if isinstance(criteria, (dict, list)) else None,
    }


_HEADS = pa.list_(pa.struct([("qid", pa.string()), ("type", pa.string()), ("label_source", pa.string()), ("keys", pa.list_(pa.string())), ("probabilities", pa.list_(pa.float64())), ("score", pa.float64()), ("label", pa.string()), ("confidence", pa.float64()), ("criteria", pa.list_(pa.string()))]))


def _without_surrogates(value):
    if isinstance(value, str):
        return value.encode("utf-8", "replace").decode()
    if isinstance(value, list):
        return [_without_surrogates(v) for v in value]
    return {k: _without_surrogates(v) for k, v in value.items()} if isinstance(value, dict) else value


def heads_of(text: str | None) -> list[dict] | None:
    """The heads of a questions or gold text, an object keyed by question or a list whose elements carry qid; None if it is neither."""
    value = _loaded(text)
    return [_head(k, v) for k, v in _elements(value, "qid")] if isinstance(value, (dict, list)) else None


def heads(text: Column) -> Column:
    """heads_of as an array of (qid, type, label_source, keys, probabilities, score, label, confidence, criteria); keys sorted, those of plain lists in their order, criteria as they stand."""

    @F.arrow_udf("array<struct<qid: string, type: string, label_source: string, keys: array<string>, probabilities: array<double>, score: double, label: string, confidence: double, criteria: array<string>>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [heads_of(t) for t in texts.to_pylist()]
        try:
            return pa.array(found, _HEADS)
        except UnicodeEncodeError:
            return pa.array(_without_surrogates(found), _HEADS)

    return run(text)
