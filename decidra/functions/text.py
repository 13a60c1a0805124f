"""Text expressions: clipping, line sets, normalisers, first-match rules. Null texts give null unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUNCATED = "\n...[truncated]"


def clip(text: Column, limit: int) -> Column:
    """NUL as blank, stripped, cut after limit characters and marked as cut; null gives ''."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "\\x00", " "), r"^\s+|\s+$", "")
    return F.when(F.length(t) > limit, F.concat(F.left(t, F.lit(limit)), F.lit(TRUNCATED))).otherwise(t)


def lines(text: Column) -> Column:
    """Lines at any line end, without the empty one that a final line end leaves."""
    return F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")


def stripped_lines(text: Column, longer_than: int = 0) -> Column:
    """Distinct stripped lines of more than longer_than characters."""
    strip = F.transform(lines(text), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_distinct(F.filter(strip, lambda x: F.length(x) > longer_than))


def without_comments(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"//[^\n]*", ""), r"(?s)/\*.*?\*/", "")


def harness_key(text: Column) -> Column:
    """Without comments, digits as N, blanks collapsed: harnesses that differ in numbers only are equal."""
    return F.regexp_replace(F.regexp_replace(without_comments(F.coalesce(text, F.lit(""))), "[0-9]+", "N"), r"\s+", " ")


def title_key(text: Column, limit: int = 120) -> Column:
    """First line, stripped, lower case, blanks collapsed, cut."""
    first = F.get(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+", ""), r"\r\n|\r|\n"), F.lit(0))
    return F.left(F.regexp_replace(F.lower(F.regexp_replace(first, r"\s+$", "")), r"\s+", " "), F.lit(limit))


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The category of the first rule (category, pattern) whose pattern occurs in the lower-cased text; null texts as ''."""
    t = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(default)
    for category, pattern in reversed(rules):
        out = F.when(t.rlike(pattern), F.lit(category)).otherwise(out)
    return out


#: Root-cause categories and their patterns, the first match wins.
ROOT_CAUSE_RULES = (
    ("security", "security"),
    ("formal_property", "assertion|property|sva|formal|counterexample|invariant"),
    ("reset_initialization", "reset|initialization|uninitialized|unknown state|x state"),
    ("timing_protocol", "timing|clock domain|cdc|handshake|protocol|race|setup|hold"),
    ("state_machine", "state machine|fsm|transition|state encoding"),
    ("syntax_compile", "syntax|compile|compilation|elaborat|l-value|lvalue"),
    ("type_width", "type error|width|bit width|signed|unsigned|cast|operator"),
    ("sequential_assignment", "blocking|non-blocking|latch|always_ff|always_comb|sequential"),
    ("combinational_logic", "combinational|arithmetic|carry|and|or|xor|logic"),
)
#: What a path says about where to look; contained parts, then endings.
PATH_RULES = (
    ("testbench", ("/dv/", "/tb/", "testbench", "/test/", "/uvm/", "verif"), ()),
    ("formal", (".sva", "/assert", "formal"), ()),
    ("constraints", ("/constraint",), (".xdc", ".sdc")),
    ("specification", ("/doc",), (".rst", ".md", ".txt")),
    ("rtl", ("/rtl/",), (".v", ".sv", ".vh", ".svh", ".vhd", ".vhdl", ".scala")),
    ("simulation", ("sim", "makefile", ".tcl"), ()),
)


def path_action(path: Column) -> Column:
    """The action that a changed file's path suggests; 'rtl' if nothing matches."""
    p = F.lower(F.regexp_replace(path, r"\\", "/"))
    out = F.lit("rtl")
    for action, parts, endings in reversed(PATH_RULES):
        hit = F.lit(False)
        for x in parts:
            hit = hit | p.contains(x)
        for x in endings:
            hit = hit | p.endswith(x)
        out = F.when(hit, F.lit(action)).otherwise(out)
    return out


def module_names(rtl: Column) -> Column:
    """Names of the modules declared at line starts."""
    return F.regexp_extract_all(rtl, F.lit(r"(?m)^[ \t]*module[ \t]+([A-Za-z_][A-Za-z0-9_]*)"), F.lit(1))


def without_lines(text: Column, boilerplate: str) -> Column:
    """The text without the lines in which the pattern occurs (case ignored)."""
    return F.array_join(F.filter(lines(text), lambda x: ~x.rlike("(?i)" + boilerplate)), "\n")


#: Fixed value: what makes a line of a log telling.
TELLING = "error|unknown module|missing|fail|fatal|mismatch"


def failure_signature(text: Column, telling: str = TELLING) -> Column:
    """Sorted distinct telling lines with source files as <src>, digits as N, blanks collapsed, lower case: how a run failed, whatever the numbers."""
    hit = F.filter(lines(text), lambda x: x.rlike("(?i)" + telling))
    norm = F.transform(hit, lambda x: F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"[A-Za-z0-9_./]+\.(svh|sv|vh|v)\b", "<src>"), "[0-9]+", "N"), r"\s+", " "))))
    return F.array_sort(F.array_distinct(norm))


def first_line_with(text: Column, pattern: str, limit: int = 200) -> Column:
    """The first line in which the pattern occurs, stripped and cut; null if none."""
    return F.left(F.trim(F.get(F.filter(lines(text), lambda x: x.rlike("(?i)" + pattern)), F.lit(0))), F.lit(limit))


def last_match_end(text: Column, pattern: str) -> Column:
    """End (characters from the start) of the last match of the pattern, or -1. The pattern must have no groups."""
    parts = F.split(text, pattern)
    return F.when(text.rlike(pattern), F.length(text) - F.length(F.element_at(parts, -1))).otherwise(F.lit(-1))


def labelled_streams(**streams: Column) -> Column:
    """'[name]' and the text of each stream that isn't blank, joined by lines."""
    named = [F.when(F.length(F.trim(F.coalesce(c, F.lit("")))) > 0, F.concat(F.lit(f"[{n}]\n"), c)) for n, c in streams.items()]
    return F.array_join(F.array_compact(F.array(*named)), "\n")


def tokens(text: Column) -> Column:
    """Words of any script and single other visible characters."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}\p{N}_]+|[^\s\p{Z}\p{L}\p{M}\p{N}_]"), F.lit(0))


def patch_lines(patch: Column, sign: str) -> Column:
    """Added ('+') or removed ('-') lines of a unified diff without their sign; file headers are left out."""
    head = sign * 3
    return F.transform(F.filter(lines(patch), lambda x: x.startswith(sign) & ~x.startswith(head)), lambda x: F.substring(x, 2, 1_000_000_000))


def hunk_ranges(patch: Column) -> Column:
    """(start, end) in the old file of each hunk of a unified diff, inclusive, from 1."""
    starts = F.regexp_extract_all(patch, F.lit(r"(?m)^@@ -(\d+)(?:,(\d+))? "), F.lit(1))
    counts = F.regexp_extract_all(patch, F.lit(r"(?m)^@@ -(\d+)(?:,(\d+))? "), F.lit(2))
    return F.zip_with(starts, counts, lambda s, n: F.struct(s.cast("int").alias("start"), (s.cast("int") + F.greatest(F.coalesce(F.nullif(n, F.lit("")).cast("int"), F.lit(1)), F.lit(1)) - 1).alias("end")))


def top_modules(rtl: Column) -> Column:
    """Declared modules that no declaration's text instantiates, in their order; if all are, the last declared one."""
    declared = module_names(rtl)
    used = F.regexp_extract_all(rtl, F.lit(r"(?m)^[ \t]*([A-Za-z_][A-Za-z0-9_]*)[ \t]+(?:#[ \t]*\([^;]*?\)[ \t]*)?[A-Za-z_][A-Za-z0-9_]*[ \t]*\("), F.lit(1))
    roots = F.array_except(declared, F.filter(used, lambda x: x != "module"))
    return F.when(F.size(roots) > 0, roots).otherwise(F.array_compact(F.array(F.try_element_at(declared, F.lit(-1)))))
