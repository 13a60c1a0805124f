"""Rules as data: weighted patterns over evidence channels, priority ladders, and why each fired.

A rule table has the columns category, channel, pattern, weight and why; its
order is that of the column ``rank``.  Rule tables are small dimensions: they
are read once, refused beyond MOST_RULES, and become one array expression with
literal patterns, so scoring is a projection without a join or a shuffle.

Defined results: null channel texts count as ''; a pattern is searched for
without regard to case, in every line; rules of a channel that a table lacks
never fire; null weights count as 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rules of one table; a plan holds an expression per rule.
MOST_RULES = 2000
RULE_SCHEMA = "rank int, category string, channel string, pattern string, weight double, why string"
FIRED = "array<struct<category: string, channel: string, weight: double, why: string>>"


def rule_table(spark: SparkSession, rows: Sequence[tuple[str, str, str, float, str]]) -> DataFrame:
    """(rank, category, channel, pattern, weight, why) in the order given."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RULE_SCHEMA)


def read_rules(rules: DataFrame) -> list[T.Row]:
    """The rules in their order; more than MOST_RULES are refused."""
    found = rules.orderBy("rank").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return found


def fired(rules: DataFrame, channels: dict[str, Column]) -> Column:
    """Array (category, channel, weight, why) of the rules whose pattern occurs in the text of their channel, in their order."""
    hits = [
        F.when(
            F.coalesce(channels[r["channel"]], F.lit("")).rlike("(?im)" + r["pattern"]),
            F.struct(F.lit(r["category"]).alias("category"), F.lit(r["channel"]).alias("channel"), F.lit(float(r["weight"] or 0.0)).alias("weight"), F.lit(r["why"]).alias("why")),
        )
        for r in read_rules(rules)
        if r["channel"] in channels
    ]
    return F.array_compact(F.array(*hits)).cast(FIRED) if hits else F.array().cast(FIRED)


def scores(hits: Column, categories: Sequence[str], channel_weights: dict[str, float] | None = None) -> Column:
    """The sum of the weights of the fired rules by category, in the order of categories; a channel's multiplier is 1 where none is given."""
    table = F.create_map(*[F.lit(x) for kv in (channel_weights or {"": 1.0}).items() for x in kv])
    times = lambda h: F.coalesce(F.try_element_at(table, h["channel"]), F.lit(1.0))
    total = lambda c: F.aggregate(F.filter(hits, lambda h: h["category"] == c), F.lit(0.0), lambda a, h: a + h["weight"] * times(h))
    return F.array(*map(total, categories))


def with_reserve(totals: Column, categories: Sequence[str], reserve: Column, keeper: str = "unknown") -> Column:
    """Totals as a distribution that keeps the reserve for one category; without any total all goes to it."""
    mass = F.aggregate(totals, F.lit(0.0), lambda a, x: a + x)
    at = list(categories).index(keeper)
    spread = F.transform(totals, lambda x, i: x / mass * (1 - reserve) + F.when(i == at, reserve).otherwise(0.0))
    return F.when(mass > 0, spread).otherwise(F.array(*[F.lit(float(i == at)) for i in range(len(categories))]))


#: Reserves where the evidence is weak, fair and strong, and the totals from which it is fair and strong.
LOW, MEDIUM, HIGH, FAIR, STRONG = 0.30, 0.15, 0.05, 3.0, 4.0


def reserve_of(totals: Column, confirmed: Column, low: float = LOW, medium: float = MEDIUM, high: float = HIGH, strong: float = STRONG, fair: float = FAIR) -> Column:
    """How much to keep back: little where one category stands out strongly, more where the largest total is small; at least medium where the evidence is not confirmed."""
    top = F.array_max(totals)
    rivals = F.size(F.filter(totals, lambda x: (x > 0) & (x >= top * 0.5)))
    base = F.when((rivals == 1) & (top >= strong), high).when(top >= fair, medium).otherwise(low)
    return F.when(F.coalesce(confirmed, F.lit(False)), base).otherwise(F.greatest(base, F.lit(medium)))


def trace(hits: Column) -> Column:
    """Why each rule fired, as 'category: +weight (channel: why)'."""
    return F.transform(hits, lambda h: F.concat(h["category"], F.lit(": +"), F.format_number(h["weight"], 1), F.lit(" ("), h["channel"], F.lit(": "), h["why"], F.lit(")")))


def strongest_channel(hits: Column, order: Sequence[str]) -> Column:
    """The first channel of the order in which a rule fired; 'none' without any."""
    out = F.lit("none")
    spoke = lambda c: F.exists(hits, lambda h: h["channel"] == c)
    for c in reversed(order):
        out = F.when(spoke(c), F.lit(c)).otherwise(out)
    return out


def priority_ladder(rules: DataFrame, channels: dict[str, Column], labels: dict[str, Column], default: tuple[str, str, str]) -> Column:
    """Struct (rule, level, basis) of the first rule, in the order of the table, that holds.

    A rule (category: the level, channel, pattern, why: its name) holds if its
    pattern occurs in a text channel or in any element of a label channel, an
    array of texts.  basis says by which kind of channel; default has all three.
    """
    out = F.struct(F.lit(default[0]).alias("rule"), F.lit(default[1]).alias("level"), F.lit(default[2]).alias("basis"))
    in_any = lambda texts, p: F.exists(texts, lambda x: F.coalesce(x.rlike(p), F.lit(False)))
    for r in reversed(read_rules(rules)):
        p = "(?im)" + r["pattern"]
        if r["channel"] in labels:
            holds, basis = in_any(labels[r["channel"]], p), "label"
        elif r["channel"] in channels:
            holds, basis = channels[r["channel"]].rlike(p), "text"
        else:
            continue
        found = F.struct(F.lit(r["why"]).alias("rule"), F.lit(r["category"]).alias("level"), F.lit(basis).alias("basis"))
        out = F.when(F.coalesce(holds, F.lit(False)), found).otherwise(out)
    return out


def channel_text(rows: DataFrame, by: str, channel: Column, order: Sequence[Column], text: Column) -> DataFrame:
    """(by, channel, text): the texts of each group's channel joined by lines in their order; blank texts are left out.

    A group's texts are those of one record's tool runs, which its source bounds.
    """
    parts = rows.select(by, channel.alias("channel"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], text.alias("t")).alias("x")).filter(F.length(F.trim("x.t")) > 0)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n")
    return parts.groupBy(by, "channel").agg(joined.alias("text"))


def label_source(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    """Where a label comes from: the first step whose evidence holds; null evidence doesn't."""
    out = F.lit(default)
    for holds, name in reversed(steps):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def visible_identifiers(text: Column, context: Column, stop: Sequence[str], least: int = 4) -> Column:
    """Sorted distinct identifiers of a text, stop words aside, that the context has too; null texts have none."""
    names = lambda t: F.array_distinct(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"[A-Za-z_][A-Za-z0-9_]{%d,}" % (least - 1)), F.lit(0)))
    shared = F.array_intersect(names(text), names(context))
    return F.array_sort(F.filter(shared, lambda x: ~F.lower(x).isin(*stop))) if stop else F.array_sort(shared)


def ranked_anchors(rows: DataFrame, key: str, title: Column, body: Column, text: Column, stop: Sequence[str] = (), least: int = 4) -> DataFrame:
    """(key, line, ident, in_title, n, place): lines of a text that a report's words point at, best first.

    An identifier of title or body that the text has points at the first line
    with it; those of the title come first, then the rarer ones, then earlier
    lines.  A line that several point at keeps its best place.
    """
    idents = lambda t: F.array_distinct(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"[A-Za-z_][A-Za-z0-9_]{%d,}" % (least - 1)), F.lit(0)))
    titled = rows.select(key, F.lit(True).alias("t"), F.explode(idents(title)).alias("ident"))
    named = titled.unionByName(rows.select(key, F.lit(False).alias("t"), F.explode(idents(body)).alias("ident"))).filter(~F.lower("ident").isin(*stop) if stop else F.lit(True))
    named = named.groupBy(key, "ident").agg(F.max("t").alias("in_title"))
    lines = rows.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("at", "line_text"))
    words = lines.select(key, (F.col("at") + 1).alias("line"), F.explode(F.regexp_extract_all("line_text", F.lit(r"\w+"), F.lit(0))).alias("ident"))
    seen = words.groupBy(key, "ident").agg(F.count("*").alias("n"), F.min("line").alias("line"))
    best = named.join(seen, [key, "ident"]).groupBy(key, "line").agg(F.min(F.struct((~F.col("in_title")).alias("late"), "n", "ident")).alias("b"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(key).orderBy("b.late", "b.n", "line"))
    return best.withColumn("place", place).select(key, "line", "b.ident", (~F.col("b.late")).alias("in_title"), "b.n", "place")
