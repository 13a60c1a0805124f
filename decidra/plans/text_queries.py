"""Text rules, normalisers, leakage and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import text as tx
from decidra.operators import leakage, lineage, quality, redaction
from decidra.plans.base import Catalogue, table
from decidra.session import scratch

C = Catalogue()


def _case(rules, subject, default):
    return "CASE " + " ".join(f"WHEN regexp_matches({subject}, '{p}') THEN '{k}'" for k, p in rules) + f" ELSE '{default}' END"


def _path_case(p):
    arms = []
    for action, parts, endings in tx.PATH_RULES:
        tests = [f"contains({p}, '{x}')" for x in parts] + [f"ends_with({p}, '{x}')" for x in endings]
        arms.append(f"WHEN {' OR '.join(tests)} THEN '{action}'")
    return "CASE " + " ".join(arms) + " ELSE 'rtl' END"


#: Categories of documents by weighted patterns (channel: text); the reserve stays with 'unknown'.
TOPIC_RULES = (
    ("timing", 1.8, "handshake|race|clock|too early|zu früh|too late|latency"),
    ("reset", 1.8, "reset|rst_n|aresetn|presetn|warm"),
    ("width", 1.5, "width|bits|truncat|overflow"),
    ("synthesis", 1.2, "synthesis|constant|folds"),
    ("verification", 1.0, "coverage|checker|seed|waveform|cov="),
)
RESERVE = 0.3
_LINES = "list_filter(string_split(replace(replace(regexp_replace({0}, '(\\r\\n|\\r|\\n)$', ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda l: TRUE)"
_STRIPPED = "list_distinct(list_filter(list_transform(" + _LINES + ", lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) > {1}))"


@C.add(f"SELECT category, count(*) AS n FROM (SELECT {_case(tx.ROOT_CAUSE_RULES, "lower(coalesce(text, ''))", 'unknown')} AS category FROM documents) GROUP BY category")
def rule_first_match(spark, d):
    """Documents by the first matching root-cause pattern."""
    return table(spark, d, "documents").select(tx.first_match(F.col("text"), tx.ROOT_CAUSE_RULES, "unknown").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@C.add(f"""
WITH p AS (SELECT unnest(regexp_extract_all(text, 'rtl/[a-z_0-9]+/[a-z_0-9]+\\.sv|[a-z_0-9]+\\.(?:v|md|sdc|tcl)')) AS path FROM documents)
SELECT path, {_path_case("lower(path)")} AS action, count(*) AS n FROM p GROUP BY path""")
def path_classify(spark, d):
    """Paths named in documents, and the action that each suggests."""
    p = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"rtl/[a-z_0-9]+/[a-z_0-9]+\.sv|[a-z_0-9]+\.(?:v|md|sdc|tcl)"), F.lit(0))).alias("path"))
    return p.groupBy("path").agg(F.count("*").alias("n")).select("path", tx.path_action(F.col("path")).alias("action"), "n")


@C.add("WITH w AS (SELECT doc_id, " + ", ".join(f"CASE WHEN regexp_matches(lower(coalesce(text, '')), '{p}') THEN {w} ELSE 0.0 END::DOUBLE AS w_{k}" for k, w, p in TOPIC_RULES) + f" FROM documents), s AS (SELECT *, {RESERVE}::DOUBLE AS w_unknown, {RESERVE}" + "".join(f" + w_{k}" for k, _, _ in TOPIC_RULES) + " AS total FROM w) " + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS category, round(w_{k} / total, 9) AS p FROM s WHERE w_{k} > 0" for k in [*(r[0] for r in TOPIC_RULES), "unknown"]))
def rule_distribution(spark, d):
    """Normalised weights of the categories whose patterns occur, melted."""
    t = F.lower(F.coalesce("text", F.lit("")))
    weights = [F.struct(F.lit(k).alias("category"), F.when(t.rlike(p), F.lit(w)).otherwise(0.0).alias("w")) for k, w, p in TOPIC_RULES] + [F.struct(F.lit("unknown").alias("category"), F.lit(RESERVE).alias("w"))]
    rows = table(spark, d, "documents").select("doc_id", F.array(*weights).alias("ws")).withColumn("total", F.aggregate("ws", F.lit(0.0), lambda a, x: a + x["w"]))
    return rows.select("doc_id", "total", F.inline("ws")).filter("w > 0").select("doc_id", "category", F.round(F.col("w") / F.col("total"), 9).alias("p"))


@C.add("""
SELECT id, length(c) AS n, substr(sha256(c), 1, 16) AS harness, length(k) AS clipped FROM (
  SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(buggy_rtl, ''), '//[^\\n]*', '', 'g'), '/\\*.*?\\*/', '', 'gs'), '[0-9]+', 'N', 'g'), '\\s+', ' ', 'g') AS c,
    CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || chr(10) || '...[truncated]' ELSE t END AS k
  FROM (SELECT *, regexp_replace(replace(coalesce(buggy_rtl, ''), chr(0), ' '), '^\\s+|\\s+$', '', 'g') AS t FROM batch_06_mux_4_1))""")
def text_normalise(spark, d):
    """Normalised harness keys and clipped lengths of the RTL."""
    b = table(spark, d, "batch_06_mux_4_1")
    key = tx.harness_key(F.col("buggy_rtl"))
    return b.select("id", F.length(key).cast("long").alias("n"), F.left(F.sha2(key, 256), F.lit(16)).alias("harness"), F.length(tx.clip(F.col("buggy_rtl"), 300)).cast("long").alias("clipped"))


_SIGNED = "^\\s*(signed-off-by|reported-by|cc)\\s*:|^-{2,} "


@C.add(f"SELECT doc_id, length(array_to_string(list_filter({_LINES.format('text')}, lambda l: NOT regexp_matches(l, '(?i){_SIGNED}')), chr(10)))::BIGINT AS kept FROM documents WHERE text IS NOT NULL")
def redact_terms(spark, d):
    """Length of the documents without sign-off lines."""
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.length(tx.without_lines(F.col("text"), _SIGNED)).cast("long").alias("kept"))


@C.add("SELECT name, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT id, unnest(regexp_extract_all(buggy_rtl, '(?m)^[ \\t]*module[ \\t]+([A-Za-z_][A-Za-z0-9_]*)', 1)) AS name FROM batch_06_mux_4_1) GROUP BY name")
def module_extract(spark, d):
    return table(spark, d, "batch_06_mux_4_1").select("id", F.explode(tx.module_names(F.col("buggy_rtl"))).alias("name")).groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


_TELLING = "error|unknown module|missing|fail|fatal|mismatch"


@C.add(f"""
WITH l AS (SELECT doc_id, list_filter({_LINES.format('text')}, lambda l: regexp_matches(l, '(?i){_TELLING}')) AS h FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(h, lambda x: lower(trim(regexp_replace(regexp_replace(regexp_replace(x, '[A-Za-z0-9_./]+\\.(svh|sv|vh|v)\\b', '<src>', 'g'), '[0-9]+', 'N', 'g'), '[\\s\\x0b]+', ' ', 'g')))))) AS sig, substr(trim(h[1]), 1, 200) AS first_line FROM l)
SELECT doc_id, len(sig) AS n, sha256(array_to_string(sig, chr(10))) AS signature, first_line FROM s WHERE len(sig) > 0""")
def failure_signature(spark, d):
    """How a log failed, numbers and files aside, and its first telling line."""
    sig = tx.failure_signature(F.col("text"))
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", sig.alias("sig"), tx.first_line_with(F.col("text"), _TELLING).alias("first_line"))
    return rows.filter(F.size("sig") > 0).select("doc_id", F.size("sig").cast("long").alias("n"), F.sha2(F.array_join("sig", "\n"), 256).alias("signature"), "first_line")


@C.add("""
WITH v AS (SELECT doc_id, coalesce(regexp_matches(text, 'ERROR|mismatch|FAIL'), FALSE) AS f, coalesce(regexp_matches(text, 'INFO|PASS|clean'), FALSE) AS p FROM documents)
SELECT CASE WHEN f THEN 'failed' WHEN p THEN 'passed' ELSE 'unknown' END AS verdict, count(*) AS n FROM v GROUP BY 1""")
def verdict_ladder(spark, d):
    """Verdicts of transcripts from their last pass and fail marks; any fail mark wins."""
    fail, good = tx.last_match_end(F.col("text"), "ERROR|mismatch|FAIL"), tx.last_match_end(F.col("text"), "INFO|PASS|clean")
    return table(spark, d, "documents").select(F.when(fail >= 0, "failed").when(good >= 0, "passed").otherwise("unknown").alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@C.add("""
SELECT count(*) AS documents, sum(n)::BIGINT AS tokens, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.95), 6) AS p95, max(n) AS longest, count(*) FILTER (WHERE n > 128) AS truncated
FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{M}\\p{N}_]+|[^\\s\\x0b\\p{Z}\\p{L}\\p{M}\\p{N}_]'))::BIGINT AS n FROM documents)""")
def token_lengths(spark, d):
    """Lengths in tokens of all documents, and how many a limit of 128 would cut."""
    n = F.size(tx.tokens(F.coalesce("text", F.lit("")))).cast("long")
    q = F.percentile("n", F.array(F.lit(0.5), F.lit(0.95)))
    return table(spark, d, "documents").select(n.alias("n")).agg(F.count("*").alias("documents"), F.sum("n").alias("tokens"), F.round(q[0], 6).alias("p50"), F.round(q[1], 6).alias("p95"), F.max("n").alias("longest"), F.count_if(F.col("n") > 128).alias("truncated"))


@C.add(f"""
WITH a AS (SELECT doc_id, unnest({_STRIPPED.format('text', 8)}) AS line FROM documents WHERE crawled_at < TIMESTAMP '2025-10-01'),
b AS (SELECT doc_id AS later_id, unnest({_STRIPPED.format('text', 8)}) AS line FROM documents WHERE crawled_at >= TIMESTAMP '2025-10-01')
SELECT later_id, count(DISTINCT line) AS lines FROM b WHERE line IN (SELECT line FROM a) GROUP BY later_id""")
def leak_lines(spark, d):
    """Later crawled documents with lines that stand in earlier ones, and how many."""
    docs = table(spark, d, "documents")
    cut = F.lit("2025-10-01 00:00:00").cast("timestamp_ntz")
    later = docs.filter(F.col("crawled_at") >= cut).withColumnRenamed("doc_id", "later_id")
    return leakage.lines_found_in(later, "later_id", F.col("text"), docs.filter(F.col("crawled_at") < cut), F.col("text"))


@C.add("SELECT doc_id, item_id FROM documents JOIN test_items t ON length(t.text) >= 40 AND contains(documents.text, substr(t.text, 1, 40))")
def leak_prefix40(spark, d):
    """Documents that contain the first 40 characters of a held-out item."""
    return leakage.contained_prefixes(table(spark, d, "documents"), "doc_id", F.col("text"), table(spark, d, "test_items"), "item_id", F.col("text"))


@C.add("""
WITH x AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' AND user_id IS NOT NULL GROUP BY ALL), y AS (SELECT user_id, event_type, count(*) AS m FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND user_id IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, (n - coalesce(m, 0))::BIGINT AS surplus FROM x LEFT JOIN y USING (user_id, event_type) WHERE n > coalesce(m, 0)""")
def multiset_difference(spark, d):
    """Event types that a user has more often before the middle of the month than after."""
    e = table(spark, d, "events").filter("user_id is not null").withColumn("early", F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    bag = lambda part: part.groupBy("user_id", F.col("event_type").alias("line")).agg(F.count("*").alias("n"))
    more = leakage.bag_difference(bag(e.filter("early")), bag(e.filter("not early")), "user_id")
    return more.select("user_id", F.col("line").alias("event_type"), F.col("n").alias("surplus"))


@C.add("SELECT doc_kind, count(*) AS n, count(*) FILTER (WHERE regexp_matches(lower(coalesce(text, '')), 'must be|should be|needs to|has to|ought to|please')) AS directive FROM documents GROUP BY doc_kind")
def directive_screen(spark, d):
    """Documents with directive language by kind."""
    t = F.lower(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").groupBy("doc_kind").agg(F.count("*").alias("n"), F.count_if(t.rlike("must be|should be|needs to|has to|ought to|please")).alias("directive"))


@C.add("""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[a-z]+_[a-z0-9_]+')) AS ident FROM documents), c AS (SELECT ident, count(*) AS n, count(DISTINCT doc_id) AS docs FROM w GROUP BY ident)
SELECT ident, n, docs, r FROM (SELECT *, row_number() OVER (ORDER BY docs, n DESC, ident) AS r FROM c WHERE docs > 1) WHERE r <= 50""")
def anchor_rank(spark, d):
    """The fifty rarest identifiers that more than one document has (a top-k report)."""
    w = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[a-z]+_[a-z0-9_]+"), F.lit(0))).alias("ident"))
    c = w.groupBy("ident").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs")).filter("docs > 1").orderBy("docs", F.desc("n"), "ident").limit(50)
    from pyspark.sql import Window

    return c.withColumn("r", F.row_number().over(Window.orderBy("docs", F.desc("n"), "ident")).cast("long"))  # fifty rows


@C.add("SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events WHERE json_valid(props)")
def json_props(spark, d):
    """An embedded JSON field, typed; rows that don't parse are left out."""
    v = F.from_json("props", "struct<k: bigint>")
    return table(spark, d, "events").filter(F.try_parse_json("props").isNotNull()).select("event_id", v["k"].alias("k"))


_LINE_SETS = f"""
l AS (SELECT doc_id, {_STRIPPED.format('text', 8)} AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS line, len(ls) AS n FROM l)"""


@C.add(f"""
WITH o AS (SELECT id, arg_min(buggy_rtl, row_no) AS text FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND buggy_rtl IS NOT NULL GROUP BY id),
l AS (SELECT id, {_STRIPPED.format('text', 8)} AS ls FROM o), x AS (SELECT id, unnest(ls) AS line, len(ls) AS n FROM l),
s AS (SELECT a.id AS id_a, b.id AS id_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM x a JOIN x b ON a.line = b.line AND a.id < b.id GROUP BY 1, 2)
SELECT id_a, id_b, round(shared / (na + nb - shared)::DOUBLE, 9) AS jaccard FROM s WHERE shared / (na + nb - shared)::DOUBLE >= 0.4""")
def jaccard_pairs(spark, d):
    """Ids whose designs have like or equal sets of lines."""
    first = table(spark, d, "batch_06_mux_4_1").filter("id is not null and buggy_rtl is not null").groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("text"))
    sets = scratch(lineage.line_sets(first, "id", tx.stripped_lines(F.col("text"), 8)), "line-sets")
    near = lineage.similar_classes(sets, 0.4)
    a, b = (sets.select(F.col("cls").alias(f"cls_{x}"), F.col("id").alias(f"id_{x}")) for x in "ab")
    pairs = near.join(a, "cls_a").join(b, "cls_b")
    unlike = pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), F.round("jaccard", 9).alias("jaccard"))
    copies = a.join(b.withColumnRenamed("cls_b", "cls_a"), "cls_a").filter("id_a < id_b").select("id_a", "id_b", F.lit(1.0).alias("jaccard"))
    return unlike.unionByName(copies)


@C.add(f"""
WITH RECURSIVE {_LINE_SETS},
e AS (SELECT a.doc_id AS u, b.doc_id AS v FROM x a JOIN x b ON a.line = b.line AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*))::DOUBLE >= 0.4
      UNION SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id < b.doc_id),
g AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT g.v, r.root FROM r JOIN g ON g.u = r.node)
SELECT node AS doc_id, min(root) AS family FROM r GROUP BY node""")
def lineage_families(spark, d):
    """Each document with the smallest id of its family, linked by like lines or equal text."""
    docs = table(spark, d, "documents")
    sets = scratch(lineage.line_sets(docs, "doc_id", tx.stripped_lines(F.col("text"), 8)), "line-sets")
    heads = scratch(sets.groupBy("cls").agg(F.min("doc_id").alias("head")), "heads")
    near = lineage.similar_classes(sets, 0.4).join(heads.select(F.col("cls").alias("cls_a"), F.col("head").alias("u")), "cls_a").join(heads.select(F.col("cls").alias("cls_b"), F.col("head").alias("v")), "cls_b").select("u", "v")
    equal = sets.join(heads, "cls").select(F.col("head").alias("u"), F.col("doc_id").alias("v"))
    same = lineage.star_edges(docs, "doc_id", F.sha2("text", 256))
    found = lineage.components(docs.select(F.col("doc_id").alias("node")), near.unionByName(equal).unionByName(same))
    return found.select(F.col("node").alias("doc_id"), F.col("root").alias("family"))


@C.add()
def fault_diff(spark, d):
    """Token differences of designs whose sets of lines are alike to 0.7 or more, comments aside: a row per two different token texts, each under the smallest id that has it."""
    code = tx.without_comments(F.col("text"))
    first = table(spark, d, "batch_06_mux_4_1").filter("id is not null and buggy_rtl is not null").groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("text"))
    texts = first.select("id", code.alias("code")).groupBy(F.sha2(F.array_join(F.regexp_extract_all("code", F.lit(redaction.TOKEN), F.lit(0)), "\n"), 256).alias("key")).agg(F.min(F.struct("id", "code")).alias("x")).select("x.id", "x.code")
    sets = scratch(lineage.line_sets(texts, "id", tx.stripped_lines(F.col("code"), 8), "code"), "line-sets")
    near = lineage.similar_classes(sets.select("id", "cls", "n", "ls"), 0.7).select("cls_a", "cls_b", F.col("jaccard").alias("likeness"))
    same = sets.groupBy("cls").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b"), F.lit(1.0).alias("likeness"))
    a, b = (sets.select(*[F.col(c).alias(f"{c}_{x}") for c in ("cls", "id", "code")]) for x in "ab")
    pairs = near.unionByName(same).join(a, "cls_a").join(b, "cls_b").filter("cls_a <> cls_b or id_a < id_b")
    turn = F.col("id_a") > F.col("id_b")
    ordered = pairs.select("likeness", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), F.when(turn, F.col("code_b")).otherwise(F.col("code_a")).alias("x"), F.when(turn, F.col("code_a")).otherwise(F.col("code_b")).alias("y"))
    return ordered.select("id_a", "id_b", F.round("likeness", 9).alias("likeness"), redaction.token_diff(F.col("x"), F.col("y")).alias("d")).select("id_a", "id_b", "likeness", "d.*")


_DECLARED = "regexp_extract_all(buggy_rtl, '(?m)^[ \\t]*module[ \\t]+([A-Za-z_][A-Za-z0-9_]*)', 1)"


@C.add("SELECT * FROM (VALUES ('tokens apart', 0::BIGINT), ('no edit', 0), ('flag wrong', 0)) t(check_name, n_bad)")
def fault_diff_checks(spark, d):
    """What is wrong with the differences of designs: token counts that removed and added tokens don't explain, pairs without any hunk, wrong flags."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and buggy_rtl is not null").groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("text"))
    count = lambda t: F.size(F.regexp_extract_all(t, F.lit(redaction.TOKEN), F.lit(0)))
    n = b.select("id", count(tx.without_comments(F.col("text"))).alias("n"))
    diff = fault_diff(spark, d).join(n.select(F.col("id").alias("id_a"), F.col("n").alias("n_a")), "id_a").join(n.select(F.col("id").alias("id_b"), F.col("n").alias("n_b")), "id_b")
    words = lambda c: F.when(F.length(c) > 0, F.size(F.split(c, " "))).otherwise(0)
    bad = {
        "tokens apart": (F.col("formatting") == 0) & (F.col("n_a") - words("removed") + words("added") != F.col("n_b")),
        "no edit": F.col("n_edits") + F.col("formatting") == 0,
        "flag wrong": F.col("localised") != (F.col("n_edits") == 1),
    }
    wide = diff.agg(*[F.count_if(c).alias(k) for k, c in bad.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("n_bad")) for k in bad])).alias("r")).select("r.*")


_KEYS = f"""
o AS (SELECT id, arg_min(buggy_rtl, row_no) AS buggy_rtl, arg_min(source_group, row_no) AS source_group FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND buggy_rtl IS NOT NULL GROUP BY id),
k AS (SELECT id, 'h' || sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(buggy_rtl, ''), '//[^\\n]*', '', 'g'), '/\\*.*?\\*/', '', 'gs'), '[0-9]+', 'N', 'g'), '\\s+', ' ', 'g')) AS b FROM o
  UNION SELECT id, 'm' || m FROM (SELECT id, unnest({_DECLARED}) AS m FROM o) UNION SELECT id, 'g' || lower(trim(source_group)) FROM o WHERE source_group IS NOT NULL)"""


@C.add(f"""
WITH RECURSIVE {_KEYS},
f AS (SELECT b, min(id) AS u FROM k GROUP BY b), e AS (SELECT DISTINCT f.u AS u, k.id AS v FROM k JOIN f USING (b)), g AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT id AS node, id AS root FROM o UNION SELECT g.v, r.root FROM r JOIN g ON g.u = r.node)
SELECT node AS id, min(root) AS family FROM r GROUP BY node""")
def design_families(spark, d):
    """Designs linked by three keys, each by stars to the smallest member: equal harness but for numbers, a module's name, the group they come from."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and buggy_rtl is not null")
    o = b.groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("rtl"), F.min_by("source_group", "row_no").alias("g"))
    o = scratch(o, "designs")
    edges = lineage.star_edges(o, "id", F.sha2(tx.harness_key(F.col("rtl")), 256))
    edges = edges.unionByName(lineage.star_edges(o.select("id", F.explode(tx.module_names(F.col("rtl"))).alias("m")), "id", F.col("m"))).unionByName(lineage.star_edges(o, "id", F.lower(F.trim("g"))))
    return lineage.components(o.select(F.col("id").alias("node")), edges).select(F.col("node").alias("id"), F.col("root").alias("family"))


@C.add()
def comment_redaction(spark, d):
    """Words of tool-made banners replaced inside comments of the RTL."""
    redact = redaction.comment_redactor(["netlist", "rev", "tag", "pipeline", "unit"])
    return table(spark, d, "batch_06_mux_4_1").select("row_no", redact("buggy_rtl").alias("x")).select("row_no", F.length("x.text").alias("n"), F.array_join("x.found", ",").alias("found"))


@C.add("SELECT id, len(list_filter(regexp_extract_all(buggy_rtl, '(?m)^[ \\t]*module[ \\t]+([A-Za-z_][A-Za-z0-9_]*)', 1), lambda x: TRUE))::BIGINT AS declared FROM batch_06_mux_4_1 WHERE buggy_rtl IS NOT NULL")
def declared_modules(spark, d):
    return table(spark, d, "batch_06_mux_4_1").filter("buggy_rtl is not null").select("id", F.size(tx.module_names(F.col("buggy_rtl"))).cast("long").alias("declared"))


_USED = "regexp_extract_all(buggy_rtl, '(?m)^[ \\t]*([A-Za-z_][A-Za-z0-9_]*)[ \\t]+(?:#[ \\t]*\\([^;]*?\\)[ \\t]*)?[A-Za-z_][A-Za-z0-9_]*[ \\t]*\\(', 1)"


@C.add(f"""
WITH m AS (SELECT id, {_DECLARED} AS ds, list_filter({_USED}, lambda x: x <> 'module') AS us FROM batch_06_mux_4_1 WHERE buggy_rtl IS NOT NULL),
r AS (SELECT id, ds, list_filter(ds, lambda x: NOT list_contains(us, x)) AS roots FROM m)
SELECT DISTINCT id, unnest(CASE WHEN len(roots) > 0 THEN roots ELSE list_slice(ds, -1, -1) END) AS module FROM r""")
def top_modules(spark, d):
    """Modules that are declared and not instantiated, by id and name; the last declared one where all are."""
    return table(spark, d, "batch_06_mux_4_1").filter("buggy_rtl is not null").select("id", F.explode(tx.top_modules(F.col("buggy_rtl"))).alias("module")).distinct()


_PAIRED = "SELECT id, arg_min(buggy_rtl, row_no) AS b, arg_max(buggy_rtl, row_no) AS a, min(row_no) % 2 = 1 AS odd FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND length(buggy_rtl) > 0 GROUP BY id"


@C.add(f"SELECT id, TRUE AS applies, NOT odd AS exact FROM ({_PAIRED})")
def patch_verification(spark, d):
    """Patches from the first to the last design of an id, those of odd rows with a line of the result left out: all apply, the whole ones are exact."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and length(buggy_rtl) > 0")
    p = b.groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("b"), F.max_by("buggy_rtl", "row_no").alias("a"), (F.min("row_no") % 2 == 1).alias("odd"))
    minus = F.transform(tx.lines(F.col("b")), lambda x: F.concat(F.lit("-"), x))
    plus = F.transform(tx.lines(F.col("a")), lambda x: F.concat(F.lit("+"), x))
    plus = F.when(F.col("odd"), F.slice(plus, 2, F.size(plus))).otherwise(plus)
    return leakage.patch_check(p, "id", F.array_join(F.concat(minus, plus), "\n"), F.col("b"), F.col("a"))


@C.add(f"""
WITH p AS ({_PAIRED}), l AS (SELECT id, b, unnest({_STRIPPED.format("a", 11)}) AS line FROM p)
SELECT id, count(*) AS lines FROM l WHERE NOT regexp_matches(line, '^(//|/\\*|\\*|end\\b|begin\\b)') AND contains(b, line) GROUP BY id""")
def self_answering(spark, d):
    """Designs whose last version's lines, as the added ones of a patch, stand in the first that asks for it, and how many."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and length(buggy_rtl) > 0")
    p = b.groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("b"), F.max_by("buggy_rtl", "row_no").alias("a"))
    plus = F.array_join(F.transform(tx.lines(F.col("a")), lambda x: F.concat(F.lit("+"), x)), "\n")
    return quality.self_answering(p, "id", plus, F.col("b")).groupBy("id").agg(F.count("*").alias("lines"))
