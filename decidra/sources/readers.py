"""Readers: JSON lines with rejects, wrapped JSON, tagged CSV, text trees, shards with proof of coverage, precedence of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): objects by the schema, and (file, line) of lines that are no JSON object. Blank lines are skipped."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).filter(F.length(F.trim("line")) > 0)
    wide = StructType([*schema.fields, StructField(BAD, StringType())])
    parsed = lines.withColumn("r", F.from_json("line", wide, {"columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"}))
    bad = F.col(f"r.{BAD}").isNotNull() | ~F.ltrim("line").startswith("{")
    return parsed.filter(~bad).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]), parsed.filter(bad).select("file", "line")


def read_jsonl_strict(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Rows of JSON lines; an error names the file and line text of a reject, and an input without rows is one too."""
    rows, rejected = read_jsonl(spark, path, schema)
    for r in rejected.limit(1).collect():
        raise ValueError(f"{r['file']}: not a JSON object: {r['line'][:120]!r}")
    if rows.isEmpty():
        raise ValueError(f"no records in {path}")
    return rows


def read_wrapped(spark: SparkSession, path: str, field: str | None, schema: StructType) -> DataFrame:
    """Elements of a JSON array, or of the array in a member of a JSON object."""
    if field is None:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    from pyspark.sql.types import ArrayType

    whole = StructType([StructField(field, ArrayType(schema))])
    return spark.read.schema(whole).option("multiLine", True).json(path).select(F.explode(field).alias("r")).select("r.*")


def read_tagged_csv(spark: SparkSession, paths: dict[str, str], schema: StructType, tag: str = "kind") -> DataFrame:
    """CSV files with a header as one table, each row tagged with its file's kind."""
    out = None
    for kind, path in paths.items():
        one = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path).withColumn(tag, F.lit(kind))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no files")
    return out


def read_text_tree(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, text) of all files below root whose names match; bytes that are no UTF-8 become replacement characters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def joined_siblings(files: DataFrame) -> DataFrame:
    """(folder, text): the texts of each folder in the order of their paths, with a blank line between."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "text"))), lambda s: s["text"]), "\n\n").alias("text"))


def read_shards(spark: SparkSession, glob: str, schema: StructType) -> DataFrame:
    """Rows of JSON-line shards with the name of their shard; lines that don't parse have nulls."""
    return spark.read.schema(schema).json(glob).select("*", F.col("_metadata.file_name").alias("shard"))


def shard_coverage(shards: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """(check_name, n_bad): keys that shards lack, that they have too many, and that stand in several rows."""
    from decidra.operators.records import key_differences

    diff = key_differences(base, shards, key).groupBy("side").count()
    names = F.when(F.col("side") == "left", "missing").otherwise("extra")
    twice = shards.groupBy(key).count().filter("count > 1").agg(F.lit("repeated").alias("check_name"), F.count("*").alias("n_bad"))
    return diff.select(names.alias("check_name"), F.col("count").alias("n_bad")).unionByName(twice.filter("n_bad > 0"))


def first_by_precedence(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per key from the first source that has it; within a source the row that sorts lowest."""
    out = None
    for rank, df in enumerate(sources):
        one = df.withColumn("_rank", F.lit(rank))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    names = [c for c in out.columns if c != "_rank"]
    order = F.struct("_rank", F.to_json(F.struct(*names)))
    return out.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*names), order).alias("_row")).select("_row.*")


def ids_in_text(texts: DataFrame, text: Column, pattern: str) -> DataFrame:
    """The distinct ids that a pattern finds anywhere in texts."""
    return texts.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("id")).distinct()


def commit_list(df: DataFrame, repository: str, columns: Sequence[str]) -> DataFrame:
    """(repository, sha): the distinct non-null commits that several columns name."""
    return df.select(F.col(repository).alias("repository"), F.explode(F.array(*columns)).alias("sha")).filter("repository is not null and sha is not null and sha <> ''").distinct()


def blobs(files: DataFrame, repository: Column, commit: Column) -> DataFrame:
    """(repo, commit, path, text): files of commits as a table, one row for each; repeated rows once."""
    return files.select(repository.alias("repo"), commit.alias("commit"), "path", "text").distinct()


def diff_lines(diffs: DataFrame, patch: Column, *keys: str) -> DataFrame:
    """(keys, at, sign, line): added and removed lines of unified diffs in their order, from 0; file headers are left out, null patches have none."""
    from decidra.functions import text as tx

    rows = diffs.select(*keys, F.posexplode(F.filter(tx.lines(patch), lambda x: x.rlike(r"^[+-]") & ~x.rlike(r"^(\+\+\+|---)"))).alias("at", "l"))
    return rows.select(*keys, "at", F.left("l", F.lit(1)).alias("sign"), F.substring("l", 2, 1_000_000_000).alias("line"))


def read_manifest(text: str | None) -> dict[str, str]:
    """``key: value`` lines of a manifest; members of a nested mapping have their keys joined by dots, list items their number.

    Anything else is ignored, and so is a manifest that can't be read; quotes
    around a value and comments after it are taken off.
    """
    out: dict[str, str] = {}
    open_keys: list[tuple[int, str, int]] = []  # indent, key, items so far
    for line in (text or "").splitlines():
        body = line.strip()
        if not body or body[0] == "#" or body == "---":
            continue
        indent = len(line) - len(line.lstrip(" "))
        while open_keys and open_keys[-1][0] >= indent + (body[0] == "-"):
            open_keys.pop()
        if body.startswith("- ") and open_keys:
            at, key, n = open_keys[-1]
            open_keys[-1] = (at, key, n + 1)
            out[".".join([*(k for _, k, _ in open_keys), str(n)])] = _scalar(body[2:])
            continue
        key, colon, value = body.partition(":")
        if indent and not open_keys:  # below a value: no mapping
            continue
        if not colon or not key or key[0] == "-" or value and not value[0].isspace():
            continue
        if value.strip() and not value.strip().startswith("#"):
            out[".".join([*(k for _, k, _ in open_keys), key.strip()])] = _scalar(value)
        else:
            open_keys.append((indent, key.strip(), 0))
    return out


def _scalar(value: str) -> str:
    v = value.strip()
    if v[:1] in ("'", '"') and v.find(v[0], 1) > 0:
        return v[1 : v.find(v[0], 1)]
    return v.split(" #", 1)[0].strip()
