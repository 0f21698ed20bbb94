"""Readers for the file shapes of a curation pipeline. Schemas are given, never inferred.

Unreadable input is reported beside the good rows and never fatal; a missing file gives the
caller's default as an empty frame.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) not in (None, ())


def json_records(spark: SparkSession, path: str, schema: StructType, whole_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a file or folder with one JSON record per file (or per line): bad has
    ``path`` and ``raw``. A missing path gives empty frames."""
    broken = "_broken"
    kind = StructType([*schema.fields, StructField(broken, StringType())])
    try:
        rows = spark.read.schema(kind).option("multiLine", whole_files).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).json(path)
        rows = rows.withColumn("path", F.col("_metadata.file_path")).cache()  # a corrupt-record filter needs parsed rows
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], StructType([*kind.fields, StructField("path", StringType())]))
    return rows.where(F.col(broken).isNull()).drop(broken, "path"), rows.where(F.col(broken).isNotNull()).select("path", F.col(broken).alias("raw"))


def wrapped_map(spark: SparkSession, path: str, field: str, value_schema: str) -> DataFrame:
    """(key, value fields ...) of a file {"note": ..., "<field>": {key: record}}."""
    raw = spark.read.option("wholetext", True).text(path)
    got = raw.select(F.from_json("value", f"struct<`{field}`: map<string, {value_schema}>>").alias("w"))
    return got.select(F.explode(F.col(f"w.{field}")).alias("key", "v")).select("key", "v.*")


def ledger_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """A ledger of JSON lines: blank lines skipped, keys lower-cased, the later line wins.

    The order of lines is (file, block, position in the read), a max-aggregate keeps the last.
    """
    lines = spark.read.text(path).withColumn("_o", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("i"))).where(F.col("value").rlike(r"\S"))
    rows = lines.select("_o", F.from_json("value", schema).alias("r")).where("r is not null").select("_o", F.lower(F.col(f"r.{key}")).alias("_k"), "r").where("_k is not null")
    return rows.groupBy("_k").agg(F.max(F.struct("_o", "r")).alias("m")).select("m.r.*", "_k").withColumn(key, F.col("_k")).drop("_k")


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def heading_keys(markdown: Column) -> Column:
    """Keys of "## <key>" headings, in order."""
    return F.regexp_extract_all(markdown, F.lit(r"(?m)^## (10\.\S+)\s*$"), 1)


def heading_blocks(files: DataFrame, body: str, *keep: str) -> DataFrame:
    """(keep, pos, key, block): a batch file cut into the blocks under its headings."""
    parts = F.filter(F.split(body, r"(?m)^## "), lambda p: p.rlike(r"^10\.\S+"))
    got = files.select(*keep, F.posexplode(parts).alias("pos", "_b"))
    return got.select(*keep, "pos", F.regexp_extract("_b", r"^(10\.\S+)", 1).alias("key"), F.regexp_replace("_b", r"^10\.\S+\s*|\s+$", "").alias("block"))


def triples(spark: SparkSession, path: str, names: tuple[str, str, str]) -> DataFrame:
    """Tab-separated lines of three fields."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where(F.col("value").rlike(r"\S")).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def versions(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """All versions of a table kept in folders v=<version>; filter on ``v`` prunes folders."""
    return spark.read.schema(schema).option("basePath", base).parquet(base)


def latest(df: DataFrame) -> str | None:
    """The newest version name in natural order of its numbers."""
    names = [r[0] for r in df.select(F.col("v").cast("string")).distinct().collect()]  # one row per version
    return max(names, key=lambda v: [int(x) if x.isdigit() else -1 for x in v.split(".")], default=None)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, stem, size, modified) of files, without reading them."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    return f.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "size", "modified")


def first_location(listings: list[DataFrame], key: str = "name") -> DataFrame:
    """Per file the first of several folders, in the given order, that has it."""
    every = listings[0].withColumn("priority", F.lit(0))
    for i, x in enumerate(listings[1:], 1):
        every = every.unionByName(x.withColumn("priority", F.lit(i)))
    return every.groupBy(key).agg(F.min(F.struct("priority", "path")).alias("m")).select(key, "m.path", "m.priority")


def first_usable(candidates: list[tuple[str, DataFrame]], key: str, body: str, least: int = 80) -> DataFrame:
    """(key, body, source): per key the text of the first provider whose text is longer than
    ``least``; the source is that provider, null without one."""
    parts = [d.select(key, F.col(body), F.lit(n).alias("source"), F.lit(i).alias("_p")) for i, (n, d) in enumerate(candidates)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    ok = F.when(F.length(body) > least, F.struct("_p", body, "source"))
    return every.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ok).alias("m")).select(key, F.col(f"m.{body}").alias(body), "m.source")


def looked_up(keys: DataFrame, cache: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, looked_up): a cache in which a stored null says that the key is unknown
    there; ``looked_up`` tells that from a key never asked for."""
    c = cache.groupBy(key).agg(F.max(value).alias(value), F.lit(True).alias("_h"))
    return keys.join(c, key, "left").withColumn("looked_up", F.coalesce("_h", F.lit(False))).drop("_h")


def sections_first(xml: Column, first: tuple[str, ...] = ("method", "result"), limit: int = 12_000) -> Column:
    """Text of the sections of an article in XML, those whose title names ``first`` in front,
    cut at ``limit`` characters."""
    titles = F.xpath(xml, F.lit("//sec/title/text()"))
    bodies = F.xpath(xml, F.lit("//sec/p/text()"))
    rank = lambda t: F.coalesce(*[F.when(F.contains(F.lower(t), F.lit(f)), F.lit(i)) for i, f in enumerate(first)], F.lit(len(first)))
    secs = F.transform(F.arrays_zip(titles.alias("t"), bodies.alias("b")), lambda s, i: F.struct(rank(s["t"]).alias("r"), i.alias("i"), F.coalesce(s["b"], F.lit("")).alias("b")))
    return F.substring(F.array_join(F.transform(F.array_sort(secs), lambda s: s.b), "\n"), 1, limit)


def rechecked(hits: DataFrame, wanted: str, got: str, body: str) -> DataFrame:
    """The hits of a lookup that are for the very key asked for (case apart) and have a text."""
    same = F.lower(F.trim(wanted)) == F.lower(F.trim(got))
    return hits.where(same & (F.length(F.trim(body)) > 0))


def lookup_plan(rows: DataFrame, body: str, source_id: str) -> DataFrame:
    """(n_missing, n_fixable): rows without a text, and those among them whose id can be looked up."""
    none = F.coalesce(F.length(F.trim(body)), F.lit(0)) == 0
    return rows.agg(F.count_if(none).alias("n_missing"), F.count_if(none & F.coalesce(F.col(source_id).rlike("^[0-9]+$"), F.lit(False))).alias("n_fixable"))
