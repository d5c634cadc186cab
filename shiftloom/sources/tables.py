"""Reading: exports, record files, reaction corpora, caches and logs, each with an explicit schema."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import csv_missing
from ..functions.text import embedded_reaction, mixture, reaction_parts, strip_atom_maps


def export_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A raw export with ``row_index``, each row's position in its file."""
    return spark.read.parquet(path).select("*", F.col("_metadata.row_index").alias("row_index"))


def numbered(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Positions of rows read straight from files, in order of file and place: a split's offset comes from the counts of those before it.

    Splits are told by file and first byte, and their rows lie side by side in one partition, so one count a split
    (a few numbers on the driver) places every row.
    """
    marked = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at"))
    splits = marked.groupBy("__file", "__start").agg(F.count("*").alias("n"), F.min("__at").alias("least")).collect()
    offsets, total = [], 0
    for r in sorted(splits, key=lambda r: (r["__file"], r["__start"])):
        offsets.append((r["__file"], r["__start"], total - r["least"]))
        total += r["n"]
    lookup = df.sparkSession.createDataFrame(offsets, "__file string, __start bigint, __shift bigint")
    return marked.join(F.broadcast(lookup), ["__file", "__start"]).withColumn(name, F.col("__at") + F.col("__shift")).drop("__file", "__start", "__at", "__shift")


def _unreadable(encoding: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bad = []
            for line in b.column("value").to_pylist():
                try:
                    line.decode(encoding)
                except UnicodeDecodeError:
                    bad.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.binary())], names=["value"])

    return run


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 if all lines are; else GB18030 if all others are that; else UTF-8, whose bad bytes the reader replaces. Lines are checked apart."""
    lines = spark.read.text(path).where(~F.is_valid_utf8("value")).select(F.col("value").cast("binary").alias("value"))
    if lines.isEmpty():
        return "UTF-8"
    return "GB18030" if lines.mapInArrow(_unreadable("gb18030"), "value binary").isEmpty() else "UTF-8"


def export_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """A CSV export as text columns in the encoding that fits it; reader-level missing tokens are null."""
    encoding = encoding or encoding_of(spark, path)
    if encoding.upper() == "GB18030":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding).csv(path)
    columns = df.columns
    return numbered(df).select(*[csv_missing(F.col(f"`{c}`")).alias(c) for c in columns], "row_index")


def export(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: parquet or pq, csv."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("parquet", "pq"):
        return export_parquet(spark, path)
    if kind == "csv":
        return export_csv(spark, path)
    raise ValueError(f"unsupported source format: {path}")


def jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def strict_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines where a bad line or a non-object raises, naming path and line."""
    lines = numbered(spark.read.text(path), "_line").where(F.trim("value") != "")
    parsed = lines.select("_line", F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"), "value")
    wrong = F.col("r").isNull() | F.col("r._bad").isNotNull() | ~F.ltrim("value").startswith("{")
    message = F.concat(F.lit(f"{path}:"), (F.col("_line") + 1).cast("string"), F.lit(": not a JSON object"))
    checked = parsed.withColumn("r", F.when(wrong, F.raise_error(message).cast(parsed.schema["r"].dataType)).otherwise(F.col("r")))
    return checked.select("r.*").drop("_bad")


def tolerant_cache(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """A cache file: bad lines are ignored, the last entry of a key wins."""
    lines = numbered(spark.read.text(path), "_line")
    good = lines.select("_line", F.from_json("value", schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r")).where("r is not null and r._bad is null")
    return good.groupBy(f"r.{key}").agg(F.max_by("r", "_line").alias("r")).select("r.*").drop("_bad")


def reactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """reactant, product columns with dot-separated components."""
    df = numbered(spark.read.option("header", True).csv(path), "record")
    return df.select("record", F.lit("csv").alias("source"), mixture(F.col("reactant")).alias("reactants"), F.array().cast("array<string>").alias("agents"), mixture(F.col("product")).alias("products"), F.lit(None).cast("string").alias("reference"), F.lit(None).cast("string").alias("class_name"))


def reactions_text(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated: reaction with extension, reference, -, class code, class name; other lines are skipped."""
    f = F.split("value", "\t")
    df = numbered(spark.read.text(path), "record")
    parts = reaction_parts(strip_atom_maps(F.element_at(F.split(F.get(f, 0), " "), 1)))
    return df.select("record", F.lit("text").alias("source"), parts.alias("p"), F.get(f, 1).alias("reference"), F.get(f, 4).alias("class_name")).where("p is not null").select("record", "source", "p.reactants", "p.agents", "p.products", "reference", "class_name")


def reactions_embedded(spark: SparkSession, path: str) -> DataFrame:
    """Parquet texts with a reaction inside; only the text column is read."""
    df = spark.read.parquet(path).select("text", F.col("_metadata.row_index").alias("record"))
    p = reaction_parts(embedded_reaction(F.col("text")))
    return df.select("record", F.lit("embedded").alias("source"), p.alias("p")).where("p is not null").select("record", "source", "p.reactants", F.array().cast("array<string>").alias("agents"), "p.products", F.lit(None).cast("string").alias("reference"), F.lit(None).cast("string").alias("class_name"))


def first_records(df: DataFrame, n: int, position: str = "record") -> DataFrame:
    """The first n records of each source by position (a filter that reaches the scan, not a limit)."""
    return df.where(F.col(position) < n)


def trajectories(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Log lines of all JSON-lines files below a folder, with ``run`` (the parent folder's name); bad lines are skipped."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").option("mode", "DROPMALFORMED").schema(schema).json(root)
    return df.withColumn("run", F.element_at(F.split(F.input_file_name(), "/"), -2))


def load_or_build(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The stored table if it is there, else ``build()`` stored and read again."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if force or not fs.exists(hadoop):
        from .sinks import publish

        publish(build(), path)
    return spark.read.parquet(path)


def at_positions(spark: SparkSession, path: str, schema: str, positions: list[int]) -> DataFrame:
    """Records of a JSON-lines file by position (blank lines do not count): only those lines are parsed."""
    lines = spark.read.text(path)
    full = numbered(lines, "__line").where(F.trim("value") != "")
    if lines.where(F.trim("value") == "").isEmpty():
        placed = full.withColumn("row_id", F.col("__line"))
    else:
        from ..operators.dataset import positions as place

        placed = place(full, ["__line"])
    return placed.where(F.col("row_id").isin(positions)).select("row_id", F.from_json("value", schema).alias("r")).select("row_id", "r.*")
