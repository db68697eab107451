"""Readers: format by extension, text-only reports, paged JSON."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.keys import as_column
from ..operators.reshape import rename_columns, union_all

# The file extensions that are accepted.
EXTENSIONS = [".csv", ".json", ".avro", ".parquet", ".orc", ".dat", ".txt"]

# Report texts that mean "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/").lower())[1]


def read_landed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a landed file or folder by its extension; other extensions are rejected.

    CSV columns stay text. Give a schema for JSON, or Spark reads the data once more to
    infer it.
    """
    ext = extension(path)
    if ext not in EXTENSIONS:
        raise ValueError(f"file type {ext or path!r} is not allowed; allowed: {', '.join(EXTENSIONS)}")
    reader = spark.read.schema(schema) if schema is not None and ext not in (".dat", ".txt") else spark.read
    if ext == ".csv":
        return reader.option("header", True).csv(path)
    if ext == ".json":
        return reader.json(path)
    if ext == ".parquet":
        return reader.parquet(path)
    if ext == ".orc":
        return reader.orc(path)
    if ext in (".dat", ".txt"):
        return reader.text(path)
    try:
        return reader.format("avro").load(path)
    except AnalysisException as err:
        raise RuntimeError("reading .avro needs the spark-avro package on the classpath") from err


def read_report(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV reports with their own headers, as text under the union of normalised names.

    Each path is a file, folder or glob. Files are grouped by their header line, which one job finds for all of
    them, so unlike headers under one path are united by name. Line breaks inside quotes need ``multi_line``;
    large files are split either way.
    """
    lines = _report_lines(spark, paths)
    heads = lines.where("block = 0").groupBy("file").agg(F.rtrim(F.min_by("value", "n"), F.lit("\r")).alias("header"))
    groups = heads.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect()
    options = {"header": True, "escape": '"'}
    tables = []
    for header, files in groups:
        # names as the CSV reader makes them: repeated and empty ones are told apart
        names = spark.read.options(**options).csv(spark.sparkContext.parallelize([header], 1)).columns
        if multi_line:
            own = _report_records(lines.where(F.col("file").isin(files))).where((F.col("number") > 1) & (F.trim("record") != ""))
            schema = ", ".join(f"c{i} string" for i in range(len(names)))
            rows = own.select(F.from_csv("record", F.lit(schema), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
            rows = rows.select("r.*").toDF(*names)
        else:
            rows = spark.read.options(**options, enforceSchema=False).csv(sorted(files))
        tables.append(rename_columns(rows, "report"))
    return blank_missing(union_all(tables))


def _report_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of all files with their file, the block of it that a task reads, and a number that orders them in the block."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )


def _report_records(lines: DataFrame) -> DataFrame:
    """CSV records (``file, number, record``) from lines, some of which end inside quotes.

    A line begins a record if the quotes before it in the file are even in number. Each block counts its own quotes and,
    for either parity it may begin with, its records; sums over a file's blocks, a few rows, then give every
    block its parity and its first record's number. A record may span blocks.
    """
    in_block = Window.partitionBy("file", "block").orderBy("n")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("quotes", quotes)
    counted = counted.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    blocks = counted.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("all_odd"), F.sum(1 - F.col("odd")).alias("if_even"), F.sum("odd").alias("if_odd")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("begins_odd", F.coalesce(F.sum("all_odd").over(before), F.lit(0)) % 2)
    own = F.when(F.col("begins_odd") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    blocks = blocks.withColumn("records_before", F.coalesce(F.sum(own).over(before), F.lit(0)))
    placed = counted.join(blocks.select("file", "block", "begins_odd", "records_before"), ["file", "block"])
    starts = 1 - (F.col("odd") + F.col("begins_odd")) % 2
    numbered = placed.withColumn("number", F.col("records_before") + F.sum(starts).over(in_block))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "value"))), lambda line: line["value"])
    return numbered.groupBy("file", "number").agg(F.rtrim(F.array_join(parts, "\n"), F.lit("\r")).alias("record"))


def blank_missing(df: DataFrame, tokens: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Text columns with the missing-value texts as NULL."""
    return df.select(
        *(
            F.when(~F.col(f.name).isin(*tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


PAGE_SCHEMA = "page long, data array<string>, _broken string"

# What to do with a page that is no JSON document with a ``data`` array.
ON_BROKEN = ["error", "skip", "keep"]
# The place of a page that is kept though it does not parse.
BROKEN = -1


def landed_text(reader) -> DataFrame:
    """Lines of a text reader with ``fetch``, which orders the files they landed in."""
    landed = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
    return reader.select("value", landed.alias("fetch"))


def read_pages(spark: SparkSession, path: str, whole_files: bool = False, on_broken: str = "error") -> DataFrame:
    """Landed API pages as ``fetch, page, pos, raw``: one JSON document per line, or per file
    with ``whole_files`` (indented documents)."""
    text = landed_text(spark.read.text(path, wholetext=whole_files))
    return page_objects(text, "value", "fetch", on_broken=on_broken)


def _parsed_pages(pages: DataFrame, text: str | Column, *keep: str) -> DataFrame:
    parsed = F.from_json(as_column(text), PAGE_SCHEMA, {"columnNameOfCorruptRecord": "_broken"})
    known = pages.select(*keep, as_column(text).alias("_text"), parsed.alias("_p")).where(F.trim("_text") != "")
    return known.withColumn("_bad", F.col("_p").isNull() | F.col("_p._broken").isNotNull() | F.col("_p.data").isNull())


def page_objects(pages: DataFrame, text: str | Column, *keep: str, on_broken: str = "error") -> DataFrame:
    """One row per object of each page's ``data`` array, with its JSON text as ``raw``.

    A page that does not parse, or has no ``data``, fails the job, is skipped, or is kept as one row, its text at
    the place ``BROKEN``; ``broken_pages`` lists such pages. Blank lines are no pages.
    """
    if on_broken not in ON_BROKEN:
        raise ValueError(f"unknown on_broken {on_broken!r}; known: {ON_BROKEN}")
    parsed = _parsed_pages(pages, text, *keep)
    data = F.col("_p.data")
    if on_broken == "error":
        failed = F.raise_error(F.concat(F.lit("landed page does not parse: "), F.left("_text", F.lit(200))))
        data = F.when(F.col("_bad"), failed.cast("array<string>")).otherwise(data)
    elif on_broken == "skip":
        parsed = parsed.where(~F.col("_bad"))
    else:
        data = F.when(F.col("_bad"), F.array("_text")).otherwise(data)
        place = F.when(F.col("_bad"), F.lit(BROKEN)).otherwise(F.col("pos")).alias("pos")
        listed = parsed.select(*keep, "_bad", F.col("_p.page").alias("page"), F.posexplode(data).alias("pos", "raw"))
        return listed.select(*keep, "page", place, "raw")
    return parsed.select(*keep, F.col("_p.page").alias("page"), F.posexplode(data).alias("pos", "raw"))


def broken_pages(pages: DataFrame, text: str | Column, *keep: str) -> DataFrame:
    """The pages that ``page_objects`` cannot read, with their text."""
    return _parsed_pages(pages, text, *keep).where("_bad").select(*keep, F.col("_text").alias("text"))
