"""Landing files: JSON payloads written by a fetcher, one document per file or per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default request group and page size of the scoreboard endpoint.
DEFAULT_GROUPS = "50"
DEFAULT_LIMIT = 200

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
RECORD_SCHEMA = (
    "date string, source_url string, parameters string, content_hash string, "
    "raw_data string, created_at timestamp"
)


def date_in_path(path: Column) -> Column:
    """The last ``YYYY-MM-DD`` or ``YYYYMMDD`` of a file name, dashed; empty if none."""
    name = F.substring_index(path, "/", -1)
    digits = F.regexp_extract(name, r"(\d{4})-?(\d{1,2})-?(\d{1,2})[^0-9]*$", 0)
    parts = [F.regexp_extract(digits, r"(\d{4})-?(\d{1,2})-?(\d{1,2})", i) for i in (1, 2, 3)]
    return F.when(digits != "", F.concat_ws("-", *parts)).otherwise("")


def _records(landed: DataFrame, source_url: str) -> DataFrame:
    day = date_in_path(F.col("path"))
    parameters = F.to_json(
        F.struct(
            F.replace(day, F.lit("-"), F.lit("")).alias("dates"),
            F.lit(DEFAULT_GROUPS).alias("groups"),
            F.lit(DEFAULT_LIMIT).alias("limit"),
        )
    )
    return landed.select(
        day.alias("date"),
        F.lit(source_url).alias("source_url"),
        parameters.alias("parameters"),
        F.col("content").cast("string").alias("raw_data"),
        F.col("modificationTime").alias("created_at"),
    )


def read_scoreboard_files(spark: SparkSession, path: str, source_url: str) -> DataFrame:
    """One record per payload file, bytes kept as they landed; the date comes from its name.

    Read as binary: the text source drops a trailing line break and so changes the hash.
    """
    return _records(spark.read.format("binaryFile").load(path), source_url)


def stream_scoreboard_files(
    spark: SparkSession, path: str, source_url: str, max_files: int = 10_000
) -> DataFrame:
    """The same records as a stream of newly landed files."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    return _records(reader.option("maxFilesPerTrigger", max_files).load(path), source_url)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records packed many to a Parquet file: the landing form for large volumes."""
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def stream_records(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    return (
        spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)
    )


def read_team_pages(spark: SparkSession, path: str, source_url: str) -> DataFrame:
    """One record per landed team page; the file name identifies the request."""
    name = F.substring_index("path", "/", -1)
    return spark.read.format("binaryFile").load(path).select(
        F.lit(source_url).alias("source_url"),
        F.to_json(F.struct(name.alias("page"))).alias("parameters"),
        F.col("content").cast("string").alias("raw_data"),
        F.col("modificationTime").alias("created_at"),
    )


def page_completeness(pages: DataFrame, request: str, page: str, page_count: str) -> DataFrame:
    """Per paged request: pages present, pages announced, and whether all are there."""
    # Distinct first: two-level, so one large request does not gather in one task.
    present = pages.groupBy(request, page).agg(F.max(page_count).alias("_announced"))
    return (
        present.groupBy(request)
        .agg(F.count(F.lit(1)).alias("pages_present"), F.max("_announced").alias("pages_announced"))
        .withColumn("complete", F.col("pages_present") == F.col("pages_announced"))
    )
