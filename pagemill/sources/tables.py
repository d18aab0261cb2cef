"""Readers for parquet tables and adapters from the corpus tables.

Adapters (all are plain projections, no shuffle):
  pages      -> page snapshot (url -> html) and fetched responses
  documents  -> article items (task_id = source, content = text,
                link = canonical link of the text, title = first line)
  events     -> queue messages (one JSON payload per event)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.common import empty_map
from pagemill.functions.hashing import md5_or_empty

# fixed values: how document rows are presented as articles
DOC_LINK_PREFIX = "https://docs.example.org/"
DOC_SOURCE_URL = "https://{source}.example.com/"
DOC_EPOCH = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the scan splits them (``spark.sql.files.maxPartitionBytes``): no shuffle of bodies."""
    return read_table(spark, sf_dir, "pages")


def responses_from_pages(pages: DataFrame, workflow_index: int = 0,
                         context: Column | None = None) -> DataFrame:
    """Fetched responses straight from a page table (status 200, seq [0, page_id])."""
    return pages.select(
        F.col("page_id"),
        F.col("url"),
        F.lit(200).alias("status"),
        F.lit(200).alias("http_status"),
        empty_map().alias("headers"),
        F.col("html").alias("body"),
        F.struct(F.lit(workflow_index).cast("int").alias("workflow_index"),
                 (context if context is not None else empty_map()).alias("context"),
                 F.lit(None).cast("map<string,string>").alias("params"),
                 F.lit(None).cast("string").alias("encoding")).alias("meta"),
        F.array(F.lit(0).cast("long"), F.col("page_id").cast("long")).alias("seq"),
    )


def doc_link(text: Column, lang: Column) -> Column:
    return F.concat(F.lit(DOC_LINK_PREFIX), lang, F.lit("/"), md5_or_empty(text))


def doc_created_at(doc_id: Column) -> Column:
    return (F.lit(DOC_EPOCH).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), doc_id.cast("decimal(18,6)")))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Article items in arrival order ``seq = [0, doc_id]``."""
    return documents.select(
        F.col("doc_id"),
        F.col("source").alias("task_id"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        doc_link(F.col("text"), F.col("lang")).alias("link"),
        F.col("text").alias("content"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/")).alias("source_url"),
        F.to_json(F.create_map(F.lit("lang"), F.col("lang"))).alias("extra"),
        doc_created_at(F.col("doc_id")).alias("created_at"),
        F.array(F.lit(0).cast("long"), F.col("doc_id").cast("long")).alias("seq"),
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """Queue messages: queue = event_type, value = props JSON text, seq = event order."""
    return events.select(
        F.col("event_type").alias("queue"),
        F.col("props").alias("value"),
        F.col("ts"),
        F.array(F.lit(0).cast("long"), F.col("event_id").cast("long")).alias("seq"),
    )
