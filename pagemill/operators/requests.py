"""Request rows: construction, defaults, decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.functions.common import empty_map


def request_columns(url: Column, headers: Column, workflow_index: Column, context: Column,
                    dont_filter: Column, seq: Column, method: Column | None = None,
                    params: Column | None = None, encoding: Column | None = None,
                    attempt: Column | None = None) -> list[Column]:
    null_map = F.lit(None).cast("map<string,string>")
    return [
        url.alias("url"),
        (method if method is not None else F.lit("GET")).alias("method"),
        headers.alias("headers"),
        F.struct(
            workflow_index.cast("int").alias("workflow_index"),
            context.alias("context"),
            (params if params is not None else null_map).alias("params"),
            (encoding if encoding is not None else F.lit(None).cast("string")).alias("encoding"),
        ).alias("meta"),
        null_map.alias("params"),
        F.lit(None).cast("string").alias("data"),
        F.lit(None).cast("string").alias("json"),
        dont_filter.alias("dont_filter"),
        seq.cast("array<bigint>").alias("seq"),
        (attempt if attempt is not None else F.lit(0)).cast("int").alias("attempt"),
    ]


def empty_requests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.REQUEST)


def requests_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Seed requests from a (small, driver-built) list such as ``seed_request``."""
    out = []
    for i, r in enumerate(rows):
        meta = r.get("meta") or {}
        out.append((r["url"], (r.get("method") or "GET").upper(), r.get("headers") or {},
                    (meta.get("workflow_index", 0), meta.get("context") or {},
                     meta.get("params"), meta.get("encoding")),
                    r.get("params"), r.get("data"), r.get("json"),
                    bool(r.get("dont_filter", False)), [0, i], 0))
    return spark.createDataFrame(out, schemas.REQUEST)


def seeds_from_urls(urls: DataFrame, url_col: str = "url", order_col: str | None = None,
                    context: Column | None = None, workflow_index: int = 0) -> DataFrame:
    """A table of start URLs -> requests at ``workflow_index`` (seq = [0, order])."""
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    return urls.select(*request_columns(
        url=F.col(url_col), headers=empty_map(), workflow_index=F.lit(workflow_index),
        context=context if context is not None else empty_map(),
        dont_filter=F.lit(False), seq=F.array(F.lit(0).cast("long"), order.cast("long")),
    ))


def normalize_requests(df: DataFrame) -> DataFrame:
    """S6 defaults: method upper-cased (default GET), headers/meta default empty,
    requests without a url dropped (F2: skipped, not dead-lettered)."""
    return (df.filter(F.coalesce(F.col("url"), F.lit("")) != "")
            .withColumn("method", F.upper(F.coalesce(F.nullif(F.col("method"), F.lit("")), F.lit("GET"))))
            .withColumn("headers", F.coalesce(F.col("headers"), empty_map()))
            .withColumn("meta", F.struct(
                F.coalesce(F.col("meta.workflow_index"), F.lit(0)).alias("workflow_index"),
                F.coalesce(F.col("meta.context"), empty_map()).alias("context"),
                F.col("meta.params").alias("params"),
                F.col("meta.encoding").alias("encoding")))
            .withColumn("dont_filter", F.coalesce(F.col("dont_filter"), F.lit(False))))
