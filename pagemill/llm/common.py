"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.common import hash_marked
from pagemill.session import cut_lineage

__all__ = ["bounded_batches", "connected_components", "counted_marked", "cut_lineage", "hash_marked", "hash_thinned", "map_rows", "read_table", "released", "text_or_empty", "tmp_name"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 512, size: int = 16 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and ``size`` bytes between Spark and its Python workers,
    where the session allows larger ones: by default a batch has 10,000 rows, whatever their texts' length,
    and both sides hold several of them."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        now = re.match(r"(\d+)b?$", spark.conf.get(key) or "")  # bytes may come with their unit
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def tmp_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; at its end freed memory goes back to the system. Python workers are
    used again by later tasks, and else keep the peak of every one of them."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library is glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], Iterable[tuple]]], schema: str) -> DataFrame:
    """``mapInArrow`` with columns in and tuples out.

    ``make()`` is called once per task and returns a function from the
    columns of a slice (name -> list) to output tuples. Slices hold at most
    256 rows, so the Python objects alive at one time stay few.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(fields)
        each = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                rows = list(each(cols))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), out_schema, strict=True)],
                        schema=out_schema)

    return df.mapInArrow(lambda batches: released(run(batches)), fields)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for the nodes of ``edges``; component is the smallest node.

    Alternating large-star / small-star steps: each is one or two shuffles
    with partial aggregation, no step gathers a component in one task, and
    the number of rounds grows with the logarithm of the component size. The
    edge list is written to the shared folder after each round.
    """
    cur = cut_lineage(edges.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    while True:
        # large star: every larger neighbour of u is tied to u's smallest neighbour (or u)
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u != v")
        # small star: of each v, the smaller neighbours are tied to the smallest one
        small_low = large.distinct()
        low2 = small_low.groupBy("v").agg(F.min("u").alias("m"))
        small = (small_low.join(low2, "v")
                 .select(F.col("m").alias("u"), F.when(F.col("u") == F.col("m"), F.col("v"))
                         .otherwise(F.col("u")).alias("v"))
                 .unionByName(low2.select(F.col("m").alias("u"), "v")).where("u != v").distinct())
        nxt = cut_lineage(small)
        # stable when every v has one parent and no parent is itself a child
        multi = nxt.groupBy("v").count().where("count > 1").limit(1)
        chained = nxt.select(F.col("u").alias("v")).join(nxt.select("v"), "v", "left_semi").limit(1)
        if not multi.unionByName(chained.withColumn("count", F.lit(1).cast("long"))).take(1):
            break
        cur = nxt
    return (nxt.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionByName(nxt.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()))


def counted_marked(rows: DataFrame, wanted: DataFrame, column: str, flag: str) -> DataFrame:
    """``hash_marked`` with a bitmap sized by the number of ``wanted`` rows (a written table: it is read twice):
    32 bits for each, 16 MB at most."""
    n = wanted.count()
    return hash_marked(rows, wanted, column, flag, 1 << min(max((32 * n).bit_length(), 16), 27))


def hash_thinned(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in ``wanted``, to thin a scan before
    an exact join."""
    return hash_marked(rows, wanted, column, "__wanted").where("__wanted").drop("__wanted")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
