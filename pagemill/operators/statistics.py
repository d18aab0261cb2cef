"""Statistics per task, kept up to date by partial results.

Each batch adds one partial row a task: its count, its latest time and a sketch of its link hashes (HyperLogLog of
``2^LG_K`` registers, a relative standard error of about 1.04 / sqrt(2^LG_K)). Statistics are the sum, the maximum and the union of
the partials, so they cost tasks times batches and not the articles; partials are folded as ``BucketedRuns`` folds
its runs. Deleting a task puts a reset: partials of earlier runs no longer count. When a single article is deleted its
task is recounted from the store (a reset and a new partial), as a maximum cannot be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.runs import BucketedRuns

LG_K = 12


class TaskStatistics(BucketedRuns):
    def __init__(self, spark: SparkSession, root: str, buckets: int = 8, fanout: int = 8):
        super().__init__(spark, root, "task_id string, round int, reset boolean, n long, latest timestamp_ntz, links binary",
                         "task_id", buckets, fanout)

    def _partials(self, articles: DataFrame, run_id: int, reset: Column) -> DataFrame:
        return (articles.groupBy("task_id").agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("latest"),
                                                F.hll_sketch_agg("link_hash", LG_K).alias("links"))
                .withColumns({"round": F.lit(run_id), "reset": reset}))

    def add(self, articles: DataFrame, run_id: int):
        """The new articles (task_id, link_hash, created_at) of a batch; a batch that was added before changes nothing."""
        return self.append(self._partials(articles, run_id, F.lit(False)), run_id)

    def drop_task(self, task_id, run_id: int):
        """The task's articles are gone."""
        empty = self.spark.createDataFrame([(str(task_id), run_id, True, 0, None, None)], self.schema)
        return self.append(empty, run_id)

    def recount(self, task_id, articles: DataFrame, run_id: int):
        """The task has just the given articles (some of them were deleted)."""
        mine = articles.where(F.col("task_id") == F.lit(str(task_id)))
        if mine.isEmpty():
            return self.drop_task(task_id, run_id)
        return self.append(self._partials(mine, run_id, F.lit(True)), run_id)

    def _folded(self, rows: DataFrame) -> DataFrame:
        """One row a task. The rows of a task in all runs are few (one a run), so its last reset is found by an
        aggregate and joined back in the buckets."""
        resets = rows.where("reset").groupBy("task_id").agg(F.max("round").alias("_since")).withColumnRenamed("task_id", "_task")
        kept = rows.join(resets, F.col("task_id") == F.col("_task"), "left").where(
            F.col("_since").isNull() | (F.col("round") >= F.col("_since")))
        return kept.groupBy("task_id").agg(
            F.coalesce(F.max("_since"), F.min("round")).alias("round"), F.max("_since").isNotNull().alias("reset"),
            F.sum("n").alias("n"), F.max("latest").alias("latest"), F.hll_union_agg("links").alias("links"))

    def fold_rows(self, rows: DataFrame) -> DataFrame:
        return self._folded(rows)

    def statistics(self) -> DataFrame:
        """Per task: exact count, latest time, and the estimated number of distinct links; latest first."""
        return (self._folded(self.read()).where(F.col("n") > 0)
                .select("task_id", F.col("n").alias("article_count"), F.col("latest").alias("latest_created_at"),
                        F.hll_sketch_estimate("links").alias("distinct_links"))
                .orderBy(F.col("latest_created_at").desc_nulls_last()))
