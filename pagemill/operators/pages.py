"""Deep pages of a listing (O1, O3): a fence index over its sort order.

``PageIndex.build`` sorts the listing once by ranges and writes each range into its own folder with the
rows' numbers in it, and beside them the fences: for each key (a task, or '' for the whole listing) and range,
how many rows of the key there are in it and before it. A page at any offset then reads the
fences of its key (a filter on a small sorted table) and the one or two ranges that hold it; an
``offset`` on the articles would sort and skip all rows before it.

Content is not copied: with a row stands the file that holds its content, and a page opens the files of its rows.
(Tables without files keep the content with the rows.)

An index stands for one state of the articles. Rows are counted where they lie: no task sees more than one range,
and the sums run over one row a key and range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.operators.queries import LIST_COLUMNS, _listing, _with_content
from pagemill.operators.store import ArticleTables

_FENCES = "_key string, _part int, _first long, _n long, _before long"


class PageIndex:
    """Pages of the articles by (created_at, id), newest first, under ``root``. ``by_task``: of one task at a time,
    else of all. ``include_content``: pages have a column ``content``, '' where there is none."""

    def __init__(self, spark: SparkSession, root: str, by_task: bool = False, include_content: bool = False):
        self.spark, self.root, self.by_task, self.include_content = spark, root.rstrip("/"), by_task, include_content

    def build(self, store: ArticleTables) -> "PageIndex":
        rows = _listing(store.articles)
        if self.include_content and store.content_files is not None:
            held = store.content_files
            rows = rows.join(held, rows["id"] == held["article_id"], "left").drop("article_id")
        elif self.include_content:
            rows = _with_content(store, rows)
        key = F.coalesce(F.col("task_id"), F.lit("")) if self.by_task else F.lit("")
        ordered = rows.withColumn("_key", key).orderBy("_key", F.desc("created_at"), F.desc("id"))
        ordered = ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
        ordered.write.mode("overwrite").partitionBy("_part").parquet(f"{self.root}/rows")  # one range a task and folder
        spans = self.spark.read.parquet(f"{self.root}/rows").groupBy("_key", "_part").agg(
            F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        (spans.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).orderBy("_key", "_part")
         .write.mode("overwrite").parquet(f"{self.root}/fences"))
        return self

    def page(self, offset: int = 0, limit: int = 100, task_id=None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` with their ``place``, in order. Negative numbers count as 0."""
        offset, limit = max(0, int(offset)), max(0, int(limit))
        key = "" if task_id is None else str(task_id)
        fences = self.spark.read.schema(_FENCES).parquet(f"{self.root}/fences")
        held = fences.where((F.col("_key") == key) & (F.col("_before") < offset + limit)
                            & (F.col("_before") + F.col("_n") > offset)).collect()  # ranges that the page touches
        rows = self.spark.read.parquet(f"{self.root}/rows")
        place = F.lit(None).cast("long")
        for r in held:
            place = F.when(F.col("_part") == r["_part"], F.col("_at") - r["_first"] + r["_before"]).otherwise(place)
        within = F.lit(False)
        for r in held:  # rows of the range by their numbers, which its row groups have bounds for
            low = r["_first"] + max(0, offset - r["_before"])
            high = r["_first"] + min(r["_n"], offset + limit - r["_before"])
            within = within | ((F.col("_at") >= low) & (F.col("_at") < high))
        mine = rows.where(F.col("_part").isin([r["_part"] for r in held]) & within).withColumn("place", place)
        listed = ["place", *LIST_COLUMNS]
        if not self.include_content:
            return mine.select(*listed).orderBy("place")
        if "_file" in rows.columns:
            return self._with_files(mine.select(*listed, "_file")).select(*listed, "content").orderBy("place")
        return mine.select(*listed, "content").orderBy("place")

    def _with_files(self, page: DataFrame) -> DataFrame:
        """The rows of a page with their content, from the files that hold it: at most one a row."""
        files = [r["_file"] for r in page.select("_file").distinct().where(F.col("_file").isNotNull()).collect()]
        text = F.coalesce(F.col("content"), F.lit(""))
        if not files:
            return page.withColumn("content", F.lit(""))
        stored = self.spark.read.schema("article_id string, content string").parquet(*files)
        found = stored.join(F.broadcast(page.select(F.col("id").alias("_id"))), F.col("article_id") == F.col("_id")).select(
            "article_id", "content")  # a page of rows
        return page.join(F.broadcast(found), F.col("id") == F.col("article_id"), "left").withColumn("content", text)
