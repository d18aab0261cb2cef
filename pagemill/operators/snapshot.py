"""The page snapshot as a table clustered by url.

Pages are bucketed runs (``sources.runs``): the pages of a round are appended as a delta
with the same buckets, and a fetch deals the round's requests as the buckets are and
joins them in place, so no page is moved however many there are. Of several
versions of a url the one of the latest round answers.

A url that very many requests ask for would put them into one bucket's task. Such urls
(more than a quarter of an average bucket's requests; so there are at most four
times as many as buckets) are taken out: their pages alone are copied ``SALTS`` times
and their requests dealt over the copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.dedup import first_wins_wide
from pagemill.sources.runs import BucketedRuns

#: Copies of a page that very many requests ask for, and the fewest requests that make it one.
SALTS = 32
MANY = 1000


def _same(a: Column, b: Column) -> Column:
    """Equality as a condition beside the join's key: as a second key it would ask for a partitioning by both, and
    so for an exchange of the pages."""
    return (a - b) == 0


class ClusteredSnapshot(BucketedRuns):
    """Pages (url, html, status, headers, content) by url, under ``root``.

    ``with_content``: raw bytes are kept and decoded when fetched; else the html is the text as it is.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, fanout: int = 4, with_content: bool = False):
        super().__init__(spark, root, "url string, round int, html string, status int, headers map<string,string>, "
                                      "content binary", "url", buckets, fanout)
        self.with_content = with_content

    def merge(self, pages: DataFrame, round_id: int, version_col: str = "page_id"):
        """Add the pages of a round (url, html or content[, status, headers]); of one url the highest version. Pages
        without a url go: no request can ask for them. A null version is lower than any other."""
        kinds = {"html": "string", "status": "int", "headers": "map<string,string>", "content": "binary"}
        have = [F.col(c).cast(t).alias(c) if c in pages.columns else F.lit(200 if c == "status" else None).cast(t).alias(c)
                for c, t in kinds.items()]
        rank = -F.coalesce(F.col(version_col).cast("long"), F.lit(-(1 << 62)))
        rows = pages.where(F.col("url").isNotNull()).select("url", F.lit(round_id).alias("round"), *have, rank.alias("_rank"))
        return self.append(first_wins_wide(rows, "url", "_rank").drop("_rank"), round_id)

    def newest(self, rows: DataFrame | None = None) -> DataFrame:
        """(url, round) of the page that answers for each url: reads two columns, in the buckets."""
        return (self.read() if rows is None else rows).groupBy("url").agg(F.max("round").alias("round"))

    def fold_rows(self, rows: DataFrame) -> DataFrame:
        last = self.newest(rows).select(F.col("url").alias("_url"), F.col("round").alias("_round"))
        kept = rows.join(last.hint("shuffle_hash"), (F.col("url") == F.col("_url")) & _same(F.col("round"), F.col("_round")))
        return kept.select(*self.columns)

    def _crowded(self, requests: DataFrame) -> list[str]:
        counts = requests.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
        many = counts.where(F.col("n") >= MANY)
        if many.isEmpty():
            return []
        least = max(MANY, requests.count() // (4 * self.buckets))
        return [r["url"] for r in many.where(F.col("n") > least).collect()]  # fewer than 4 * buckets

    def answers(self, requests: DataFrame) -> DataFrame:
        """Every request with the page that answers it: ``_surl``, ``_html``, ``_code``, ``_hdrs`` and, with content,
        ``_content``; all null where there is none. ``requests`` (with a url) should be a written table: it is read for a
        count of its urls and for the join."""
        spark = requests.sparkSession
        pages = self.read().select(F.col("url").alias("_surl"), F.col("round").alias("_at"), F.col("html").alias("_html"),
                                   F.col("status").alias("_code"), F.col("headers").alias("_hdrs"),
                                   *([F.col("content").alias("_content")] if self.with_content else []))
        last = self.newest().select(F.col("url").alias("_known"), F.col("round").alias("_round"))
        crowded = self._crowded(requests)
        if crowded:
            urls = F.broadcast(spark.createDataFrame([(u,) for u in crowded], "_crowd string"))
            salted = F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int")
            busy = requests.join(urls, F.col("url") == F.col("_crowd"), "left_semi").withColumn("_salt", salted)
            copies = (pages.join(last, (F.col("_surl") == F.col("_known")) & (F.col("_at") == F.col("_round")))
                      .join(urls, F.col("_surl") == F.col("_crowd"), "left_semi")
                      .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
            busy = busy.join(copies, (F.col("url") == F.col("_surl")) & (F.col("_salt") == F.col("_copy")), "left").drop(
                "_salt", "_copy", "_known", "_round", "_at")
            requests = requests.join(urls, F.col("url") == F.col("_crowd"), "left_anti")
        marked = self.placed(requests, "url").join(last, F.col("url") == F.col("_known"), "left")
        # the requests of a bucket are the built side, so its pages stream by unsorted
        found = marked.hint("shuffle_hash").join(
            pages, (F.col("url") == F.col("_surl")) & _same(F.col("_round"), F.col("_at")), "left")
        found = found.drop("_known", "_round", "_at")
        return found.unionByName(busy) if crowded else found
