"""The persistent filter of requested urls (T4) and its table of keys.

``SeenUrls`` holds the link hashes of all requested urls as bucketed runs, one a round,
with Parquet bloom filters on the key for look-ups of single urls. A round moves its
own requests alone: they are dealt as the buckets are and anti-joined with them, and
its new keys become the next run. Older keys are rewritten only when runs are folded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.hashing import link_hash
from pagemill.operators.dedup import first_wins
from pagemill.session import cut_lineage
from pagemill.sources.runs import BucketedRuns


class SeenUrls(BucketedRuns):
    """Keys of the urls requested so far, under ``root`` (any storage of Spark's)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, fanout: int = 4):
        # adaptive: a file's filter is as large as its keys ask for, so a small run's files stay small
        super().__init__(spark, root, "key string", "key", buckets, fanout, {
            "parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.bloom.filter.candidates.number#key": "14"})

    def admit(self, requests: DataFrame, round_id: int, written: list | None = None) -> DataFrame:
        """The requests of a round that may be made: of each url the first one (smallest ``seq``), if no earlier round
        had it; those with ``dont_filter`` always, and they are not noted. The admitted urls are noted as run ``round_id``.

        A round that is repeated sees the rounds before it, not itself, so it admits the same requests again. Runs of
        earlier rounds are folded before the round looks them up. A url that a third of all requests ask for is reduced
        to one row a task before the shuffle. Requests without a url have the key '' and are no request: they go.
        """
        free = F.coalesce(F.col("dont_filter"), F.lit(False))
        if not self.has(round_id):
            self.fold()
        before = [r for r in self.runs() if r.last < round_id]
        asked = requests.where(~free).withColumn("_key", link_hash(F.col("url"))).where(F.col("_key") != "")
        fresh = self.placed(first_wins(asked, "_key", "seq"), "_key")
        stored = self.read(before)
        fresh = cut_lineage(fresh.join(stored, fresh["_key"] == stored["key"], "left_anti"), written)
        self.append(fresh.select(F.col("_key").alias("key")), round_id)
        return requests.where(free & (F.coalesce(F.col("url"), F.lit("")) != "")).unionByName(fresh.drop("_key"))

    def contains(self, urls: list[str]) -> set[str]:
        """Which of a few urls were requested. The keys are literals of the scan, so files whose range or bloom
        filter excludes them are not read; for many urls use a join."""
        keys = {r["k"]: r["u"] for r in self.spark.createDataFrame([(u,) for u in urls], "u string").select(
            "u", link_hash(F.col("u")).alias("k")).collect()}
        found = self.read().where(F.col("key").isin(list(keys))).distinct().collect()
        return {keys[r["key"]] for r in found}
