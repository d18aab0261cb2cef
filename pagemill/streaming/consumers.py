"""Several queues shared by several consumers.

Messages are put in numbered steps under ``put=<n>/queue=<name>/shard=<k>``; a message's shard comes
from the MD5 of its key, so equal keys stay together and a hot queue spreads over all shards. The shards are leased
to the members of a group, each to one of them, by files published at one stroke; a member reads the
folders of its shards alone.

A member takes a batch of at most ``limit`` messages in the order of the queues (all of the first queue that are there,
then of the next, as a blocking pop over several keys does), oldest first within a queue. What it
has taken is noted as one mark per queue and shard: the last (put, seq) of it, published with the batch's number.
A batch whose mark was not published is taken again with the same rows, if its queues did not grow; its rows reach
the caller once for each published mark.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.schedule import places
from pagemill.session import cut_lineage, drop_tables
from pagemill.sources.files import names, path_exists, publish_text, read_text

MESSAGE = "value string, key string, seq array<bigint>"


def shard_of(key: Column, shards: int) -> Column:
    """The first 32 bits of the key's MD5 modulo ``shards``; a null key counts as ''."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % shards).cast("int")


class QueueGroup:
    """The queues ``queues`` (highest first) under ``root``, and the members that share them."""

    def __init__(self, spark: SparkSession, root: str, queues: list[str], shards: int = 16):
        self.spark, self.root, self.queues, self.shards = spark, root.rstrip("/"), list(queues), int(shards)

    # --- putting ---------------------------------------------------------------
    def puts(self) -> int:
        return len(names(self.spark, f"{self.root}/puts"))

    def put(self, messages: DataFrame) -> int:
        """Add messages (queue, value, key, seq) as the next step; its number. Messages of other queues are refused."""
        number = self.puts()
        unknown = messages.where(F.col("queue").isNull() | ~F.col("queue").isin(self.queues))
        if not unknown.isEmpty():
            raise ValueError("messages of unknown queues")
        (messages.select("queue", "value", F.col("key").cast("string").alias("key"), F.col("seq").cast("array<bigint>").alias("seq"),
                         shard_of(F.col("key"), self.shards).alias("shard"))
         .write.mode("overwrite").partitionBy("queue", "shard").parquet(f"{self.root}/messages/put={number}"))
        if not publish_text(self.spark, f"{self.root}/puts/{number:09d}", ""):
            raise RuntimeError(f"another writer put messages into {self.root}")
        return number

    # --- leases ----------------------------------------------------------------
    def leases(self) -> dict[int, str]:
        """shard -> member."""
        return {int(n): read_text(self.spark, f"{self.root}/leases/{n}") for n in names(self.spark, f"{self.root}/leases")}

    def lease(self, member: str, members: int) -> list[int]:
        """The shards of a member: free ones are leased to it up to its share of the group's."""
        held = self.leases()
        mine = [k for k, m in held.items() if m == member]
        share = -(-self.shards // members)
        for k in range(self.shards):
            if len(mine) >= share:
                break
            if k not in held and publish_text(self.spark, f"{self.root}/leases/{k:06d}", member):
                mine.append(k)
        return sorted(mine)

    # --- taking ----------------------------------------------------------------
    def _marks(self, member: str) -> tuple[int, dict]:
        found = names(self.spark, f"{self.root}/taken/{member}")
        if not found:
            return 0, {}
        return len(found), json.loads(read_text(self.spark, f"{self.root}/taken/{member}/{found[-1]}"))

    def waiting(self, member: str) -> DataFrame:
        """Messages of the member's shards that it has not taken, with ``put``, ``queue`` and ``shard``."""
        shards = [k for k, m in self.leases().items() if m == member]
        puts = self.puts()
        if not shards or not puts or not path_exists(self.spark, f"{self.root}/messages"):
            return self.spark.createDataFrame([], MESSAGE + ", put int, queue string, shard int")
        rows = (self.spark.read.schema(MESSAGE + ", put int, queue string, shard int").parquet(f"{self.root}/messages")
                .where(F.col("shard").isin(shards) & (F.col("put") < puts)))
        _, marks = self._marks(member)
        if not marks:
            return rows
        # one mark a queue and shard: a table of bounded size
        table = self.spark.createDataFrame([(q, int(k), m[0], m[1]) for q, by in marks.items() for k, m in by.items()],
                                           "_queue string, _shard int, _put int, _seq array<bigint>")
        after = F.struct("put", "seq") > F.struct(F.col("_put").alias("put"), F.col("_seq").alias("seq"))
        rows = rows.join(F.broadcast(table), (F.col("queue") == F.col("_queue")) & (F.col("shard") == F.col("_shard")), "left")
        return rows.where(F.col("_put").isNull() | after).drop("_queue", "_shard", "_put", "_seq")

    def take(self, member: str, limit: int) -> DataFrame | None:
        """The member's next batch (value, key, seq, put, queue, shard, place), a written table; None when nothing
        waits. ``seq`` is unique within a put and queue."""
        written: list = []
        rows = self.waiting(member).withColumn("_order", F.struct("put", "seq"))
        placed = cut_lineage(places(rows, "queue", "_order", written).drop("_order"), written)
        sizes = {r["queue"]: r["n"] for r in placed.groupBy("queue").agg(F.count(F.lit(1)).alias("n")).collect()}
        quota, left = {}, limit
        for q in self.queues:  # all of a queue before any of the next
            quota[q] = (limit - left, min(left, sizes.get(q, 0)))
            left -= quota[q][1]
        if left == limit:
            drop_tables(self.spark, written)
            return None
        table = F.broadcast(self.spark.createDataFrame([(q, a, n) for q, (a, n) in quota.items()], "_queue string, _ahead long, _n long"))
        batch = (placed.join(table, F.col("queue") == F.col("_queue")).where(F.col("place") < F.col("_n"))
                 .withColumn("place", F.col("place") + F.col("_ahead")).drop("_queue", "_ahead", "_n"))
        batch = cut_lineage(batch)
        number, marks = self._marks(member)
        for r in batch.groupBy("queue", "shard").agg(F.max(F.struct("put", "seq")).alias("m")).collect():
            marks.setdefault(r["queue"], {})[str(r["shard"])] = [r["m"]["put"], list(r["m"]["seq"])]
        if not publish_text(self.spark, f"{self.root}/taken/{member}/{number:09d}.json", json.dumps(marks)):
            raise RuntimeError(f"{member} takes messages twice at one time")
        drop_tables(self.spark, written)
        return batch
