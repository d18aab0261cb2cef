"""Exact de-duplication with a heavy-hitter split.

Texts are equal when identical after deleting the white-space characters
``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code points in the
original text stays, then the one with the smallest id (a null id comes last).

1. One narrow table is written: (id, digest, code points) per row.
2. Misra-Gries summaries of the digests, one per task and merged by digest,
   name the digests that may be frequent: at most ``counters`` of them, and
   surely each digest with over ``1 / counters`` of a task's rows.
3. For those alone the winners and exact group sizes are computed from the
   narrow table (partial aggregation) and broadcast: at most ``counters`` rows
   whatever the input. Their rows are decided map-side, without a shuffle.
4. The remaining digests, none of which is frequent, take the ordinary
   shuffle: aggregate per digest, join back.

Cases: a null text is the empty text, and all empty or blank texts form one
group. Rows repeated with the same id and text form one group of which one
row stays. Of rows tied in length and id exactly one stays. Empty tables give
empty results. Extra columns, also with clashing names, pass through
``drop_duplicates`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_or_empty, tmp_name

COUNTERS = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def frequent_digests(narrow: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests: merged Misra-Gries summaries of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for d in batch.column(0).to_pylist():
                if d in held:
                    held[d] += 1
                elif len(held) < counters:
                    held[d] = 1
                else:  # full: every counter gives one up
                    held = {k: n - 1 for k, n in held.items() if n > 1}
        # a digest seen once or twice in a task is not worth a broadcast slot
        rows = [(d, n) for d, n in held.items() if n > 2]
        yield pa.RecordBatch.from_pydict({"digest": pa.array([d for d, _ in rows], pa.binary()),
                                          "seen": pa.array([n for _, n in rows], pa.int64())})

    return (narrow.select("digest").mapInArrow(run, "digest binary, seen long")
            .groupBy("digest").agg(F.sum("seen").alias("seen"))
            .orderBy(F.desc("seen"), "digest").limit(counters).select("digest"))


def _winner(uid: str = "uid") -> list[Column]:
    """Longest original text first, then smallest id (null last), then row."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("z"), F.col("id"), F.col(uid)))
    return [best.alias("w"), F.count(F.lit(1)).alias("group_size")]


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest, n (code points)."""
    text = text_or_empty(df[text_col])
    narrow = cut_lineage(df.select(df[id_col].alias("id"), digest_of(text).alias("digest"),
                                   F.length(text).alias("n"), F.monotonically_increasing_id().alias("uid")))
    candidates = F.broadcast(frequent_digests(narrow, counters))
    heavy_winners = cut_lineage(narrow.join(candidates, "digest", "left_semi").groupBy("digest").agg(*_winner()))
    heavy = narrow.join(F.broadcast(heavy_winners), "digest")  # at most `counters` rows are broadcast
    light = narrow.join(F.broadcast(heavy_winners.select("digest")), "digest", "left_anti")
    light = light.join(light.groupBy("digest").agg(*_winner()), "digest")
    return heavy.unionByName(light).select(
        "id", F.col("w.id").alias("keep_id"), "group_size", (F.col("uid") == F.col("w.uid")).alias("kept"),
        "digest", "n")


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    counters: int = COUNTERS) -> DataFrame:
    """``df`` with one row of each group of equal texts, all columns kept as they are."""
    decided = cut_lineage(exact_duplicates(df, id_col, text_col, counters))
    kd, ki, kn = tmp_name(df, "digest"), tmp_name(df, "id"), tmp_name(df, "n")
    lost = decided.where("not kept").select(
        F.col("digest").alias(kd), F.col("id").alias(ki), F.col("n").alias(kn)).distinct()
    # rows that equal the row that stays in id and text: only one of them may stay
    stays = decided.where("kept").select(F.col("digest").alias(kd), F.col("id").alias(ki), F.col("n").alias(kn))
    tied = cut_lineage(lost.join(stays, on=(lost[kd] == stays[kd]) & lost[ki].eqNullSafe(stays[ki])
                                 & (lost[kn] == stays[kn]), how="left_semi"))
    text = text_or_empty(df[text_col])
    wide = df.withColumns({kd: digest_of(text), kn: F.length(text)})

    def match(other: DataFrame) -> Column:
        return ((wide[kd] == other[kd]) & wide[id_col].eqNullSafe(other[ki]) & (wide[kn] == other[kn]))

    once = wide.join(lost, match(lost), "left_anti")
    if tied.take(1):
        repeated = wide.join(tied, match(tied), "left_semi").dropDuplicates([kd])
        once = once.unionByName(repeated)
    return once.drop(kd, kn)
