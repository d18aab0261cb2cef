"""First-wins de-duplication (J3 in-batch part, T5).

The reference gets first-wins from one-at-a-time processing in queue order.
Here every row carries a unique, comparable ``seq`` and the winner of a key
is the row with the smallest ``seq``:

    groupBy(key).agg(min_by(struct(row), seq))

One pass over the input (an expensive upstream – page parsing, rule
evaluation – is computed once), and map-side partial aggregation keeps one
row per key per task, so a key holding a third of all rows reaches the
shuffle as one row per map task. Rows whose key is '' are never
de-duplicated: they get a per-row group key, so they are all kept and
spread over tasks instead of meeting on one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.common import hash_marked


def spread_key(key: Column, order: Column) -> Column:
    """``key``, or a per-row key (never equal to a real key) when it is ''."""
    per_row = F.concat(F.lit("\u0000"), F.to_json(F.array(order)))
    return F.when(F.coalesce(key, F.lit("")) == "", per_row).otherwise(key)


def first_wins(df: DataFrame, key: str, order: str = "seq", bypass_empty: bool = False) -> DataFrame:
    """Rows of ``df`` that are first (smallest ``order``) for their ``key``.

    ``bypass_empty``: rows whose key is '' are never de-duplicated (all kept).
    """
    cols = df.columns
    gkey = spread_key(F.col(key), F.col(order)) if bypass_empty else F.col(key)
    return (df.groupBy(gkey.alias("_first_wins_key"))
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_r"))
            .select(*[F.col("_r")[c].alias(c) for c in cols]))


def first_wins_wide(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """``first_wins`` for rows with large columns, such as page bodies.

    A first scan reads the keys alone and finds those that repeat; rows whose key
    surely does not repeat then pass without a shuffle, the others take
    ``first_wins``. With unique keys no large column is moved at all.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    marked = hash_marked(df, repeated, key, "_repeats")
    single = marked.filter(~F.col("_repeats")).drop("_repeats")
    return single.unionByName(first_wins(marked.filter("_repeats").drop("_repeats"), key, order))
