"""Small shared column helpers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def empty_map(type_: str = "map<string,string>") -> Column:
    """An empty typed map literal (built lazily: needs an active session)."""
    return F.create_map().cast(type_)


def hash_marked(rows: DataFrame, wanted: DataFrame, column: str, flag: str, bits: int = 1 << 23) -> DataFrame:
    """``rows`` with a boolean ``flag``: false where ``column`` is surely not in ``wanted``.

    A bitmap of hashes, of a fixed size that is safe to broadcast. It marks all
    wanted rows, and some others when it fills up, so an exact step must follow.
    """
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    words = wanted.select(at.alias("at")).groupBy(F.expr("at div 64").alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("__bits"))
    return (rows.withColumn("__at", at).join(F.broadcast(words), F.expr("__at div 64 = __word"), "left")
            .withColumn(flag, F.coalesce(F.expr("shiftright(__bits, cast(__at % 64 as int)) & 1 = 1"), F.lit(False)))
            .drop("__at", "__word", "__bits"))


#: Least and most bits of a ``HashBitmap``, and bits for each of its keys.
BITMAP_BITS = (1 << 16, 1 << 27)
BITS_PER_KEY = 32


class HashBitmap:
    """Hashes of the keys in ``column`` of ``keys`` as a bitmap sized by their number: built by Spark, held by the
    driver (at most 16 MB) and broadcast. Beyond some four million keys more rows are marked falsely; what is
    surely not among the keys is never marked."""

    def __init__(self, keys: DataFrame, column: str):
        spark = keys.sparkSession
        n = keys.count()
        self.bits = BITMAP_BITS[0]
        while self.bits < min(n * BITS_PER_KEY, BITMAP_BITS[1]):
            self.bits *= 2
        at = F.pmod(F.xxhash64(column), F.lit(self.bits))
        words = keys.select(at.alias("at")).groupBy(F.expr("at div 64").alias("__word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("__bits")) if n else None
        self.words = spark.createDataFrame(words.toArrow()) if n else None

    def mark(self, rows: DataFrame, column: str, flag: str) -> DataFrame:
        """``rows`` with a boolean ``flag``: false where ``column`` is surely not among the keys."""
        if self.words is None:
            return rows.withColumn(flag, F.lit(False))
        at = F.pmod(F.xxhash64(column), F.lit(self.bits))
        return (rows.withColumn("__at", at).join(F.broadcast(self.words), F.expr("__at div 64 = __word"), "left")
                .withColumn(flag, F.coalesce(F.expr("shiftright(__bits, cast(__at % 64 as int)) & 1 = 1"), F.lit(False)))
                .drop("__at", "__word", "__bits"))
