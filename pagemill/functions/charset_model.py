"""A statistical charset guess (X14): log-likelihoods of byte pairs.

Training counts, for each charset, how often each pair of neighbouring bytes occurs in sample texts in that
charset (NumPy within tasks, sums by Spark); the model is the table of smoothed log shares, 65,536 numbers a
charset whatever the samples. A text is guessed by the sum over its pairs, among the charsets in which its bytes
are valid; pairs of ASCII bytes say nothing about the charset and are left out, so a text without other bytes is not
guessed. The confidence is the best charset's share of the likelihoods, per pair, so it does not saturate with length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS = 1 << 16
#: Pairs looked up at one time.
AT_ONCE = 1 << 20
#: Added to each count.
SMOOTHING = 0.05


def _pairs(content: bytes) -> Iterator[np.ndarray]:
    """Pairs of bytes of which one is not ASCII, some at a time."""
    codes = np.frombuffer(content, np.uint8)
    for at in range(0, max(0, len(codes) - 1), AT_ONCE):
        part = codes[at:at + AT_ONCE + 1].astype(np.int64)
        first, second = part[:-1], part[1:]
        yield ((first << 8) | second)[(first | second) >= 128]


def pair_counts(samples: DataFrame, content: str = "content", charset: str = "charset") -> DataFrame:
    """(charset, pair, n) over all sample texts; rows without content or charset take no part."""

    def count(batches):
        total: dict = {}
        for batch in batches:
            for raw, name in zip(batch.column(0), batch.column(1).to_pylist()):
                held = total.setdefault(name, np.zeros(PAIRS, np.int64))
                for pairs in _pairs(raw.as_py()):
                    held += np.bincount(pairs, minlength=PAIRS)
        for name, held in total.items():
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)),
                                              pa.array(held[some])], names=["charset", "pair", "n"])

    known = samples.where(F.col(content).isNotNull() & F.col(charset).isNotNull()).select(content, charset)
    return known.mapInArrow(count, "charset string, pair int, n long").groupBy("charset", "pair").agg(F.sum("n").alias("n"))


class CharsetModel:
    """Charsets by name, and the log share of each byte pair in each."""

    def __init__(self, charsets: list[str], logs: np.ndarray):
        self.charsets, self.logs = charsets, logs

    @staticmethod
    def train(samples: DataFrame, content: str = "content", charset: str = "charset") -> "CharsetModel":
        found = pair_counts(samples, content, charset).toArrow()  # at most 65,536 rows a charset
        names = sorted(set(found["charset"].to_pylist()))
        counts = np.zeros((len(names), PAIRS))
        at = {n: i for i, n in enumerate(names)}
        counts[[at[n] for n in found["charset"].to_pylist()], found["pair"].to_numpy()] = found["n"].to_numpy()
        counts += SMOOTHING
        return CharsetModel(names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))

    def guess(self, content: bytes | None) -> tuple[str | None, float]:
        """(charset, confidence); (None, 0.0) where nothing but ASCII is there or no charset holds the bytes."""
        sums, n = np.zeros(len(self.charsets)), 0
        for pairs in _pairs(content or b""):
            sums += self.logs[:, pairs].sum(axis=1, dtype=np.float64)
            n += len(pairs)
        if not n:
            return None, 0.0
        for i in np.argsort(-sums, kind="stable").tolist():
            try:
                content.decode(self.charsets[i])
            except (UnicodeError, LookupError):
                continue
            each = np.exp((sums - sums[i]) / n)
            return self.charsets[i], float(1.0 / each[sums <= sums[i]].sum())
        return None, 0.0


GUESS = T.StructType([T.StructField("encoding", T.StringType()), T.StructField("confidence", T.DoubleType())])


def guessed(content: Column, model: CharsetModel) -> Column:
    """struct(encoding, confidence): UTF-8 where the bytes are valid in it (checked in the JVM), else the model's
    guess; null encoding where there is none."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    def run(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.guess(None if b is None else bytes(b)) for b in raw], columns=["encoding", "confidence"])

    utf8 = F.is_valid_utf8(content.cast("string"))
    rest = F.pandas_udf(run, GUESS)(F.when(~utf8, content))
    return F.when(utf8, F.struct(F.lit("utf-8").alias("encoding"), F.lit(1.0).alias("confidence"))).otherwise(rest)
