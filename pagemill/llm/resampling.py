"""Importance resampling towards a target distribution, over hashed n-grams.

Features of a text are its runs of 1 to 3 words; each falls into the bucket
crc32 modulo ``BUCKETS``. A bucket's gain is the log ratio of its smoothed shares
in the target and in the documents, a document's weight the sum of its features'
gains, and the documents are drawn by the largest weight plus Gumbel noise.

The buckets come from a head-tail vocabulary:

* a first pass keeps, in each task, bounded summaries of the most frequent words
  and pairs (Misra-Gries: no word or pair that is more frequent than its task's
  words divided by ``SUMMARY`` is missed); the most frequent of their sums,
  at most ``HEAD``, are broadcast. Which ones they are decides the speed alone, never a result;
* a head word carries its CRC state: the CRC of it, the CRC of a space and it, and its length.
  CRCs are linear, so the CRC of "a b" is the CRC of "a" shifted by the length
  of " b", xor that of " b"; shifts are table look-ups. Features of head words
  are so computed for whole arrays of words, and frequent pairs are looked up;
* a feature with a word outside the head takes the direct CRC of its bytes.

Both feed exact totals of the ``BUCKETS`` buckets (a table of fixed size, summed in
each task before it is shuffled). Ranks come from a range-partitioned sort: the
place in a partition plus the rows of the partitions before it.

Cases: a null text has no words and no features; its weight is 0, its score the
noise. A null id counts as an empty one in the noise. Equal scores fall to the
smaller id. A text of any length is taken in pieces of ``PIECE`` bytes, with the last
two words carried over. Repeated rows are drawn each for itself. Without
documents the result is empty; without target texts all of its shares are the
smoothing's. Other columns of the inputs are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, released, text_or_empty

BUCKETS = 10000
#: Words and pairs that are broadcast, and the longest word among them in bytes.
HEAD = 1 << 16
HEAD_BYTES = 48
#: Counters of a task's summary of words, and of pairs.
SUMMARY = 1 << 15
#: Places of the pair table (a power of two).
PAIR_SLOTS = 1 << 17
#: Bytes of text whose words are held at one time.
PIECE = 1 << 20

# fixed rule: A-Z become a-z; 0-9, a-z and all bytes of characters from U+0080 belong to words
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, of about ``PIECE`` bytes at a time."""
    at = 0
    while at < len(text):
        part = text[at:at + PIECE].translate(_WORD)
        if at + PIECE < len(text):
            cut = part.rfind(b" ") + 1
            while not cut:  # one word longer than a piece
                more = text[at + len(part):at + len(part) + PIECE].translate(_WORD)
                space = more.find(b" ") + 1
                part += more[:space] if space else more
                cut = len(part) if space or not more else 0
            part = part[:cut]
        at += len(part)
        yield part.split()


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, list]]:
    """(batch, first row, segments) where a segment is (row in the batch, words carried over, words);
    each slice holds about ``PIECE`` bytes."""
    for batch in batches:
        segments, size = [], 0
        for row, text in enumerate(batch.column(column)):
            carry: list[bytes] = []
            for words in _pieces(text.as_py()):
                segments.append((row, len(carry), carry + words))
                size += 8 * len(words)
                carry = (carry + words)[-2:]
                if size >= PIECE:
                    yield batch, False, segments
                    segments, size = [], 0
        yield batch, True, segments


# --- the head -------------------------------------------------------------------
def _trim(counts: Counter) -> Counter:
    """Misra-Gries: back to half of the counters by taking the median count off all of them."""
    if len(counts) <= SUMMARY:
        return counts
    off = sorted(counts.values(), reverse=True)[SUMMARY // 2]
    return Counter({k: n - off for k, n in counts.items() if n > off})


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, pairs = Counter(), Counter()
    for _, _, segments in _slices(batches, 0):
        for _, carry, found in segments:
            words.update(found[carry:])
            pairs.update(zip(found, found[1:]))
        words, pairs = _trim(words), _trim(pairs)
    rows = [(a, None, n) for a, n in words.items()] + [(a, b, n) for (a, b), n in pairs.items()]
    for at in range(0, len(rows), 8192):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows[at:at + 8192]), (pa.binary(), pa.binary(), pa.int64()))], names=["a", "b", "n"])


class Head:
    """Frequent words with their CRC states, and frequent pairs. Of bounded size: ``HEAD`` words of at most
    ``HEAD_BYTES`` bytes and ``PAIR_SLOTS`` places."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        words = [w for w in words if len(w) <= HEAD_BYTES]
        self.ids = {w: i for i, w in enumerate(words)}
        self.crc = np.array([zlib.crc32(w) for w in words] or [0], np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in words] or [0], np.uint32)
        self.size = np.array([len(w) + 1 for w in words] or [1], np.int64)
        # shifts[n, k, byte]: the CRC state byte << 8k after n more zero bytes
        step = np.array([zlib.crc32(bytes([c])) for c in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
        state = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        self.shifts = np.empty((HEAD_BYTES + 2, 4, 256), np.uint32)
        for n in range(HEAD_BYTES + 2):
            self.shifts[n] = state
            state = (state >> np.uint32(8)) ^ step[state & np.uint32(255)]
        self.pair_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_crc = np.zeros(PAIR_SLOTS, np.uint32)
        for a, b in reversed(pairs):  # the more frequent one stays in a place that two pairs share
            if a in self.ids and b in self.ids:
                key = (self.ids[a] << 32) | self.ids[b]
                at = self._slot(np.int64(key))
                self.pair_key[at], self.pair_crc[at] = key, zlib.crc32(a + b" " + b)

    @staticmethod
    def _slot(key):
        return ((key >> 32) * 40503 + (key & 0xFFFFFFFF)) & (PAIR_SLOTS - 1)

    def _joined(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """CRC of what has ``states``, a space and the words ``ids``."""
        n = self.size[ids]
        t = self.shifts
        return (t[n, 0, states & np.uint32(255)] ^ t[n, 1, (states >> np.uint32(8)) & np.uint32(255)]
                ^ t[n, 2, (states >> np.uint32(16)) & np.uint32(255)] ^ t[n, 3, states >> np.uint32(24)] ^ self.spaced[ids])

    def buckets(self, segments: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, buckets) of all features of 1, 2 and 3 words that end in the words of the segments."""
        words = [w for _, _, found in segments for w in found]
        if not words:
            return
        sizes = [len(found) for _, _, found in segments]
        rows = np.repeat(np.array([row for row, _, _ in segments], np.int64), sizes)
        place = np.concatenate([np.arange(n) for n in sizes])
        fresh = place >= np.repeat(np.array([carry for _, carry, _ in segments], np.int64), sizes)
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        tail = ids < 0
        crc = self.crc[ids]  # what stands here for a tail word is never used
        for n in (1, 2, 3):
            if n == 2:
                a, b = ids[:-1], ids[1:]
                key = (a << 32) | (b & 0xFFFFFFFF)
                at = self._slot(key)
                known = (self.pair_key[at] == key) & (a >= 0)
                two = self.pair_crc[at]
                other = np.flatnonzero(~known & ~tail[:-1] & ~tail[1:])
                two[other] = self._joined(crc[:-1][other], b[other])
                states = np.concatenate([crc[:1], two])
                tails = tail.copy()
                tails[1:] |= tail[:-1]
            elif n == 3:
                tails[2:] |= tail[:-2]
                three = np.flatnonzero(~tails[2:]) + 2
                longer = np.zeros(len(words), np.uint32)
                longer[three] = self._joined(states[three - 1], ids[three])
                states = longer
            else:
                states, tails = crc, tail
            mine = fresh & (place >= n - 1)
            direct = np.flatnonzero(mine & tails)
            states = states.copy()
            states[direct] = [zlib.crc32(b" ".join(words[i - n + 1:i + 1])) for i in direct.tolist()]
            yield rows[mine], states[mine] % np.uint32(BUCKETS)


def _utf8(docs: DataFrame, text_col: str):
    return text_or_empty(docs[text_col]).cast("binary").alias("text")


def head_vocabulary(docs: DataFrame, text_col: str = "text") -> Head:
    """The frequent words and pairs of all documents."""
    found = docs.select(_utf8(docs, text_col)).mapInArrow(
        lambda b: released(_summaries(b)), "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    found = cut_lineage(found)

    def top(rows: DataFrame) -> list:
        """At most ``HEAD`` rows, all that are frequent enough. The limit comes from a histogram of the counts (a
        sixteenth of a power of two wide, so of some hundred rows), so no task or driver holds more."""
        rows = rows.withColumn("at", F.floor(F.log2("n") * 16))
        least, held = None, 0
        for r in sorted(rows.groupBy("at").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
            held += r["k"]
            if held > HEAD:
                break
            least = r["at"]
        kept = rows.where(F.col("at") >= least).collect() if least is not None else []
        return sorted(kept, key=lambda r: (-r["n"], r["a"], r["b"] or b""))

    words = [bytes(r["a"]) for r in top(found.where(F.col("b").isNull() & (F.length("a") <= HEAD_BYTES)))]
    pairs = [(bytes(r["a"]), bytes(r["b"])) for r in top(found.where(
        F.col("b").isNotNull() & (F.length("a") <= HEAD_BYTES) & (F.length("b") <= HEAD_BYTES)))]
    return Head(words, pairs)


# --- totals, gains, weights -------------------------------------------------------
def bucket_totals(docs: DataFrame, head, text_col: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def count(batches):
        held, total = head.value, np.zeros(BUCKETS, np.int64)
        for _, _, segments in _slices(batches, 0):
            for _, buckets in held.buckets(segments):
                total += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return docs.select(_utf8(docs, text_col)).mapInArrow(lambda b: released(count(b)), "bucket int, n long").groupBy(
        "bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down. Both inputs are
    totals (bucket, n) of at most ``BUCKETS`` rows, whatever they were counted from."""
    s, t = ({r["bucket"]: r["n"] for r in totals.collect()} for totals in (source, target))
    all_s, all_t = sum(s.values()) + BUCKETS, sum(t.values()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t)))
                     for b in range(BUCKETS)], np.int64)


def weights(docs: DataFrame, head, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def weigh(batches):
        held = head.value
        total = None
        for batch, last, segments in _slices(batches, 1):
            if total is None:
                total = np.zeros((3, batch.num_rows), np.int64)
            for k, (rows, buckets) in enumerate(held.buckets(segments)):
                count = np.bincount(rows, minlength=batch.num_rows)
                total[0] += count if k == 0 else 0
                total[1] += count
                total[2] += np.bincount(rows, gains[buckets], batch.num_rows).astype(np.int64)
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in total)],
                                                 names=["id", "n_words", "n_features", "weight"])
                total = None

    return docs.select(F.col(id_col).alias("id"), _utf8(docs, text_col)).mapInArrow(lambda b: released(weigh(b)), schema)


def noise(id_text, seed: int):
    """floor(-1000 ln(-ln(u))): Gumbel noise in thousandths, u from the id's SHA-256."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, share: tuple[int, int], min_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... by falling score for the drawn rows, null for all others.
    Of the N rows with at least ``min_words`` words floor(N * share) are drawn."""
    fit = F.col("n_words") >= min_words
    placed = cut_lineage(scored.where(fit).orderBy(F.desc("score"), F.asc("id")).withColumn(
        "__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = [(r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
    before, at = [], 0
    for p, n in sorted(sizes):  # one row a partition of the sort
        before.append((p, at))
        at += n
    spark = scored.sparkSession
    starts = spark.createDataFrame(before, "__part long, __before long")
    rank = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.join(F.broadcast(starts), part == F.col("__part")).withColumn("rank", rank)
    limit = share[0] * at // share[1]
    return (ranked.withColumn("rank", F.when(F.col("rank") <= limit, F.col("rank"))).drop("__at", "__part", "__before")
            .unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), min_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document."""
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(head_vocabulary(docs, text_col))
    gains = bucket_gains(bucket_totals(docs, head, text_col), bucket_totals(target, head, target_text))
    weighed = weights(docs, head, gains, id_col, text_col)
    id_text = F.coalesce(F.col("id").cast("string"), F.lit(""))
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise(id_text, seed)))
    return drawn(scored, share, min_words)
