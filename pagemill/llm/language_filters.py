"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, at each of its positions, one bit for every
language. An n-gram that belongs to some languages sets their bits at ``HASHES``
positions; the bitwise and of these positions gives back all languages that
contain the n-gram (and some false ones) at once. A text is judged by counting,
for each language, how many of its n-grams the filter gives to it; a language
whose share of set bits is f gets an n-gram falsely with probability
f^HASHES, so its count h of n is corrected to (h - n f^k) / (1 - f^k), and the
largest corrected count decides.

N-grams are of ``SIZES`` code points inside words, with one space before and one
after each word; words are runs of letters in lower case. Training counts the
n-grams of every labelled document (NumPy within tasks, sums by Spark). A
language contains an n-gram if its share among the language's n-grams is at
least ``SHARE`` of the largest such share in any language, so stray words and wrong
labels do not make an n-gram a language's own, and at least ``RARE`` of the language's
n-grams. Both are relative, so they act alike at every size, and ``RARE`` bounds
the n-grams of a language by 1 / RARE.

The filter is sized by the number of its n-grams, up to ``FILTER_BYTES``; beyond that
its false positives rise and the correction takes more off.

Cases: a null text, and one without letters, is ``und`` with score 0. Equal
counts fall to the language with more n-grams in training, then to the smaller name. Texts with no
language take no part in training. Without any training rows all texts are
``und``. Ids may be null or repeat: each row is judged for itself. Texts of any
length are taken whole, their windows in pieces of bounded size. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, released, text_or_empty

UNDECIDED = "und"
SIZES = (2, 3, 4)
HASHES = 3
SHARE = 0.1
RARE = 5e-7
#: Bits of a language's mask that one word of the filter holds.
MASK_BITS = 63
FILTER_BYTES = 32 << 20
#: Windows hashed at one time.
AT_ONCE = 1 << 18

_U = np.uint64


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _cleaned(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, words between single spaces, and the text that each belongs to."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join(low).encode("utf-32-le", "surrogatepass"), np.uint32) if low else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])[:len(codes)]
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    # a space stays where a word ends; the one before a word is that of the word before it, or is added in front
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes, owner = codes[keep], owner[keep]
    if len(codes) and codes[-1] != 32:
        codes, owner = np.append(codes, _U(32)), np.append(owner, owner[-1])
    return np.concatenate([[_U(32)], codes]).astype(np.uint64), np.concatenate([owner[:1], owner])


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64 (fixed constants)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _grams(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, texts) of the windows with no space but at their ends. The space before a text's first word is
    the last one of the text before it: a window belongs to the text of its last code point."""
    space = codes == 32
    for size in SIZES:
        for first in range(0, max(0, len(codes) - size + 1), AT_ONCE):
            n = min(AT_ONCE, len(codes) - size + 1 - first)
            ok = np.ones(n, bool)
            for i in range(1, size - 1):
                ok &= ~space[first + i:first + i + n]
            at = np.flatnonzero(ok) + first
            h = np.full(len(at), size, np.uint64)
            for i in range(size):
                h = h * _U(0x9E3779B97F4A7C15) + codes[at + i]
            yield _mixed(h), owner[at + size - 1]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch, of about ``AT_ONCE`` characters each."""
    texts = batch.column(column).to_pylist()
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= AT_ONCE:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


# --- training ---------------------------------------------------------------------
def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each n-gram, by its 64-bit hash, occurs in the texts of each language."""

    def count(batches):
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, texts in _slices(batch, 0):
                named = {}
                for i in range(len(texts)):
                    named.setdefault(langs[first + i], []).append(texts[i])
                for lang, some in named.items():
                    found = [h for h, _ in _grams(*_cleaned(some))]
                    grams, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(
                        grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    return (known.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .mapInArrow(lambda b: released(count(b)), "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


@dataclass
class LanguageFilters:
    languages: list[str]    # more frequent ones first, so that ties fall to them
    positions: np.ndarray   # (positions, words of the mask)
    false: np.ndarray       # per language, the probability of a false positive

    def contained(self, grams: np.ndarray) -> np.ndarray:
        """The masks of the languages that contain each n-gram."""
        m = _U(len(self.positions) - 1)
        step = (grams >> _U(32)) | _U(1)
        out = self.positions[(grams & m).astype(np.int64)]
        for j in range(1, HASHES):
            out &= self.positions[((grams & m) + _U(j) * step & m).astype(np.int64)]
        return out


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageFilters:
    """The filter of all documents that have a text and a language."""
    spark = docs.sparkSession
    counts = cut_lineage(gram_counts(docs, text_col, lang_col))
    totals = sorted(counts.groupBy("lang").agg(F.sum("n").alias("n")).collect(), key=lambda r: (-r["n"], r["lang"]))
    languages = [r["lang"] for r in totals]
    if not languages:
        return LanguageFilters([], np.zeros((1, 1), np.uint64), np.zeros(0))
    index = spark.createDataFrame([(r["lang"], i, float(r["n"])) for i, r in enumerate(totals)], "lang string, i int, total double")
    shares = counts.join(F.broadcast(index), "lang").select("gram", "i", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.where(F.col("share") >= RARE)
    top = F.array_max(F.transform("found", lambda x: x["share"]))
    contained = (shares.groupBy("gram").agg(F.collect_list(F.struct("i", "share")).alias("found"))  # one entry a language
                 .withColumn("least", top * SHARE)
                 .select("gram", F.explode(F.expr("filter(found, x -> x.share >= least)")).alias("x")).select("gram", "x.i"))
    contained = cut_lineage(contained)
    words = -(-len(languages) // MASK_BITS)
    n = contained.agg(F.count_distinct("gram")).first()[0]
    m = 1 << 10
    while m < n * HASHES / np.log(2) and m * 2 * words * 8 <= FILTER_BYTES:
        m *= 2
    low = F.col("gram").bitwiseAND(m - 1)
    step = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1).cast("long"))
    places = F.array(*((low + F.lit(j).cast("long") * step).bitwiseAND(m - 1) for j in range(HASHES)))
    filled = (contained.select(F.explode(places).alias("at"), F.expr(f"i div {MASK_BITS}").cast("int").alias("word"),
                               F.expr(f"shiftleft(1L, i % {MASK_BITS})").alias("bit"))
              .groupBy("at", "word").agg(F.bit_or("bit").alias("bits")).toArrow())  # at most FILTER_BYTES / 8 rows
    positions = np.zeros((m, words), np.uint64)
    positions[filled["at"].to_numpy(), filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    share = np.array([((positions[:, i // MASK_BITS] >> _U(i % MASK_BITS)) & _U(1)).mean() for i in range(len(languages))])
    return LanguageFilters(languages, positions, share ** HASHES)


# --- prediction ---------------------------------------------------------------------
def _judged(filters: LanguageFilters, texts: list[str]) -> tuple[list[str], np.ndarray]:
    n_lang = len(filters.languages)
    hits, n = np.zeros((len(texts), n_lang)), np.zeros(len(texts))
    for grams, owner in _grams(*_cleaned(texts)):
        masks = filters.contained(grams)
        n += np.bincount(owner, minlength=len(texts))
        for i in range(n_lang):
            bit = (masks[:, i // MASK_BITS] >> _U(i % MASK_BITS)) & _U(1)
            hits[:, i] += np.bincount(owner, bit, len(texts))
    if not n_lang:
        return [UNDECIDED] * len(texts), np.zeros(len(texts))
    share = (hits / np.maximum(n, 1)[:, None] - filters.false) / np.maximum(1 - filters.false, 1e-9)
    share = np.clip(share, 0, 1)
    best = share.argmax(axis=1)
    names = [filters.languages[b] if some else UNDECIDED for b, some in zip(best.tolist(), (n > 0).tolist())]
    return names, np.where(n > 0, share[np.arange(len(texts)), best], 0.0)


def predict(docs: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; the score is the corrected share of the text's n-grams that the language contains."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(batches):
        for batch in batches:
            for first, texts in _slices(batch, 1):
                names, scores = _judged(shared.value, texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(names, pa.string()),
                                                  pa.array(scores)], names=["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(docs[text_col]).alias("text")).mapInArrow(
        lambda b: released(judge(b)), schema)
