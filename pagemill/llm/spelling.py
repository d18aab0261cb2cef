"""Spelling variant grouping by Bloom-guided neighbourhoods.

Every word of a vocabulary makes the strings that lie one edit away from it,
looks each up in broadcast Bloom filters, one filter per word length, and only
what a filter lets pass is shuffled to an exact join with the vocabulary, which
removes the false positives:

* two words one edit apart have equal length and differ in one place, or the
  shorter one is the longer one without one code point. So each word makes its
  replacements by larger code points of the alphabet and its deletions; every
  near pair is then made once, from one of its sides;
* hashes of the edits come from the word's own polynomial hash and prefix sums,
  whole arrays at a time; strings are built for positives alone;
* a filter is blocked: a hash picks one 64-bit word of its length's filter and
  ``PROBES`` bits in it, so a look-up reads one place;
* the filters of one pass take at most ``FILTER_BYTES``. A larger vocabulary
  takes more passes, over groups of lengths or, where one length is too large,
  over slices of its hashes. Nothing is left out, and the filters' false
  positive rate stays the same.

The form of a word is its most frequent near word, where that is ``ratio``
times as frequent; roots follow the forms to the last one by pointer doubling
(each form is more frequent than its word, so chains end, after at most
log_ratio(n) steps, in log2 of that many rounds).

Cases: null and empty texts have no words. A null id counts as an empty one.
Words of one length share a filter up to ``LENGTHS``; longer ones share the last.
Equal frequencies fall to the smaller word in code-point order. Repeated rows
count as often as they occur. Without words the result is empty. Other columns
of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import drop_tables

from .common import cut_lineage, released, text_or_empty

#: Letters of a word: ASCII and the Latin-1 letters' block.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of a filter for each of its words, and bits that a word sets.
BITS_PER_WORD = 20
PROBES = 5
#: Bytes of all filters that are broadcast at one time.
FILTER_BYTES = 16 << 20
#: Words of this many code points or more share one filter.
LENGTHS = 64
#: Edits hashed at one time, which bounds the memory of a task.
EDITS_AT_ONCE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6,
               min_count: int = 5, rewrite: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): the words of all texts, in lower case (A-Z only), with how often they occur.

    Runs of fewer than ``min_chars`` letters are skipped by the pattern; a run is matched whole or not
    at all. ``rewrite(id, run)`` may shorten a run before it is counted. Counts are summed in each task
    before the shuffle, so a word that is a third of all words costs one row a task.
    """
    low = F.translate(text_or_empty(text_col), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(low, F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))).alias("run"))
    word = rewrite(F.col("id"), F.col("run")) if rewrite else F.col("run")
    return (runs.select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# --- hashing ------------------------------------------------------------------
def _mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64 (fixed constants)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _weighted(codes: np.ndarray) -> np.ndarray:
    """Each code point times the power of its place, the terms of the polynomial hash."""
    return codes.astype(np.uint64) * _powers(codes.shape[1])[::-1]


def _hash(poly: np.ndarray, length: int) -> np.ndarray:
    return _mix(poly + _U(length * 0xD6E8FEB86659FD93 % (1 << 64)))


def _place(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of the filter and the bits in it that each hash has."""
    at = (hashes >> _U(32)) % _U(blocks)
    bits = np.zeros(len(hashes), np.uint64)
    for j in range(PROBES):
        bits |= _U(1) << ((hashes >> _U(6 * j)) & _U(63))
    return at, bits


# --- passes -------------------------------------------------------------------
def _shard(length: int) -> int:
    return min(length, LENGTHS)


@dataclass
class _Part:
    """A slice of one shard's filter: the hashes with this remainder, and where its words lie in the pass."""
    slices: int
    index: int
    start: int
    blocks: int

    def mine(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * _BASE >> _U(40)) % _U(self.slices) == _U(self.index)


def plan_passes(counts: dict[int, int], most_bytes: int = FILTER_BYTES) -> list[dict[int, _Part]]:
    """Filters of all shards, dealt into passes of at most ``most_bytes``."""
    room = max(1, most_bytes // 8)
    passes: list[dict[int, _Part]] = []
    used = room
    for shard, n in sorted(counts.items()):
        blocks = -(-n * BITS_PER_WORD // 64)
        slices = -(-blocks // room)
        size = -(-blocks // slices)
        for index in range(slices):
            if used + size > room:
                passes.append({})
                used = 0
            passes[-1][shard] = _Part(slices, index, used, size)
            used += size
    return passes


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for w in batch.column(0).to_pylist():
        groups.setdefault(len(w), []).append(w)
    yield from groups.items()


def _filter_of(words: DataFrame, parts: dict[int, _Part]) -> np.ndarray:
    """The filters of a pass, filled by tasks and put together by Spark; at most ``FILTER_BYTES`` come back."""

    def fill(batches):
        for batch in batches:
            for length, group in _by_length(batch):
                part = parts.get(_shard(length))
                if part is None:
                    continue
                h = _hash(_weighted(_codes(group, length)).sum(axis=1, dtype=np.uint64), length)
                at, bits = _place(h[part.mine(h)], part.blocks)
                yield pa.RecordBatch.from_arrays([pa.array((at + _U(part.start)).astype(np.int64)),
                                                  pa.array(bits.view(np.int64))], names=["at", "bits"])

    rows = (words.select("word").mapInArrow(lambda b: released(fill(b)), "at long, bits long")
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(sum(p.blocks for p in parts.values()), np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _passing(h: np.ndarray, part: _Part, filters: np.ndarray) -> np.ndarray:
    """Which hashes the filter of this part holds, as positions."""
    ours = np.flatnonzero(part.mine(h)) if part.slices > 1 else np.arange(len(h))
    at, bits = _place(h[ours], part.blocks)
    return ours[(filters[at + _U(part.start)] & bits) == bits]


def _replacements(words: list[str], codes: np.ndarray, terms: np.ndarray, alphabet: np.ndarray, part: _Part,
                  filters: np.ndarray) -> Iterator[tuple[str, str]]:
    length = codes.shape[1]
    powers = _powers(length)[::-1]
    whole = terms.sum(axis=1, dtype=np.uint64)
    step = max(1, EDITS_AT_ONCE // max(1, len(words) * len(alphabet)))
    for first in range(0, length, step):
        own = codes[:, first:first + step]
        w, i, a = np.nonzero(alphabet[None, None, :] > own[:, :, None])
        poly = whole[w] + (alphabet[a].astype(np.uint64) - own[w, i].astype(np.uint64)) * powers[first + i]
        for k in _passing(_hash(poly, length), part, filters):
            word, at = words[w[k]], first + int(i[k])
            yield word, word[:at] + chr(alphabet[a[k]]) + word[at + 1:]


def _deletions(words: list[str], codes: np.ndarray, terms: np.ndarray, part: _Part,
               filters: np.ndarray) -> Iterator[tuple[str, str]]:
    length = codes.shape[1]
    after = terms[:, ::-1].cumsum(axis=1, dtype=np.uint64)[:, ::-1]
    after = np.concatenate([after[:, 1:], np.zeros((len(words), 1), np.uint64)], axis=1)
    # what stands before the gap moves one place to the right: its terms lose one power of the base
    before = np.zeros((len(words), length), np.uint64)
    lower = codes[:, :-1].astype(np.uint64) * _powers(length - 1)[::-1]
    before[:, 1:] = lower.cumsum(axis=1, dtype=np.uint64)
    fresh = np.ones((len(words), length), bool)  # of equal neighbours one is deleted
    fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]
    w, i = np.nonzero(fresh)
    for k in _passing(_hash((before + after)[w, i], length - 1), part, filters):
        word, at = words[w[k]], int(i[k])
        yield word, word[:at] + word[at + 1:]


def _edits(words: DataFrame, parts: dict[int, _Part], alphabet: list[str], filters: np.ndarray) -> DataFrame:
    """(word, edit): edits of the words that the filters of this pass hold, some of them falsely."""
    shared = words.sparkSession.sparkContext.broadcast(filters)
    letters = np.array([ord(c) for c in alphabet], np.uint32)

    def probe(batches):
        held = shared.value
        for batch in batches:
            for length, group in _by_length(batch):
                same, shorter = parts.get(_shard(length)), parts.get(_shard(length - 1))
                step = max(1, EDITS_AT_ONCE // (length * len(letters)))
                for at in range(0, len(group), step):
                    some = group[at:at + step]
                    codes = _codes(some, length)
                    terms = _weighted(codes)
                    found = []
                    if same is not None:
                        found += _replacements(some, codes, terms, letters, same, held)
                    if shorter is not None and length > 1:
                        found += _deletions(some, codes, terms, shorter, held)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)],
                                                         names=["word", "edit"])

    return words.select("word").mapInArrow(lambda b: released(probe(b)), "word string, edit string")


def near_pairs(words: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words of ``words`` (word, n; words distinct)
    that differ by one inserted, deleted or replaced code point."""
    counts = {r["shard"]: r["n"] for r in words.groupBy(F.least(F.length("word"), F.lit(LENGTHS)).alias("shard"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    alphabet = sorted(r[0] for r in words.select(F.explode(F.array_distinct(F.split("word", "")))).distinct()
                      .collect() if r[0])
    found = []
    for parts in plan_passes(counts, most_bytes):
        edits = _edits(words, parts, alphabet, _filter_of(words, parts))
        mine = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
        found.append(cut_lineage(edits.join(mine, "edit").join(words, "word")))
    if not found:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return (pairs.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n"))
            .unionByName(pairs.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling."""
    written: list = []
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), written)
    while True:
        up = now.select(F.col("word").alias("__at"), F.col("root").alias("__up"))
        ahead: list = []
        then = cut_lineage(now.join(up, now["root"] == up["__at"], "left").select(
            "word", F.coalesce("__up", "root").alias("root"), F.col("__up").isNotNull().alias("moved")), ahead)
        if then.where("moved").isEmpty():
            drop_tables(now.sparkSession, ahead)
            return now.select("word", "root")
        drop_tables(now.sparkSession, written)
        now, written = then.drop("moved"), ahead


def variants(words: DataFrame, ratio: int = 5, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n; words distinct)."""
    words = cut_lineage(words.select("word", "n"))
    near = near_pairs(words, most_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                     "best.near", (-F.col("best.minus")).alias("near_n"))
    much = F.col("near_n") >= F.lit(ratio) * F.col("n")
    judged = cut_lineage(judged.select("word", "n", "n_near", F.when(much, F.col("near")).alias("form"),
                                       F.when(much, F.col("near_n")).alias("form_n")))
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                     "n", "n_near", "form_n")
