"""Best-fit packing by length-histogram planning.

Documents are tokenised, closed with an end id and, if longer than a sequence,
cut into full pieces (the first piece takes the remainder). Best-fit
decreasing then runs over the histogram of piece lengths, not over pieces: the
planner sees at most ``capacity`` (length, count) pairs and hands out slots as
ranges "the pieces of length L with rank lo..hi go to sequences s, s+1, ..., k
to each, from offset o". Pieces take their slot by a join on rank within
length.

The rank is distributed: a piece's rank inside its task and length is set when
it is tokenised, and the number of pieces of that length in earlier tasks is
added by a join with the per-task counts (one narrow row per task and length).
So no length, however frequent, is gathered in one task. What is broadcast is
the plan, whose size depends on the capacity only.

Cases: a null text is empty and becomes the end id alone; repeated rows are
packed as often as they occur; null ids are kept; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import json
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, map_rows

CAPACITY = 2048


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rows (length, lo, hi, sequence, offset, per): rank r of a length goes to
    sequence ``sequence + (r - lo) // per`` at ``offset + (r - lo) % per * length``.

    Longest first; each goes to the fullest sequence that has room for it.
    Open sequences are kept as ranges of equal free space.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> (first sequence, count)
    spaces: list[int] = []  # sorted keys of free that have ranges
    plan, opened = [], 0

    def put(space: int, first: int, count: int) -> None:
        if space and count:
            if not free[space]:
                bisect.insort(spaces, space)
            free[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = free[space].pop()
                if not free[space]:
                    del spaces[at]
            else:
                space = capacity
                first, count = opened, -(-left // (capacity // length))
                opened += count
            per = space // length
            full = min(count, left // per)
            if full:
                plan.append((length, rank, rank + full * per, first, capacity - space, per))
                put(space - per * length, first, full)
                rank, left = rank + full * per, left - full * per
                first, count = first + full, count - full
            if left and count:  # fewer than `per` are left: they share one sequence
                plan.append((length, rank, rank + left, first, capacity - space, left))
                put(space - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            put(space, first, count)
    return plan


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, task, rank in task and length.

    A task numbers the pieces of each length as it makes them.
    """

    def make():
        from pyspark import TaskContext

        task, ranks, end = TaskContext.get().partitionId(), defaultdict(int), end_id.to_bytes(4, "little")
        width, ids_of = 4 * capacity, _encoder(tokenizer_path)

        def each(cols):
            for doc, text in zip(cols["id"], cols["text"], strict=True):
                raw = (ids_of(text) if text else b"") + end
                first = len(raw) % width or width
                cuts = [0, *range(first, len(raw) + 1, width)] if len(raw) > width else [0, len(raw)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    n = (b - a) // 4
                    yield doc, k, a // 4, n, zlib.crc32(raw[a:b]), task, ranks[n]
                    ranks[n] += 1

        return each

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_rows(rows, make, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, place long")


#: Fixed value: the split pattern of the byte-level pre-tokenizer in the tokenizer file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoder(tokenizer_path: str) -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit numbers; one per worker process.

    The ids are those of the tokenizer file. Where its merges come in the
    order of their ids, as in a file with a rank per token, the merges are run
    by the rank encoder, which takes a sixth of the CPU time; a text that it
    refuses (its pattern engine has a step limit) and any other file go
    through the tokenizer itself.
    """
    @lru_cache(maxsize=1)
    def tokenizer():  # loaded only where it is needed
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer_path)
        tok.encode_special_tokens = True
        return tok

    def by_tokenizer(text: str) -> bytes:
        return array("I", tokenizer().encode(text, add_special_tokens=False).ids).tobytes()

    with open(tokenizer_path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges = spec["model"].get("vocab"), spec["model"].get("merges") or []
    if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
        return by_tokenizer
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if made != sorted(made) or spec["pre_tokenizer"].get("add_prefix_space"):
        return by_tokenizer
    import tiktoken

    # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*plain}))}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
    encode = tiktoken.Encoding("ids", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def by_ranks(text: str) -> bytes:
        try:
            return array("I", encode(text)).tobytes()
        except (RuntimeError, ValueError):
            return by_tokenizer(text)

    return by_ranks


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces with their slot: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    table = cut_lineage(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    counts = table.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(best_fit_plan(histogram, capacity),
                                 "length long, lo long, hi long, sequence long, first long, per long")
    rank = F.col("before") + F.col("place")
    at = F.col("rank") - F.col("lo")
    return (table.join(before, ["length", "task"]).withColumn("rank", rank)
            .join(F.broadcast(plan.withColumnRenamed("length", "of")),  # a few rows per distinct length
                  (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
                    (F.col("first") + at % F.col("per") * F.col("length")).cast("long").alias("offset")))
