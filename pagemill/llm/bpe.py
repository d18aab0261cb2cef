"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token starts as a linked list of bytes. Every adjacent pair that has a
merge rank puts its list position into the bucket of that rank; a two-level
bitmap over the ranks marks the buckets that hold something, so
find-first-set on the upper and then on the lower word gives the next rank
without comparing pairs. Positions whose pair has changed since they were
filed are stale and are skipped when they come up. A merge re-files the two
pairs beside it. So a pre-token of n bytes takes O(n log n) steps, where
scanning for the best pair takes O(n^2).

The order is that of the rank files: lowest rank first, leftmost first among
equal ranks; a pre-token that is itself in the file is one id.

Cases: a null text is empty (no ids, empty decoded text); ids and other columns
may be null or repeated and do not matter; an empty table gives an empty
result. The memo of short pre-tokens is bounded, long ones are encoded anew.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable
from heapq import heappop, heappush

from pyspark.sql import DataFrame

from .common import map_rows

MEMO_ENTRIES = 300_000
MEMO_CHARS = 48
LOW_BITS = 8  # ranks per lower word: 2 ** 8
_STATE: dict[tuple, tuple] = {}


class RankQueue:
    """Positions by rank: buckets, and a two-level bitmap of the buckets in use.

    ``merge_all`` leaves the queue empty, so one queue serves all pre-tokens.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.low = [0] * ((max(ranks.values()) >> LOW_BITS) + 1)
        self.first = [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]

    def merge_all(self, piece: bytes) -> list[int]:
        """The end of the token at each start, after all merges (as a linked list of starts)."""
        n = len(piece)
        rank_of, first, low, mask = self.ranks.get, self.first, self.low, (1 << LOW_BITS) - 1
        buckets: dict[int, list[int]] = {}
        high = 0
        # of the token that starts at i: the end, the start of the one before, the rank of the pair it begins
        end = list(range(1, n + 1))
        before = list(range(-1, n))
        pair = [first[a][b] for a, b in zip(piece, piece[1:])]  # noqa: B905
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # in order, so the list is a heap
                else:
                    buckets[rank] = [i]
                    low[rank >> LOW_BITS] |= 1 << (rank & mask)
                    high |= 1 << (rank >> LOW_BITS)
        pair.append(-1)
        while high:
            # find first set, in the upper and in the lower word
            word = (high & -high).bit_length() - 1
            bits = low[word]
            bit = bits & -bits
            rank = (word << LOW_BITS) + bit.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                low[word] = bits = bits ^ bit
                if not bits:
                    high &= high - 1
            if pair[i] != rank:  # stale: the pair at i has changed or is gone
                continue
            j = end[i]
            after = end[j]
            end[i] = after
            pair[j] = -1
            k = before[i]
            if after < n:
                before[after] = i
                pair[i] = new = rank_of(piece[i:end[after]], -1)
                if new >= 0:
                    if new in buckets:
                        heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        low[new >> LOW_BITS] |= 1 << (new & mask)
                        high |= 1 << (new >> LOW_BITS)
            else:
                pair[i] = -1
            if k >= 0:
                new = rank_of(piece[k:after], -1)
                if new != pair[k]:
                    pair[k] = new
                    if new >= 0:
                        if new in buckets:
                            heappush(buckets[new], k)
                        else:
                            buckets[new] = [k]
                            low[new >> LOW_BITS] |= 1 << (new & mask)
                            high |= 1 << (new >> LOW_BITS)
        return end

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        end, ranks, out, i, n = self.merge_all(piece), self.ranks, [], 0, len(piece)
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Texts of these characters alone: printable ASCII, line ends and tabs, Latin letters and signs.
_LATIN = re.compile(r"[\t\n\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern. For Latin texts its Unicode classes are those of the
    standard engine, which is twice as fast; others take the engine with all classes."""
    import regex

    every = regex.compile(pattern).findall
    plain = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)")
                       .replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d"))
    if r"\p" in plain.pattern:
        return every
    latin = _LATIN.fullmatch
    return lambda text: plain.findall(text) if latin(text) else every(text)


class Codec:
    """Encoder and decoder of one rank file; one per worker process."""

    def __init__(self, rank_path: str, pattern: str) -> None:
        self.ranks = read_ranks(rank_path)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.digits = list(map(str, range(len(self.bytes_of))))
        self.queue = RankQueue(self.ranks)
        self.split = splitter(pattern)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        memo, ids = self.memo, []
        take = ids.extend
        for piece in self.split(text):
            if piece in memo:
                take(memo[piece])
                continue
            known = self.older.get(piece)
            if known is None:
                known = self.queue.encode(piece.encode())
            take(known)
            if len(piece) <= MEMO_CHARS:
                if len(memo) >= MEMO_ENTRIES:  # two generations: what is in use moves to the new one
                    self.older, self.memo = memo, {}
                    memo = self.memo
                memo[piece] = tuple(known)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(rank_path: str, pattern: str) -> Codec:
    key = (rank_path, pattern)
    if key not in _STATE:
        _STATE[key] = Codec(rank_path, pattern)
    return _STATE[key]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) per row."""
    return _per_document(docs, rank_path, pattern, id_col, text_col, "ids array<int>",
                         lambda c, ids: (ids,))


def decode(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "id",
           ids_col: str = "ids") -> DataFrame:
    """(id, bytes) per row: the bytes that the ids stand for."""
    def make():
        c = codec(rank_path, pattern)
        return lambda cols: ((i, c.decode(x or [])) for i, x in zip(cols["id"], cols["ids"], strict=True))

    rows = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    return map_rows(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, bytes binary")


def round_trip_digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row, encoded and decoded in one pass."""
    def digests(c: Codec, ids: list[int]) -> tuple:
        return (len(ids), hashlib.sha256(" ".join(map(c.digits.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(c.decode(ids)).hexdigest())

    return _per_document(docs, rank_path, pattern, id_col, text_col,
                         "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _per_document(docs, rank_path, pattern, id_col, text_col, columns, result) -> DataFrame:
    def make():
        c = codec(rank_path, pattern)
        return lambda cols: ((i, *result(c, c.encode(t or "")))
                             for i, t in zip(cols["id"], cols["text"], strict=True))

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return map_rows(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, {columns}")
