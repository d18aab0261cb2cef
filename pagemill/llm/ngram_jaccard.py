"""Jaccard join of word n-gram sets by count vectors, and near-duplicate groups.

A document's set holds its distinct five-word shingles (64-bit hashes). Two
documents link when ``100 * intersection >= threshold * union``; the groups
are the connected components of the links.

Shingles are hashed into ``2^g`` groups and a document is the point of its
group counts, with about two shingles to a group. For two points the sum of
the coordinate minima is an upper bound of the overlap, and so it is for the
maxima of two nodes of points; a pair or a pair of nodes whose bound stays
below the overlap that a link needs is pruned. Uniform hashing leaves the
points of unrelated documents equally far apart, so one tree over the whole
corpus prunes by size alone and its join grows with the square of the corpus.
The points are therefore indexed in blocks that are sure to hold each linked
pair: documents that share one of the first ``n - ceil(0.8 n) + 1`` shingles
in a common order (frequent shingles last). Nothing is capped: the order only
decides how large the blocks are.

Steps, each of them a Spark job over all documents:

1. Misra-Gries summaries (bounded) name frequent shingles for the order.
2. Sets, their prefixes and points; documents with equal sets become one.
3. Prefix entries of shingles that two or more sets share make the blocks.
4. Star round: in each block only the pairs with the most central member are
   tried, so a large group of near copies costs its size, not its square.
5. Blocks that still hold several components are joined by a packed R-tree of
   points, skipping pairs that are already connected. Blocks of over
   ``BLOCK`` sets are split into chunks and joined chunk by chunk, so no task
   holds an unbounded group.
6. Pairs that survive the finer points are verified on the shingle sets, which
   are made again from the texts of the documents concerned alone.

Cases: null, empty and blank texts have an empty set, link with nothing and
form their own component. A text of one to four words has the whole sequence
as its one shingle. Repeated rows and equal sets share a component. A null id
does not become a component's name unless all its ids are null. Empty tables
give empty results. Equality of shingles and of sets is equality of 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut_lineage, hash_thinned, released, text_or_empty, tmp_name

WORDS = 5
THRESHOLD = 80  # per cent
FREQUENT = 1 << 17  # frequent shingles known to the order
COUNTERS = 1 << 17  # Misra-Gries counters of a task
COARSE = 6  # the tree's points have 2 ** COARSE coordinates
LEAF = 32
BLOCK = 1024
GATHER = 1 << 15  # rows of blocks joined at a time
SLICE_BYTES = 1 << 19

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_K = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each bit over the word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash) of the distinct shingles, ordered by both."""
    raw = [(t or "").encode() for t in texts]
    buf = np.frombuffer(b"\n".join([b"", *raw, b""]).translate(_LOWER), np.uint8)
    inside = ~_SPACE[buf]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    size = ends - starts
    power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(size.max()), _K), dtype=np.uint64)])
    at = np.arange(len(buf)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(buf)]))
    value = np.where(inside, buf, 0).astype(np.uint64)
    value *= power[np.minimum(at, len(power) - 1)]
    word = _mix(np.add.reduceat(value, starts) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    doc = np.searchsorted(np.cumsum([1] + [len(r) + 1 for r in raw]), starts, "right") - 1
    per = np.bincount(doc, minlength=len(raw))
    first = np.cumsum(per) - per
    hashes, owner = [], []
    if len(word) >= words:
        m = len(word) - words + 1
        h = np.full(m, np.uint64(words))
        for k in range(words):
            h = h * _K + word[k:k + m]
        whole = doc[:m] == doc[words - 1:]
        hashes.append(_mix(h[whole]))
        owner.append(doc[:m][whole])
    for d in np.flatnonzero((per > 0) & (per < words)):
        h = np.full(1, np.uint64(per[d]))
        for k in range(per[d]):
            h = h * _K + word[first[d] + k]
        hashes.append(_mix(h))
        owner.append(np.array([d]))
    h, d = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
    return d[new], h[new]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text (one row at least)."""
    size = np.cumsum([len(x or "") for x in batch.column(column).to_pylist()])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES)))
        yield batch.slice(at, to - at)
        at = to


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    return keys[first], (np.add.reduceat(counts, first) if len(keys) else counts)


def frequent_shingles(docs: DataFrame, text_col: str, words: int = WORDS, most: int = FREQUENT) -> np.ndarray:
    """At most ``most`` frequent shingle hashes, rarest first: merged Misra-Gries
    summaries over all documents. They order the prefixes and decide nothing else."""

    def run(batches):
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        new, held = [], 0

        def merge():
            nonlocal keys, counts
            keys, counts = _counted(np.concatenate([keys, *new]),
                                    np.concatenate([counts, *(np.ones(len(x), np.int64) for x in new)]))
            if len(keys) > COUNTERS:
                counts = counts - np.partition(counts, len(counts) - COUNTERS - 1)[len(counts) - COUNTERS - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]

        for batch in batches:
            for part in _slices(batch, 0):
                new.append(shingle_sets(part.column(0).to_pylist(), words)[1])
                held += len(new[-1])
                if held > 8 * COUNTERS:
                    merge()
                    new, held = [], 0
        merge()
        top = np.argsort(-counts, kind="stable")[:most]
        top = top[counts[top] > 2]
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys[top].view(np.int64)), "seen": pa.array(counts[top])})

    seen = (docs.select(docs[text_col]).mapInArrow(lambda b: released(run(b)), "key long, seen long")
            .groupBy("key").agg(F.sum("seen").alias("seen")).where("seen > 7")
            .orderBy(F.desc("seen"), "key").limit(most))
    keys = seen.toArrow()["key"].to_numpy().astype(np.int64)  # at most `most` rows
    return keys[::-1].view(np.uint64)


def _resolution(n: np.ndarray) -> np.ndarray:
    """Bits of the group number: about two shingles to a group, 2 ** COARSE groups at least."""
    return np.maximum(COARSE, np.ceil(np.log2(np.maximum(n, 2) / 2)).astype(int))


def document_sets(docs: DataFrame, frequent: np.ndarray, id_col: str, text_col: str, words: int = WORDS,
                  threshold: int = THRESHOLD) -> DataFrame:
    """(id, text_hash, sid, n, prefix, point) per row; sid identifies the set."""
    by_key = np.argsort(frequent)
    known, rank_of = frequent[by_key], by_key + 1
    text = text_or_empty(docs[text_col])
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, text_hash long, sid long, n int, "
              "prefix array<long>, point binary, coarse binary")

    def run(batches):
        for batch in batches:
            for part in _slices(batch, 2):
                d, h = shingle_sets(part.column(2).to_pylist(), words)
                n = np.bincount(d, minlength=part.num_rows)
                first = np.cumsum(n) - n
                some = np.flatnonzero(n)
                sid = np.zeros(part.num_rows, np.uint64)
                if len(some):
                    sid[some] = _mix(np.add.reduceat(_mix(h + _K), first[some]) + n[some].astype(np.uint64))
                rank = np.zeros(len(h), np.int64)
                if len(known) and len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    rank = np.where(known[at] == h, rank_of[at], 0)
                order = np.lexsort((h, rank, d))
                place = np.arange(len(h)) - np.repeat(first, n)
                take = place < np.repeat(n - (threshold * n + 99) // 100 + 1, n)
                prefix = h[order][take]
                points, coarse = [], []
                for at, m, g in zip(first, n, _resolution(n), strict=True):
                    count = np.bincount((h[at:at + m] >> np.uint64(64 - g)).astype(np.int64), minlength=1 << g)
                    # a count over 255 does not occur by hashing; an empty point stands for "no bound"
                    points.append(count.astype(np.uint8).tobytes() if m and count.max() < 256 else b"")
                    count = count.reshape(1 << COARSE, -1).sum(1)
                    coarse.append(count.astype(np.uint8 if count.max() < 256 else np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sid.view(np.int64)), pa.array(n, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(d[take], minlength=part.num_rows))],
                                                       pa.int32()), pa.array(prefix.view(np.int64))),
                     pa.array(points, pa.binary()), pa.array(coarse, pa.binary())],
                    names=["id", "text_hash", "sid", "n", "prefix", "point", "coarse"])

    return rows.mapInArrow(lambda b: released(run(b)), schema)


def overlap_bound(a: bytes, b: bytes) -> int:
    """Sum of coordinate minima at the coarser resolution of two points."""
    if not a or not b:
        return 1 << 40
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    m = min(len(x), len(y))
    if len(x) > m:
        x = x.reshape(m, -1).sum(1, dtype=np.uint16)
    elif len(y) > m:
        y = y.reshape(m, -1).sum(1, dtype=np.uint16)
    return int(np.minimum(x, y).sum(dtype=np.int64))


def _may_link(na, nb, overlap, threshold):
    """Whether an overlap of at most ``overlap`` is enough for sets of these sizes."""
    return overlap * (100 + threshold) >= threshold * (na + nb)


def _fold(points: np.ndarray, width: int) -> np.ndarray:
    """Points at a coarser resolution: neighbouring groups are summed."""
    return points if points.shape[1] == width else points.reshape(len(points), width, -1).sum(2, dtype=np.uint16)


class _Tree:
    """Packed R-tree over one block's points, sorted by set size: leaves of LEAF points, each at the
    coarsest resolution of its points, with the range of the sizes and the maxima of the coordinates."""

    def __init__(self, n: np.ndarray, points: list[bytes]) -> None:
        self.n = n
        self.first = np.arange(0, len(n), LEAF)
        self.last = np.minimum(self.first + LEAF, len(n))
        self.low_n, self.high_n = n[self.first], n[self.last - 1]
        self.leaves: list[np.ndarray | None] = []
        for a, b in zip(self.first, self.last, strict=True):
            width = min(len(p) for p in points[a:b])
            self.leaves.append(np.concatenate([_fold(np.frombuffer(p, np.uint8)[None], width) for p in points[a:b]])
                               if width else None)
        self.high = [None if x is None else x.max(0) for x in self.leaves]

    def _bounds(self, a: int, b: int) -> np.ndarray | None:
        """Overlap bounds of the points of two leaves; None if even their maxima are too small."""
        x, y, u, v = self.leaves[a], self.leaves[b], self.high[a], self.high[b]
        if x is None or y is None:
            return np.full((self.last[a] - self.first[a], self.last[b] - self.first[b]), 1 << 40)
        width = min(len(u), len(v))
        x, y = _fold(x, width), _fold(y, width)
        u, v = x.max(0), y.max(0)
        if not _may_link(self.low_n[a], self.low_n[b], int(np.minimum(u, v).sum(dtype=np.int64)), self.threshold):
            return None
        return np.minimum(x[:, None, :], y[None, :, :]).sum(2, dtype=np.int64)

    def pairs(self, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Position pairs i < j whose points may link."""
        self.threshold = threshold
        for a in range(len(self.first)):
            for b in range(a, len(self.first)):
                if threshold * self.low_n[b] > 100 * self.high_n[a]:
                    break
                bounds = self._bounds(a, b)
                if bounds is not None:
                    i, j = np.arange(self.first[a], self.last[a]), np.arange(self.first[b], self.last[b])
                    may = _may_link(self.n[i][:, None], self.n[j][None, :], bounds, threshold) & (i[:, None] < j[None, :])
                    p, q = np.nonzero(may)
                    yield i[p], j[q]


def _block_pairs(blocks: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs (a, b) inside blocks sorted by (key, i, j, n): not yet connected,
    passing the size, position and point bounds."""

    def join(t: pa.Table) -> pa.RecordBatch:
        key = np.stack([t["key"].to_numpy(), t["i"].to_numpy().astype(np.int64), t["j"].to_numpy().astype(np.int64)])
        n, pos = t["n"].to_numpy().astype(np.int64), t["pos"].to_numpy().astype(np.int64)
        sid, comp, chunk = t["sid"].to_numpy(), t["comp"].to_numpy(), t["chunk"].to_numpy()
        raw, fine = t["point"].to_pylist(), t["fine"].to_numpy(zero_copy_only=False)
        points = np.zeros((len(n), 1 << COARSE), np.uint32)
        for k in np.flatnonzero(~fine):
            points[k] = np.frombuffer(raw[k], np.uint8 if len(raw[k]) == 1 << COARSE else np.uint32)
        edge = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0), True])
        size = np.diff(edge)
        block = np.repeat(np.arange(len(size)), size)
        found = []

        def keep(x, y):
            ok = (comp[x] != comp[y]) & (threshold * n[y] <= 100 * n[x])
            ok &= (key[1][x] == key[2][x]) | (chunk[x] != chunk[y])  # a chunk's own pairs are made once
            x, y = x[ok], y[ok]
            rest = 1 + np.minimum(n[x] - pos[x], n[y] - pos[y]) - 1
            ok = _may_link(n[x], n[y], rest, threshold)
            return x[ok], y[ok]

        # blocks of one leaf, all at once: the pairs at distance d in the same block
        small = ~fine
        for d in range(1, min(LEAF, len(n))):
            x = np.flatnonzero(small[:-d] & (block[:-d] == block[d:]))
            if not len(x):
                break
            x, y = keep(x, x + d)
            for at in range(0, len(x), 1 << 14):
                i, j = x[at:at + (1 << 14)], y[at:at + (1 << 14)]
                ok = _may_link(n[i], n[j], np.minimum(points[i], points[j]).sum(1, dtype=np.int64), threshold)
                found.append((i[ok], j[ok]))
        for k in np.flatnonzero(fine[edge[:-1]]):
            at = edge[k]
            for i, j in _Tree(n[at:edge[k + 1]], raw[at:edge[k + 1]]).pairs(threshold):
                found.append(keep(i + at, j + at))
        x = np.concatenate([f[0] for f in found]) if found else np.empty(0, int)
        y = np.concatenate([f[1] for f in found]) if found else np.empty(0, int)
        both = np.unique(np.stack([np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])], 1), axis=0)
        return pa.RecordBatch.from_pydict({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

    def run(batches):
        # many blocks are joined at a time, so a pair that several of them hold is given once
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < GATHER:
                continue
            t = pa.Table.from_batches(held)
            same = np.ones(rows, bool)
            for c in range(3):
                column = t.column(c).to_numpy()
                same &= column == column[-1]
            cut = rows - int(same.sum())  # whole blocks: the rows are sorted by key, i, j
            if cut:
                yield join(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), rows - cut
        if rows:
            yield join(pa.Table.from_batches(held))

    dealt = (blocks.withColumn("chunks", F.ceil(F.col("c") / BLOCK).cast("int"))
             .withColumn("chunk", F.pmod("sid", F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
             .select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                     "n", "pos", "sid", "comp", "chunk", "point", "fine")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n"))
    return dealt.mapInArrow(lambda b: released(run(b)), "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, text_col: str, words: int,
              threshold: int) -> DataFrame:
    """Links among candidate pairs: the finer points first, then the shingle sets."""
    points = sets.select("sid", "n", "point", "text_hash").dropDuplicates(["sid"])

    def bound(batches):
        for batch in batches:
            ok = [_may_link(na, nb, overlap_bound(x, y), threshold)
                  for na, nb, x, y in zip(*(batch.column(k).to_pylist() for k in range(4, 8)), strict=True)]
            yield batch.select(range(4)).filter(pa.array(ok, pa.bool_()))

    one = points.select(F.col("sid").alias("a"), F.col("text_hash").alias("ha"), F.col("n").alias("na"),
                        F.col("point").alias("pa"))
    two = points.select(F.col("sid").alias("b"), F.col("text_hash").alias("hb"), F.col("n").alias("nb"),
                        F.col("point").alias("pb"))
    left = cut_lineage(pairs.join(one, "a").join(two, "b").select("a", "b", "ha", "hb", "na", "nb", "pa", "pb")
                       .mapInArrow(bound, "a long, b long, ha long, hb long"))
    # texts of these documents alone, thinned in the scan before the exact join
    hashes = left.select(F.explode(F.array("ha", "hb")).alias("text_hash")).distinct()
    text = text_or_empty(docs[text_col])
    rows = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
    thin = hash_thinned(rows, hashes, "text_hash").select("text_hash", "text")

    def shingles(batches):
        for batch in batches:
            for part in _slices(batch, 1):
                d, h = shingle_sets(part.column(1).to_pylist(), words)
                cuts = np.r_[0, np.cumsum(np.bincount(d, minlength=part.num_rows))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h.view(np.int64)))],
                    names=["text_hash", "items"])

    items = cut_lineage(thin.join(hashes, "text_hash", "left_semi").dropDuplicates(["text_hash"])
                        .mapInArrow(lambda b: released(shingles(b)), "text_hash long, items array<long>"))
    x = items.select(F.col("text_hash").alias("ha"), F.col("items").alias("xa"))
    y = items.select(F.col("text_hash").alias("hb"), F.col("items").alias("xb"))
    both = F.size(F.array_intersect("xa", "xb"))
    return (left.join(x, "ha").join(y, "hb")
            .where(100 * both >= threshold * (F.size("xa") + F.size("xb") - both)).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: id, text_hash, n_shingles, sid, component (a sid) and component_id."""
    frequent = frequent_shingles(docs, text_col, words)
    sets = cut_lineage(document_sets(docs, frequent, id_col, text_col, words, threshold))
    entries = (sets.where("n > 0").select("sid", "n", "prefix").dropDuplicates(["sid"])
               .select("sid", "n", F.posexplode("prefix").alias("pos", "key")))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    multi = cut_lineage(entries.join(shared, "key"))

    # star round: each block's pairs with its most central member
    degree = multi.groupBy("sid").agg(F.sum("c").alias("degree"))
    central = multi.join(degree, "sid")
    hub = central.groupBy("key").agg(F.max(F.struct("degree", "sid", "n", "pos")).alias("hub"))
    rest = F.least(F.col("n") - F.col("pos"), F.col("hub.n") - F.col("hub.pos"))
    star = (multi.join(hub, "key").where(F.col("sid") != F.col("hub.sid"))
            .where(_may_link(F.col("n"), F.col("hub.n"), rest, threshold))
            .where((threshold * F.col("n") <= 100 * F.col("hub.n")) & (threshold * F.col("hub.n") <= 100 * F.col("n")))
            .select(F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b")).distinct())
    star = cut_lineage(star)
    links = cut_lineage(_verified(star, docs, sets, text_col, words, threshold))
    found = connected_components(links)

    # the rest: blocks that still hold several components
    labelled = multi.join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "comp", F.coalesce("component", "sid")).drop("component")
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    # blocks of more than a leaf take the fine points: there the number of pairs counts
    points = sets.where("n > 0").select("sid", "point", "coarse").dropDuplicates(["sid"])
    blocks = (labelled.join(mixed.select("key"), "key", "left_semi").withColumn("fine", F.col("c") > LEAF))
    large = blocks.where("fine").join(points.select("sid", "point"), "sid")
    small = blocks.where("not fine").join(points.select("sid", F.col("coarse").alias("point")), "sid")
    blocks = large.unionByName(small)
    more = _block_pairs(blocks, threshold).join(star, ["a", "b"], "left_anti")
    links = links.unionByName(cut_lineage(_verified(more, docs, sets, text_col, words, threshold)))
    found = connected_components(links)

    named = (sets.groupBy("sid").agg(F.min("id").alias("least"), F.first("n").alias("size"))
             .join(found.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("component", F.coalesce("component", "sid")))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = named.join(names, "component").select("sid", "component", "component_id")
    return sets.select("id", "text_hash", "n", "sid").join(labels, "sid").select(
        "id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "sid", "component",
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                         threshold: int = THRESHOLD) -> DataFrame:
    """``df`` with one row of each group: the smallest id (null last), then the smallest text hash.
    Rows with an empty set all stay. All columns are kept as they are."""
    rows = cut_lineage(near_duplicates(df, id_col, text_col, words, threshold).where("n_shingles > 0"))
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("text_hash"))
    best = rows.groupBy("component").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size")).where("size > 1")
    kh, ki = tmp_name(df, "hash"), tmp_name(df, "id")
    judged = rows.join(best, "component").withColumn(
        "stays", F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_hash") == F.col("best.text_hash")))
    lost = judged.where("not stays").select(F.col("text_hash").alias(kh), F.col("id").alias(ki)).distinct()
    wide = df.withColumn(kh, F.xxhash64(text_or_empty(df[text_col])))

    def match(other: DataFrame) -> Column:
        return (wide[kh] == other[kh]) & wide[id_col].eqNullSafe(other[ki])

    kept = wide.join(lost, match(lost), "left_anti")
    # rows that repeat both the id and the text of the one that stays
    tied = cut_lineage(judged.where("stays").groupBy(F.col("text_hash").alias(kh), F.col("id").alias(ki))
                       .count().where("count > 1").drop("count"))
    if tied.take(1):
        kept = (kept.join(tied, match(tied), "left_anti")
                .unionByName(wide.join(tied, match(tied), "left_semi").dropDuplicates([kh, id_col])))
    return kept.drop(kh)
