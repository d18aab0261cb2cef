"""Approximate nearest neighbours by cosine: a hash-prefix forest over blocks of rows.

A tree hashes a vector to a long bit string (the signs of random projections)
and keeps the strings of its rows as a sorted array, so the rows that share a
prefix with a query are one range of it. A search descends each tree to the
longest matching prefix, then ascends all trees together, one bit at a time,
until the ranges hold enough candidates (a share of the block's rows); those
are scored exactly on the original vectors.

The forest is sharded by rows: each task builds the trees of its own block of
rows, searches it with a block of queries and returns the best ``k`` per query,
and the best of all blocks are the result. Rows are not copied from tree to
tree, a block's memory is bounded, every row is indexed, and a hot group of
equal vectors is spread over the blocks like all other rows. Queries travel in
blocks too. The share of candidates does not fall with the size of the table,
so neither does recall: it was measured against brute force (see README).

Cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows without an id; vectors are compared with those of their
own length only. Of equal scores the smaller id comes first; rows repeated with one id
count once (the largest score). With fewer candidates than ``k`` all are
returned. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage

TREES = 32
BITS = 64
SHARE = 0.55  # of a block's rows: candidates per query
LEAST = 256  # candidates per query and block, if there are as many
LEAST_ROWS = 4096  # of a block: one per core, within these
MOST_ROWS = 1 << 16
QUERY_ROWS = 1024


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision; a pair's value
    does not depend on its place."""
    dot = np.array([(x * y).sum() for x, y in zip(a, b, strict=True)])
    return dot / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


class Forest:
    """Sorted hash arrays of one block of vectors, one per tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, seed: int = 7) -> None:
        self.ids, self.vectors = ids, vectors
        self.most = int(np.unique(ids, return_counts=True)[1].max())  # rows of one id
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], BITS))
        self.order, self.sorted = [], []
        for plane in self.planes:
            h = self._hash(self.unit, plane)
            order = np.argsort(h, kind="stable")
            self.order.append(order)
            self.sorted.append(h[order])

    @staticmethod
    def _hash(unit: np.ndarray, plane: np.ndarray) -> np.ndarray:
        bits = (unit @ plane > 0).astype(np.uint64)
        return (bits << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, share: float = SHARE, least: int = LEAST):
        """For each query the (scores, ids) of its best k, without the row of its own id."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        want = max(least, int(np.ceil(share * len(self.ids))))
        hashes = [self._hash(unit, p) for p in self.planes]
        low = np.zeros((len(self.planes), len(queries)), np.int64)
        high = np.zeros_like(low)
        open_ = np.arange(len(queries))  # queries that still ascend
        for depth in range(BITS, -1, -1):
            rest = np.uint64((1 << (BITS - depth)) - 1)
            for t, h in enumerate(hashes):
                low[t, open_] = np.searchsorted(self.sorted[t], h[open_] & ~rest, "left")
                high[t, open_] = np.searchsorted(self.sorted[t], h[open_] | rest, "right")
            # ranges of different trees overlap, so their sum alone is no proof of enough rows; as each
            # tree holds a row with a probability of its own, the distinct share follows from the shares
            outside = np.prod(1 - (high - low)[:, open_] / len(self.ids), axis=0)
            open_ = open_[(1 - outside) * len(self.ids) < want]
            if not len(open_) or not depth:
                break
        for q in range(len(queries)):
            held = np.zeros(len(self.ids), bool)
            for t, order in enumerate(self.order):
                held[order[low[t, q]:high[t, q]]] = True
            held &= self.ids != own[q]
            rows = np.flatnonzero(held)
            near = self.unit[rows] @ unit[q]
            last = k * self.most
            if len(rows) > last:  # all that may be among the best, ties and rounding included
                rows = rows[near >= np.partition(near, len(near) - last)[len(near) - last] - 1e-9]
            score = cosine(np.broadcast_to(queries[q], (len(rows), queries.shape[1])), self.vectors[rows])
            best = np.lexsort((self.ids[rows], -score))
            if self.most > 1:  # an id counts once, by its best row
                best = best[np.sort(np.unique(self.ids[rows[best]], return_index=True)[1])]
            best = best[:k]
            yield score[best], self.ids[rows[best]]


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (id, vector) dealt evenly to ``blocks`` blocks: (block, dim, ids, vectors), one row per
    block and length of vector, the numbers as binaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(len(v), []).append((i, np.array(v, np.float64)))
        for dim, some in held.items():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([TaskContext.get().partitionId()], pa.int32()), "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([np.array([i for i, _ in some], np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([np.array([v for _, v in some]).tobytes()], pa.binary())})

    return rows.repartition(blocks).mapInArrow(run, "block int, dim int, ids binary, vectors binary")


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    value = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(value, lambda x: x != 0)


def nearest(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, share: float = SHARE) -> DataFrame:
    """(query_id, rank, id, score): for each query row its k nearest other rows that the forest finds."""
    vector = F.transform(table[vector_col], lambda x: x.cast("double"))
    rows = table.where(usable(table[vector_col]) & table[id_col].isNotNull()).select(
        table[id_col].cast("long").alias("id"), vector.alias("vector"), is_query.alias("is_query"))
    rows = cut_lineage(rows)
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_query").alias("queries")).first()
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = min(MOST_ROWS, max(LEAST_ROWS, -(-total["rows"] // cores)))
    blocks = max(1, -(-total["rows"] // size))
    data = _packed(rows.select("id", "vector"), blocks).withColumn("kind", F.lit(0))
    queries = (_packed(rows.where("is_query").select("id", "vector"), max(1, -(-total["queries"] // QUERY_ROWS)))
               .withColumn("kind", F.lit(1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    # each block of rows, then the blocks of queries that meet it, one after the other
    met = (data.unionByName(queries).repartition(blocks, "block").sortWithinPartitions("block", "kind")
           .select("block", "kind", "dim", "ids", "vectors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, forests = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                here, kind, dim, raw_ids, raw = (batch.column(c)[at].as_py() for c in range(5))
                ids, vectors = np.frombuffer(raw_ids, np.int64), np.frombuffer(raw, np.float64).reshape(-1, dim)
                if here != block:
                    block, forests = here, {}
                if kind == 0:
                    forests[dim] = Forest(ids, vectors, trees)
                elif dim in forests:
                    found = list(forests[dim].search(vectors, ids, k, share))
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(np.repeat(ids, [len(s) for s, _ in found]), pa.int64()),
                        "id": pa.array(np.concatenate([i for _, i in found]), pa.int64()),
                        "score": pa.array(np.concatenate([s for s, _ in found]), pa.float64())})

    best = met.mapInArrow(run, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (best.groupBy("query_id", "id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
