"""Exact top-k inner products with block-at-a-time pruning.

Rows are packed into document-range blocks: each packed row carries the ids and integer vectors of up to CHUNK rows, its
forward index, cut into blocks of BLOCK. For a block every component's maximum and minimum are known, so the sum over
components of query * extreme bounds any score in it. Per query, blocks are visited by falling bound, and the visit ends
once the bound is below the query's k-th score so far (an equal bound still counts, as ties go to the smaller id).

The query set is a stated part of the rows. It is cut into blocks of QUERY_BLOCK vectors; one block at a time is broadcast
(its size is bounded by QUERY_BLOCK * dimension * 8 bytes) against all packed rows. Each task keeps k scores per query, and
only those are shuffled.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an id, take no part; vectors
are compared with those of their own length; equal rows of a query count once; repeated candidate rows are all candidates,
except those that bear the query's id; empty tables give an empty result; extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.session import stage

CHUNK, BLOCK, QUERY_BLOCK = 4096, 64, 8192
PACKED = "dim int, n int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"
NONE = np.iinfo(np.int64).min


def quantised(vector: Column, scale=64) -> Column:
    """floor(scale * x) of each component as array<long>; null where a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(1e300)))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale)))


def pack(vectors: DataFrame, size: int) -> DataFrame:
    """(vec_id long, v array<long>) -> rows of up to `size` vectors of one length each."""
    def packed(batches):
        waiting: dict[int, list] = {}
        for b in batches:
            ids, lists = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), b.column(1)
            lengths, flat = np.diff(lists.offsets.to_numpy()), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
            starts, flat = lists.offsets.to_numpy()[:-1], flat
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                held = waiting.setdefault(int(dim), [])
                held.append((ids[at], flat[starts[at][:, None] + np.arange(dim)]))
                if sum(len(x[0]) for x in held) >= size:
                    yield from _rows(int(dim), waiting.pop(int(dim)), size)
        for dim, held in waiting.items():
            yield from _rows(dim, held, size)

    return vectors.mapInArrow(packed, PACKED)


def _rows(dim: int, held: list, size: int):
    ids, vs = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
    for lo in range(0, len(ids), size):
        i, v = ids[lo:lo + size], np.ascontiguousarray(vs[lo:lo + size])
        yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "n": pa.array([len(i)], pa.int32()),
                                          "ids": pa.array([i.tobytes()], pa.binary()),
                                          "vectors": pa.array([v.tobytes()], pa.binary())})


def unpacked(dim: int, n: int, ids: bytes, vectors: bytes):
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(n, dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a with all rows of b."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of each query of a block, fed chunk by chunk."""

    def __init__(self, qids: np.ndarray, queries: np.ndarray, k: int):
        self.qids, self.q, self.k = qids, queries, k
        self.pos, self.neg = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        self.score = np.full((len(qids), k), NONE, np.int64)
        self.ids = np.full((len(qids), k), np.iinfo(np.int64).max, np.int64)
        self.visited = 0

    def feed(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        cuts = np.arange(0, len(ids), BLOCK)
        high = np.maximum.reduceat(vectors, cuts, axis=0).astype(np.float64)
        low = np.minimum.reduceat(vectors, cuts, axis=0).astype(np.float64)
        bound = self.pos @ high.T + self.neg @ low.T  # summed term maxima; the slack covers rounding of large values
        bound += np.abs(bound) * 1e-12
        order = np.argsort(-bound, axis=1, kind="stable")
        for step in range(len(cuts)):
            at = order[:, step]
            live = np.flatnonzero(np.take_along_axis(bound, at[:, None], 1)[:, 0] >= self.score[:, -1])
            if not len(live):
                break  # bounds only fall from here
            for b in np.unique(at[live]):
                self._block(live[at[live] == b], ids[cuts[b]:cuts[b] + BLOCK], vectors[cuts[b]:cuts[b] + BLOCK])

    def _block(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.visited += len(rows)
        got = scores(self.q[rows], vectors)
        got[self.qids[rows][:, None] == ids[None, :]] = NONE
        better = (got >= self.score[rows, -1][:, None]).any(axis=1)
        rows, got = rows[better], got[better]
        if not len(rows):
            return
        s = np.concatenate([self.score[rows], got], axis=1)
        i = np.concatenate([self.ids[rows], np.where(got == NONE, np.iinfo(np.int64).max, ids[None, :])], axis=1)
        take = np.lexsort((i, -s.astype(np.float64) if np.abs(got).max(initial=0) < 2 ** 52 else ~s), axis=1)[:, :self.k]
        self.score[rows], self.ids[rows] = np.take_along_axis(s, take, 1), np.take_along_axis(i, take, 1)

    def rows(self) -> pa.RecordBatch:
        full = self.ids != np.iinfo(np.int64).max
        return pa.RecordBatch.from_pydict({"query_id": np.repeat(self.qids, full.sum(axis=1)), "vec_id": self.ids[full],
                                           "score": self.score[full]})


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score; vectors: (vec_id, v array<long>), is_query: a condition on vec_id."""
    spark = vectors.sparkSession
    usable = vectors.filter("vec_id IS NOT NULL AND v IS NOT NULL").select(F.col("vec_id").cast("long"), "v")
    queries = usable.filter(is_query).distinct()
    blocks = -(-queries.count() // QUERY_BLOCK)
    packed = stage(pack(usable, CHUNK), "vectors")
    asked = stage(pack(queries.repartition(max(1, blocks)), QUERY_BLOCK), "queries")
    found = None
    for block in asked.toLocalIterator():  # one block of queries at a time
        sent = spark.sparkContext.broadcast(tuple(block))

        def search(batches, sent=sent):
            qdim = sent.value[0]
            best = Best(*unpacked(*sent.value), k)
            for b in batches:
                for row in b.to_pylist():
                    if row["dim"] == qdim:
                        best.feed(*unpacked(**row))
            yield best.rows()

        part = packed.mapInArrow(search, FOUND)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
