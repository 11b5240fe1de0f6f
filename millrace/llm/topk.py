"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are dealt to shards by hash. In a shard, each dimension is a posting list in
order of its components, cut into ``LEVELS`` segments of equal impact width. Read from
the end that the sign of the query's component asks for, a segment raises a score by at
most the query's component times the segment's best impact, counted from the worst impact
of its dimension, so all contributions are zero or more.

A query processes segments by descending contribution. Now and then it looks for a proof.
Each accumulator then holds what the seen dimensions of a vector can give beyond
what an unseen one can at most, and adding the latter gives an upper bound of the score.
The exact scores of the vectors with the best accumulators give a threshold. A vector
whose bound is below it is proven out. The query stops when all but a small share of the
shard is proven out, or when no segment is left; the possible members that remain are
rescored exactly, however many they are. Shards give their best k each, and a window the best of
those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

SHARD_ROWS = 16_384
#: Queries that meet a shard in one group.
QUERY_ROWS = 4_096
LEVELS = 32
#: Shares of the postings after which a query looks for a proof; the last one is all of them.
LOOKS = (0.75, 0.9, 1.0)
#: Share of a shard that may be possible members when the proof counts as found.
PROVEN = 1 / 8
#: Squared length of a vector of whole numbers; below it no score leaves 64 bits.
LONGEST = 1 << 58
#: Vectors with the best accumulators whose exact scores give the threshold.
PROBED = 64
SCALE = 1024


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)``: ``floor(scale * component)`` as bytes of 64-bit numbers.

    Rows without vec_id, vectors that are null and vectors with a null or non-finite
    component are left out. Rows that repeat an id and its vector are one row. An empty
    vector has score 0 with any other. A vector whose squared length would reach ``LONGEST``
    fails the job, as scores could leave 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = v.values
                if not v.is_valid or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    x = np.floor(scale * x)
                    if not (x * x).sum() < LONGEST:
                        raise ValueError(f"vector {vec_id} is too long for scores of 64 bits")
                    ids.append(vec_id)
                    out.append(x.astype("<i8").tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "v"])

    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"
    )
    return rows.mapInArrow(run, "vec_id bigint, v binary").distinct()


def _matrix(values: list[bytes], dims: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    rows = [np.frombuffer(v, "<i8") for v in values]
    out = np.zeros((len(rows), max([dims, *map(len, rows)])), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Index:
    """The posting lists of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        n, dims = x.shape
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32).T.copy()
        self.least, self.most = x.min(axis=0), x.max(axis=0)
        self.width = (self.most - self.least) // LEVELS + 1
        level = (np.take_along_axis(x.T, self.order.astype(np.int64), axis=1) - self.least[:, None]) // self.width[:, None]
        edges = np.arange(LEVELS + 1)
        self.starts = np.array([np.searchsorted(row, edges) for row in level], np.int64).reshape(dims, LEVELS + 1)

    def bytes(self) -> dict[str, bytes]:
        return {k: np.ascontiguousarray(getattr(self, k)).tobytes() for k in ("ids", "x", "order", "starts")}

    @classmethod
    def read(cls, row: dict) -> Index:
        out = cls.__new__(cls)
        out.ids = np.frombuffer(row["ids"], np.int64)
        n = len(out.ids)
        out.x = np.frombuffer(row["x"], np.int64).reshape(n, -1)
        out.order = np.frombuffer(row["order"], np.int32).reshape(-1, n)
        out.starts = np.frombuffer(row["starts"], np.int64).reshape(-1, LEVELS + 1)
        out.least, out.most = out.x.min(axis=0), out.x.max(axis=0)
        out.width = (out.most - out.least) // LEVELS + 1
        return out

    def best(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the shard's best ``k``, the query's own id left out."""
        n, dims = self.x.shape
        q = np.concatenate((q, np.zeros(max(0, dims - len(q)), np.int64)))[:dims]
        up = q >= 0
        # Best impact of each segment, counted from the worst of its dimension.
        low = self.least[:, None] + np.arange(LEVELS) * self.width[:, None]
        high = np.minimum(low + self.width[:, None] - 1, self.most[:, None])
        impact = np.where(up[:, None], high - self.least[:, None], self.most[:, None] - low)
        gain = np.abs(q)[:, None] * np.maximum(impact, 0)
        sizes = np.diff(self.starts, axis=1)
        order = np.argsort(-gain, axis=None, kind="stable")
        done = np.cumsum(sizes.ravel()[order])
        own = self.ids == query_id
        possible = np.flatnonzero(~own)
        for share in LOOKS:
            taken = order[: int(np.searchsorted(done, share * n * dims)) + 1]
            left = np.ones(dims * LEVELS, bool)
            left[taken] = False
            rest = np.where(left.reshape(dims, LEVELS) & (sizes > 0), gain, 0).max(axis=1, initial=0)
            beyond = gain - rest[:, None]
            score = np.zeros(n, np.int64)
            for d, level in zip(*(a.tolist() for a in np.divmod(taken, LEVELS))):
                a, b = self.starts[d, level], self.starts[d, level + 1]
                if b > a:
                    score[self.order[d, a:b]] += beyond[d, level]
            score[own] = np.iinfo(np.int64).min // 2
            floor = int(np.where(up, q * self.least, q * self.most).sum() + rest.sum())
            m = min(n, max(k, PROBED))
            probed = np.argpartition(-score, m - 1)[:m]
            exact = self.x[probed[~own[probed]]] @ q
            if len(exact) < k:
                break
            threshold = np.partition(exact, len(exact) - k)[len(exact) - k]
            possible = np.flatnonzero((score + floor >= threshold) & ~own)
            if len(possible) <= PROVEN * n:
                break
        exact = self.x[possible] @ q
        top = np.lexsort((self.ids[possible], -exact))[:k]
        return self.ids[possible[top]], exact[top]


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard of quantised vectors: its ids, vectors and posting lists."""
    shards = max(1, -(-vectors.count() // shard_rows))

    def run(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        x = _matrix(group.column("v").to_pylist())
        made = Index(group.column("vec_id").to_numpy(), x).bytes()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64())} | {k: pa.array([v], pa.binary()) for k, v in made.items()})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(
        run, "shard bigint, ids binary, x binary, order binary, starts binary"
    )


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` vectors for each query.

    ``queries`` are quantised vectors. Vectors with the query's id are left out; ties go
    to the smaller vec_id; a query has fewer rows where there are fewer vectors. Vectors
    of different length compare as if filled up with zeros. Empty tables give no rows.
    """
    blocks = max(1, -(-queries.count() // query_rows))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    # Every query meets every shard, in blocks. Shards are numbered from 0 without gaps.
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    per_shard = queries.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
        block.alias("block"),
        F.col("vec_id").alias("query_id"),
        "v",
    )
    copies = index.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    )

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, found, scores = [], [], []
        if left.num_rows and right.num_rows:
            shard = Index.read({c: left.column(c)[0].as_py() for c in ("ids", "x", "order", "starts")})
            for query_id, v in zip(right.column("query_id").to_pylist(), right.column("v").to_pylist()):
                best, score = shard.best(query_id, np.frombuffer(v, "<i8"), k)
                ids.append(np.full(len(best), query_id, np.int64))
                found.append(best)
                scores.append(score)
        join = lambda parts: np.concatenate([np.empty(0, np.int64), *parts])
        return pa.table({"query_id": join(ids), "vec_id": join(found), "score": join(scores)})

    partial = (
        copies.groupBy("shard", "block")
        .cogroup(per_shard.groupBy("shard", "block"))
        .applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        partial.distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def search(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Indexes all vectors and asks for the best of those whose id ``every`` divides."""
    whole = stored(quantised(vectors), "vectors")
    index = stored(build_index(whole), "impact-index")
    return top_k(index, whole.filter(F.col("vec_id") % every == 0), k)
