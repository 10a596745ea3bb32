"""Exact top-k by inner product, with a table of distances to pivots.

Every vector's distances to a set of pivots are computed once and stored beside it. For a query q
and a candidate x, each pivot p gives ``|d(q, p) - d(x, p)|`` as a lower bound of their distance; the
largest of them bounds the score from above, as ``<q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2``. A
candidate whose bound is below the k-th best score known cannot be a result. The others are scored
in the order of their bounds until the next bound is below the k-th best score found: the rest
need no look. Pivots are vectors of the table, so their own scores give a first k-th best.

Queries and candidates meet as blocks of bounded size, each pair of blocks in a group of its own.
A task emits the few best of a query in its block; the best of those are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm.common import column, stored

K, SCALE = 5, 256.0
#: Pivots, and vectors of the sample (chosen by hash) that they are taken from, at most.
PIVOTS, SAMPLE = 48, 4096
#: Candidates and queries of a block, on average.
BLOCK, QUERY_BLOCK = 2048, 1024
#: Pivots looked at before the rest, for those that are left.
FIRST = 12
#: Squared lengths below this keep sums of products exact in double precision.
EXACT = float(1 << 52)


def _fitted(pivots: list[list[int]], dim: int) -> np.ndarray:
    """Pivots as points of ``dim`` dimensions: cut, or filled with zeros."""
    return np.array([(p + [0] * dim)[:dim] for p in pivots], np.float64).reshape(len(pivots), dim)


def far_apart(vectors: list[list[int]], n: int) -> list[list[int]]:
    """``n`` of the vectors, each the one farthest from those before it."""
    if not vectors:
        return []
    points = _fitted(vectors, max(map(len, vectors)))
    taken = [int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))]
    away = ((points - points[taken[0]]) ** 2).sum(1)
    while len(taken) < n and away.max() > 0:
        taken.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[taken[-1]]) ** 2).sum(1))
    return [vectors[i] for i in taken]


def _matrix(lists: pa.ListArray, kind: type) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(lists), -1) if len(flat) else np.zeros((len(lists), 0), kind)


def _by_length(lists: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.asarray(lists.value_lengths())
    for dim in np.unique(sizes).tolist():
        yield dim, np.flatnonzero(sizes == dim)


def _with_distances(pivots: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for dim, rows in _by_length(batch.column("v")):
                part = batch.take(pa.array(rows))
                x = _matrix(part.column("v"), np.float64)
                points = _fitted(pivots, dim)
                away = np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in points], axis=1) if len(points) else np.zeros((len(x), 0))
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(points))
                columns = [
                    pa.array(number + np.arange(len(x))),
                    part.column("vec_id"),
                    part.column("ask"),
                    part.column("v"),
                    pa.array((x * x).sum(1)),
                    pa.ListArray.from_arrays(offsets, pa.array(away.ravel().astype(np.float32))),
                ]
                number += len(x)
                yield pa.RecordBatch.from_arrays(columns, ["uid", "vec_id", "ask", "v", "squared", "away"])

    return run


class _Block:
    """Candidates of one block and one length, and what is known of them beforehand."""

    def __init__(self, rows: pa.Table):
        self.uid = rows["uid"].to_numpy()
        self.squared = rows["squared"].to_numpy()
        self.away = np.ascontiguousarray(_matrix(rows["away"].combine_chunks(), np.float64))
        self.exact = bool((self.squared < EXACT).all())
        self.v = _matrix(rows["v"].combine_chunks(), np.float64 if self.exact else np.int64)
        self.far = self.away.max(1, initial=0.0)

    def bounds(self, some: np.ndarray | slice, query: dict, pivots: slice) -> np.ndarray:
        """No score of these candidates is above its bound."""
        gap = np.abs(self.away[some, pivots] - query["away"][pivots]).max(1, initial=0.0)
        # Stored distances are rounded to single precision.
        gap = np.maximum(gap - 1e-6 * (self.far[some] + query["far"]), 0.0)
        whole = self.squared[some] + query["squared"]
        return (whole - gap * gap) / 2 + 1e-9 * whole + 0.5

    def scores(self, some: np.ndarray, query: dict) -> np.ndarray:
        if self.exact and query["squared"] < EXACT:
            return (self.v[some] @ query["v"].astype(np.float64)).astype(np.int64)
        exact = self.v[some].astype(np.int64).astype(object) @ query["v"].astype(object)
        return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact], np.int64)

    def best(self, query: dict, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Candidates among which the block's ``k`` best of at least ``least`` are, with all that tie, and their scores."""
        alive = np.flatnonzero(self.uid != query["uid"])
        if not (self.exact and query["squared"] < EXACT):
            return alive, self.scores(alive, query)
        bound = self.bounds(slice(None), query, slice(0, FIRST))[alive]
        alive = alive[bound >= least]
        bound = np.minimum(bound[bound >= least], self.bounds(alive, query, slice(FIRST, None)))
        order = np.argsort(-bound, kind="stable")
        alive, bound = alive[order], bound[order]
        found, scores, at, step = [], np.zeros(0, np.int64), 0, 4 * k
        while at < len(alive) and bound[at] >= least:
            found.append(alive[at : at + step])
            scores = np.concatenate([scores, self.scores(found[-1], query)])
            if len(scores) >= k:
                least = max(least, np.partition(scores, len(scores) - k)[len(scores) - k])
            at, step = at + step, 2 * step
        taken = np.concatenate(found) if found else alive[:0]
        return taken[scores >= least], scores[scores >= least]


def _met(pivots: list[list[int]], k: int):
    kind = pa.schema([("uid", pa.int64()), ("query_id", pa.int64()), ("copies", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def first_best(v: np.ndarray) -> float:
        """The k-th best score is not below this one: of pivots as long as the query, the next but the k-th best."""
        same = [p for p in pivots if len(p) == len(v)]
        points = _fitted(same, len(v))
        if len(same) <= k or (points * points).sum(1).max() >= EXACT or (v.astype(np.float64) ** 2).sum() >= EXACT:
            return -np.inf
        return float(np.sort(points @ v)[-(k + 1)])

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if not (candidates.num_rows and queries.num_rows):
            return kind.empty_table()
        dims = {dim: rows for dim, rows in _by_length(queries["v"].combine_chunks())}
        for dim, rows in _by_length(candidates["v"].combine_chunks()):
            if dim not in dims:
                continue
            mine = candidates.take(pa.array(rows))
            block, ids = _Block(mine), mine["vec_id"].combine_chunks()
            asking = queries.take(pa.array(dims[dim]))
            v, away = _matrix(asking["v"].combine_chunks(), np.int64), _matrix(asking["away"].combine_chunks(), np.float64)
            plain = {c: asking[c].to_numpy() for c in ("uid", "query_id", "copies", "squared")}
            for i in range(len(v)):
                query = {"uid": plain["uid"][i], "squared": plain["squared"][i], "v": v[i], "away": away[i], "far": away[i].max(initial=0.0)}
                found, scores = block.best(query, k, first_best(v[i]))
                if len(found) > k:  # ties beyond the k-th go by id, rows without one last
                    given = np.nan_to_num(ids.take(pa.array(found)).is_null().to_numpy(zero_copy_only=False))
                    named = ids.take(pa.array(found)).fill_null(0).to_numpy()
                    keep = np.lexsort((named, given, -scores))[:k]
                    found, scores = found[keep], scores[keep]
                n = len(found)
                if n:
                    out.append(
                        pa.table(
                            [np.full(n, plain["uid"][i]), np.full(n, plain["query_id"][i]), np.full(n, plain["copies"][i]), ids.take(pa.array(found)), scores],
                            schema=kind,
                        )
                    )
        return pa.concat_tables(out) if out else kind.empty_table()

    return meet


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = SCALE,
    pivots: int = PIVOTS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` rows of highest inner product with each row for which ``asks`` holds.

    A component x counts as ``floor(scale * x)``, in double precision. Candidates of a query are all
    rows but itself; a row repeated in full is another row, and a repeated query gives its rows as
    often. Fewer candidates than ``k`` give fewer rows. Ties go to the smaller id, rows without an
    id last. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, all exact.

    Vectors that are null or hold null or non-finite components take no part, neither do queries
    without an id; vectors of different lengths never meet; empty ones score 0. Components and
    scores beyond 64 bits are held at its limits. Other columns are read by ``asks`` alone.
    """
    x = column(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(x.isNotNull() & finite).select(
        column(id_col).cast("bigint").alias("vec_id"),
        (F.coalesce(asks, F.lit(False)) & column(id_col).isNotNull()).alias("ask"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v"),
    )
    n = rows.count()
    # Equal vectors have equal hashes, so a frequent one is in the sample once.
    thin = max(1, n // (SAMPLE // 2))
    chosen = rows.where(F.pmod(F.xxhash64("v", F.lit(1)), F.lit(thin)) == 0).select("v").distinct()
    chosen = far_apart([r["v"] for r in chosen.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()], pivots)
    with_distances = rows.mapInArrow(
        _with_distances(chosen), "uid bigint, vec_id bigint, ask boolean, v array<bigint>, squared double, away array<float>"
    )
    table = stored(with_distances, "vectors")

    same = table.where("ask").groupBy(F.col("vec_id").alias("query_id"), "v")
    queries = same.agg(F.min("uid").alias("uid"), F.count("*").alias("copies"), F.first("squared").alias("squared"), F.first("away").alias("away"))
    queries = stored(queries, "queries")
    blocks, parts = max(1, math.ceil(n / block)), max(1, math.ceil(queries.count() / query_block))
    spread = lambda of, into: F.pmod(F.xxhash64("uid"), F.lit(into)).cast("int").alias(of)
    each = lambda of, into: F.explode(F.sequence(F.lit(0), F.lit(into - 1))).alias(of)
    left = table.select("uid", "vec_id", "v", "squared", "away", spread("block", blocks), each("part", parts))
    right = queries.select("*", spread("part", parts), each("block", blocks))
    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    found = met.applyInArrow(_met(chosen, k), "uid bigint, query_id bigint, copies bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    every = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return best.select("query_id", "rank", "vec_id", "score", every).drop("copy")
