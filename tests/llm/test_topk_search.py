"""Exact top-k against scoring every pair."""

import math
import random

import pytest
from compare import connect, differences
from conftest import SF_DIR
from pyspark.sql import functions as F

from callmeter.llm import queries, topk_search


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, asks, k, scale=256.0):
    held = lambda n: max(-(1 << 63), min((1 << 63) - 1, n))
    whole = [(i, [held(math.floor(scale * x)) for x in v]) for i, v in rows if usable(v)]
    out = []
    for at, (q, a) in enumerate(whole):
        if q is None or not asks(q):
            continue
        scored = [(held(sum(x * y for x, y in zip(a, b))), i) for n, (i, b) in enumerate(whole) if n != at and len(b) == len(a)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, rank, i, score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect()), key=repr)


KIND = "vec_id bigint, embedding array<float>, score string, `a.b` int"


@pytest.mark.parametrize("block, query_block, pivots", [(2048, 1024, 48), (7, 3, 5), (40, 1, 0)])
def test_against_every_pair(spark, block, query_block, pivots):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(160):
        c = rng.choice(centres)
        v = [x + rng.choice([0.0, 0.0, 0.05]) * rng.gauss(0, 1) for x in c]
        rows.append((rng.choice([i, i, 50, 100, None, -50]), v))
    rows += [(300 + i, centres[0]) for i in range(60)] + [(400, centres[0])] * 9
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], KIND).repartition(5)
    narrow = [(i, [float(x) for x in r]) for i, r in df.select("vec_id", "embedding").collect()]
    got = topk_search.top_k(df, F.col("vec_id") % 50 == 0, k=4, block=block, query_block=query_block, pivots=pivots)
    assert result(got) == brute(narrow, lambda i: i % 50 == 0, 4)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, [0.0, 0.0]),
        (300, []), (301, []), (350, [1.0, 2.0, 3.0]), (1, [-1.0, -0.0]), (2, [1e30, 1e30]), (400, [-1e30, 1e30]),
        (3, [3e7, 4e7]), (450, [3e7, 4e7]), (None, [1.0, 2.0]), (4, [0.001, -0.001]),
    ]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], KIND)
    narrow = [(r[0], r[1] and list(r[1])) for r in df.select("vec_id", "embedding").collect()]
    assert result(topk_search.top_k(df, F.col("vec_id") % 50 == 0)) == brute(narrow, lambda i: i % 50 == 0, 5)
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk_search.top_k(df, F.col("vec_id") == 7).collect() == []
    renamed = df.withColumnRenamed("embedding", "e.v")
    assert topk_search.top_k(renamed, F.col("vec_id") == 0, vector_col="e.v").count() == 5


def test_bounds_hold(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (200, 16))
    pivots = topk_search.far_apart(v[:60].tolist(), 20)
    away = np.sqrt(((v[:, None] - np.array(pivots)[None]) ** 2).sum(2)).astype(np.float32)
    table = pa.table({"uid": range(200), "vec_id": range(200), "v": v.tolist(), "squared": (v * v).sum(1).astype(float), "away": away.tolist()})
    block = topk_search._Block(table)
    for i in range(0, 200, 9):
        query = {"uid": i, "squared": float((v[i] ** 2).sum()), "v": v[i], "away": away[i].astype(float), "far": float(away[i].max())}
        assert (block.bounds(slice(None), query, slice(0, None)) >= v @ v[i]).all()


def test_query_equals_sql(spark):
    assert differences(queries.op11_topk_search(spark, SF_DIR), connect(SF_DIR), queries.ORACLE["op11_topk_search"]) == []
