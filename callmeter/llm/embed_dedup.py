"""Near-duplicate vectors by lattice hashing.

A vector is projected at random to a few blocks of eight dimensions, and each block is
decoded to its nearest point of the E8 lattice; the points together name a cell. Several
tables use different projections. A vector is stored in its own cell and looks also into the
cells that differ in one block, where the second nearest lattice point takes the place of
the nearest. Whatever meets in a cell is compared by cosine in double precision.

A cell's pairs are compared as matrix products inside a task and never emitted: a task emits
sums of links per vector and, for each vector, the smallest one of its local component. Cells
with more vectors than a block holds are dealt out as blocks of stored vectors, each met by a
stream of the cell's vectors, so no task holds a cell. A pair that meets several times (in
several tables, or by looking both ways) is counted where it meets first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import components, stored

TABLES, BLOCKS, SCALE = 8, 2, 3.6
THRESHOLD = 0.95
ROWS_PER_BLOCK = 1024
SEED = 42


def _nearest_d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of D8 (integers with an even sum) to each row, and its squared distance."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(1)
    rows = np.arange(len(x))
    step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    near[rows, worst] += np.where(near.sum(1) % 2 != 0, step, 0.0)
    return near, ((x - near) ** 2).sum(1)


def e8_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and a next nearest E8 lattice point of each row, in half units (integers)."""
    whole, dw = _nearest_d8(x)
    half, dh = _nearest_d8(x - 0.5)
    half += 0.5
    pick = (dw <= dh)[:, None]
    first, other = np.where(pick, whole, half), np.where(pick, half, whole)
    # The runner-up is the other coset's point, or the winner moved along its two worst coordinates.
    off = x - first
    rows = np.arange(len(x))[:, None]
    two = np.argsort(-np.abs(off), axis=1)[:, :2]
    moved = first.copy()
    moved[rows, two] += np.where(off[rows, two] >= 0, 1.0, -1.0)
    closer = (((x - moved) ** 2).sum(1) < np.maximum(dw, dh))[:, None]
    second = np.where(closer, moved, other)
    return np.rint(2 * first).astype(np.int64), np.rint(2 * second).astype(np.int64)


def _named(points: np.ndarray) -> np.ndarray:
    """One 64-bit name for each row of lattice coordinates."""
    name = np.full(len(points), 1469598103934665603, np.uint64)
    for column in points.astype(np.uint64).T:
        name = (name ^ column) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def lattice_cells(
    unit: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE
) -> tuple[np.ndarray, np.ndarray]:
    """Own cell (rows x tables) and cells looked into (rows x tables x blocks) of unit vectors."""
    rng = np.random.default_rng(SEED)
    dim = unit.shape[1]
    own, looked = [], []
    for _ in range(tables):
        # The scale fits distances in 64 dimensions; others are brought to the same spread.
        turn = np.linalg.qr(rng.standard_normal((max(dim, 8 * blocks), 8 * blocks)))[0][:dim]
        x = unit @ turn * (scale * np.sqrt(max(dim, 8 * blocks) / 64))
        points = [e8_points(x[:, 8 * b : 8 * b + 8]) for b in range(blocks)]
        own.append(_named(np.hstack([p[0] for p in points])))
        looked.append(
            np.stack([_named(np.hstack([p[c == b] for c, p in enumerate(points)])) for b in range(blocks)], axis=1)
        )
    return np.stack(own, axis=1), np.stack(looked, axis=1)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), width) if width else flat.reshape(len(column), -1)


def _with_cells(tables: int, blocks: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("v").value_lengths())
            for dim in np.unique(sizes):  # vectors of different lengths never meet: the length is part of the cell
                part = batch.filter(pa.array(sizes == dim))
                v = _matrix(part.column("v"), int(dim), np.float64)
                peak = np.abs(v).max(1, keepdims=True)
                v = v / peak
                v /= np.sqrt((v * v).sum(1, keepdims=True))
                own, looked = lattice_cells(v, tables, blocks, scale)
                own, looked = own ^ (dim * 7919), looked ^ (dim * 7919)
                lists = [
                    pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a.size // len(v)).cast(pa.list_(t))
                    for a, t in ((v, pa.float64()), (own, pa.int64()), (looked.reshape(len(v), -1), pa.int64()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("copies"), *lists], ["uid", "copies", "v", "own", "looked"]
                )

    return run


class _Cell:
    """The stored vectors of one cell block, met by the vectors that look into it."""

    def __init__(self, t: int, tables: int, blocks: int, threshold: float):
        self.t, self.tables, self.blocks, self.threshold = t, tables, blocks, threshold

    def found(self, x: dict, y: dict, t: int) -> np.ndarray:
        own_x, own_y = x["own"][:, t], y["own"][:, t]
        at = slice(t * self.blocks, (t + 1) * self.blocks)
        met = (x["looked"][:, at] == own_y[:, None]).any(1) | (y["looked"][:, at] == own_x[:, None]).any(1)
        return met | (own_x == own_y)

    def meet(self, query: dict, store: dict) -> pa.RecordBatch | None:
        i, j = np.nonzero(query["v"] @ store["v"].T >= self.threshold)
        x, y = ({k: a[n] for k, a in s.items() if k != "v"} for s, n in ((query, i), (store, j)))
        at = slice(self.t * self.blocks, (self.t + 1) * self.blocks)
        same = x["own"][:, self.t] == y["own"][:, self.t]
        back = (y["looked"][:, at] == x["own"][:, self.t][:, None]).any(1)
        keep = np.where(same | back, x["uid"] < y["uid"], True)
        for t in range(self.t):
            keep &= ~self.found(x, y, t)
        if not keep.any():
            return None
        a, b = x["uid"][keep], y["uid"][keep]
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        p, q = place[: len(a)], place[len(a) :]
        links = np.bincount(p, y["copies"][keep], len(nodes)) + np.bincount(q, x["copies"][keep], len(nodes))
        low = np.arange(len(nodes))
        while True:
            least = np.minimum(low[p], low[q])
            new = low.copy()
            np.minimum.at(new, p, least)
            np.minimum.at(new, q, least)
            new = new[new]
            if (new == low).all():
                break
            low = new
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(links.astype(np.int64)), pa.array(nodes[low])], ["uid", "links", "root"]
        )


def _compared(tables: int, blocks: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, store, kept = None, None, []

        def close(cell: _Cell) -> Iterator[pa.RecordBatch]:
            """All stored rows are here: compare those that are queries too."""
            nonlocal store
            if store is None:
                store = {k: np.concatenate([part[k] for part in kept]) for k in kept[0]} if kept else {}
                if store and store["both"].all() and len(store["uid"]) > 1:
                    for at in range(0, len(store["uid"]), ROWS_PER_BLOCK):
                        some = {k: a[at : at + ROWS_PER_BLOCK] for k, a in store.items()}
                        if out := cell.meet(some, store):
                            yield out

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "cell", "part", "role", "both", "uid", "copies")}
            rows |= {"own": _matrix(batch.column("own"), tables, np.int64), "looked": _matrix(batch.column("looked"), tables * blocks, np.int64)}
            sizes = np.asarray(batch.column("v").value_lengths())
            vectors, ends = batch.column("v").flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            names = np.stack([rows["t"].astype(np.int64), rows["cell"], rows["part"].astype(np.int64), rows["role"].astype(np.int64)], axis=1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1), n]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                mine = tuple(names[s][:3])
                if mine != key:
                    if key is not None:
                        yield from close(_Cell(int(key[0]), tables, blocks, threshold))
                    key, store, kept = mine, None, []
                cell = _Cell(int(mine[0]), tables, blocks, threshold)
                dim = int(sizes[s])
                block = {c: rows[c][s:e] for c in ("both", "uid", "copies", "own", "looked")}
                block["v"] = vectors[ends[s] - dim : ends[e - 1]].reshape(e - s, dim)
                if names[s][3] == 0:
                    kept.append(block)
                    continue
                yield from close(cell)
                if store:
                    for at in range(0, e - s, ROWS_PER_BLOCK):
                        some = {k: a[at : at + ROWS_PER_BLOCK] for k, a in block.items()}
                        if out := cell.meet(some, store):
                            yield out
        if key is not None:
            yield from close(_Cell(int(key[0]), tables, blocks, threshold))

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
) -> DataFrame:
    """Links at cosine ``threshold`` or more, and the components they form.

    Returns ``vec_id``, ``n_links`` (other vectors linked directly, copies included),
    ``component_id`` (smallest id reachable) and ``kept`` (its own component's smallest).
    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing and are their own component; a row without an id has no links and a null
    component. Vectors of different lengths never link. Repeated rows link with each other;
    each input row gives one row. Columns besides the two named are not read. The search is
    approximate: all pairs it reports are verified, its recall is measured in the tests.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are one value
    rows = rows.select("vec_id", F.when(usable, plain).alias("v"))
    named = stored(
        rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("uid"), F.count("*").alias("copies")), "vectors"
    )
    kind = "uid bigint, copies bigint, v array<double>, own array<bigint>, looked array<bigint>"
    cells = stored(named.mapInArrow(_with_cells(tables, blocks, scale), kind), "vectors")

    own = cells.select("*", F.posexplode("own").alias("t", "cell"))
    heavy = own.groupBy("t", "cell").count().where(F.col("count") > ROWS_PER_BLOCK)
    heavy = stored(heavy.select("t", "cell", F.ceil(F.col("count") / ROWS_PER_BLOCK).cast("int").alias("parts")), "vectors")
    own = own.join(heavy, ["t", "cell"], "left")
    split = F.col("parts").isNotNull()
    looking = cells.select("*", F.posexplode("looked").alias("n", "cell"))
    looking = looking.withColumn("t", F.floor(F.col("n") / blocks).cast("int")).drop("n").join(heavy, ["t", "cell"], "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    names = ["t", "cell", "uid", "copies", "v", "own", "looked"]
    one = F.when(split, F.pmod(F.xxhash64("uid"), F.col("parts").cast("bigint"))).otherwise(0).cast("int").alias("part")
    met = own.select(*names, one, F.lit(0).alias("role"), (~split).alias("both"))
    met = met.union(own.where(split).select(*names, every, F.lit(1).alias("role"), F.lit(False).alias("both")))
    met = met.union(looking.select(*names, every, F.lit(1).alias("role"), F.lit(False).alias("both")))
    dealt = met.repartition("t", "cell", "part").sortWithinPartitions("t", "cell", "part", "role")
    found = stored(dealt.mapInArrow(_compared(tables, blocks, threshold), "uid bigint, links bigint, root bigint"), "vectors")

    joined = components(found.where("uid <> root").select(F.col("uid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    figures = named.join(links, "uid", "left").join(joined, F.col("uid") == F.col("node"), "left")
    figures = figures.select(
        F.col("v").alias("u"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "uid").alias("c"),
    )
    out = rows.join(figures, F.col("v") == F.col("u"), "left")
    component = F.coalesce("c", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
