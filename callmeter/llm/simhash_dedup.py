"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

A fingerprint's row in the pivot table holds its Hamming distances to reference
fingerprints. The references are of two kinds:

- *Masks*: the zero fingerprint and masks of two bits each that together cover all 64. The
  distances to zero and to a mask give the number of set bits under the mask, so they place
  a fingerprint in a grid. Two fingerprints at most k bits apart differ under at most k
  masks; with the masks dealt into k + 2 groups, two groups at least agree in full. Pairs
  are therefore looked up by each two groups: an equality join, no link is lost.
- *Random references*: by the triangle inequality no distance to them may differ by more
  than k between the two. Pairs that fail at any of them are discarded; the rest is verified
  bit by bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm.common import components, sliced, stored

SEED = 42
REFERENCES = 24
_MASK_BITS = 2
_MASKS = 64 // _MASK_BITS


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``size`` words of a text, A-Z in lower case, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, seed)], np.uint64)
    spans = zip(starts, ends[size - 1 :], strict=False)
    return np.fromiter((digest(joined[s : e - 1], seed) for s, e in spans), np.uint64)


_LANES = np.arange(8, dtype=np.int64) * 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits: one is set where more than half of the hashes have it."""
    if not len(hashes):
        return 0
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, axis=1, bitorder="little").ravel().view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a bigint) of each row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(shingle_hashes(t.as_py() or b"", shingle)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp bigint"
    )


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(fps: DataFrame, max_distance: int) -> DataFrame:
    """``fp`` (distinct), ``grid`` (one key per two mask groups) and ``pivots`` (distances)."""
    fp = F.col("fp")
    random = np.random.default_rng(SEED).integers(-(2**63), 2**63, REFERENCES, dtype=np.int64)
    zero = _distance(fp, F.lit(0).cast("bigint"))
    under = []
    for j in range(_MASKS):
        mask = ((1 << _MASK_BITS) - 1) << (_MASK_BITS * j)
        mask = mask - 2**64 if mask >= 2**63 else mask
        under.append((zero - _distance(fp, F.lit(mask)) + _MASK_BITS) / 2)
    groups = max_distance + 2
    grid = []
    for chosen in combinations(range(groups), 2):
        of = [j for g in chosen for j in range(g * _MASKS // groups, (g + 1) * _MASKS // groups)]
        key = F.lit(0).cast("bigint")
        for j in of:
            key = key * (_MASK_BITS + 1) + under[j].cast("bigint")
        grid.append(F.struct(F.lit(len(grid)).alias("groups"), key.alias("key")))
    pivots = [_distance(fp, F.lit(int(r))).cast("tinyint").alias(f"p{i}") for i, r in enumerate(random)]
    return fps.select("fp", "rep", F.array(*grid).alias("grid"), *pivots)


def linked_pairs(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs of ``rep`` of fingerprints that differ in ``max_distance`` bits or fewer.

    ``fps`` holds distinct fingerprints ``fp``, each with the row ``rep`` that stands for it.
    """
    rows = pivot_table(fps, max_distance)
    keyed = rows.select("fp", "rep", F.explode("grid").alias("cell"), *(f"p{i}" for i in range(REFERENCES)))
    keyed = keyed.select("*", F.col("cell.groups").alias("g"), F.col("cell.key").alias("k")).drop("cell")
    x, y = keyed.alias("x"), keyed.alias("y")
    near = [F.abs(F.col(f"x.p{i}") - F.col(f"y.p{i}")) <= max_distance for i in range(REFERENCES)]
    same = (F.col("x.g") == F.col("y.g")) & (F.col("x.k") == F.col("y.k")) & (F.col("x.fp") < F.col("y.fp"))
    found = x.join(y, same)
    for test in near:
        found = found.where(test)
    found = found.where(_distance(F.col("x.fp"), F.col("y.fp")) <= max_distance)
    return found.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """Component of each document under links between close fingerprints.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    ``doc_id`` reachable. Columns other than ``doc_id`` and ``text`` are not read. Null and
    empty texts have fingerprint zero and link like any other; a row without id keeps its
    row, and its component is the smallest id among its links (null if none has an id).
    Repeated rows and ties give one output row each; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, shingle=shingle), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash")
    links = linked_pairs(distinct.where("rep is not null"), max_distance)
    found = components(links)
    named = distinct.join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# Similar texts. The tables of distances to references above find all texts whose fingerprints
# differ in two bits at most. But two sets of shingles that share 0.8 of their union differ in
# about 15 % of a fingerprint's bits, far more than that grid bears. So texts also get
# eight fingerprints, read as 32 coordinates of 16 bits (each is the row of distances to 16
# one-bit references), and texts that agree in one coordinate meet. Within such a cell every
# text is compared with all others; pairs found this way are verified by the shingles
# themselves. So that a group of copies does not give the square of its size in pairs, each
# text first names its closest partner and the one of smallest name, twice; then all close
# pairs whose texts are not linked yet are verified.
# Texts of few shingles may differ in more bits and meet in no coordinate, so an exact way comes
# last: of two sets that share 0.8 of their union, both have one hash in common among their
# smallest ones, a fifth of each set. Texts that share such a hash meet unless they are linked
# already; how many hashes two sets have in each of 512 ranges differs, in sum, by as many at
# most as are in one of the sets only, which rules out most pairs without a loss; the others are
# verified.
PRINTS, BAND_BITS = 8, 16
CLOSE_BITS = 64  # of the 256 of the first four fingerprints; unrelated texts differ in 128 or so
_ODD = (np.random.default_rng(SEED).integers(0, 2**63, PRINTS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
RANGE_BITS = 9  # 2 to this are the ranges of hashes
CELL_ROWS = 1024  # texts of a cell that one task holds; larger cells are split


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def fingerprint_set(hashes: np.ndarray) -> list[int]:
    out = []
    for odd in _ODD:  # every bit of a hash must tell on every bit of what is counted
        mixed = (hashes ^ (hashes >> np.uint64(33))) * odd
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _SPREAD
        out.append(fingerprint(mixed ^ (mixed >> np.uint64(32))))
    return out


def prefix(hashes: np.ndarray, min_similarity: float) -> np.ndarray:
    """The smallest hashes of a set (in ascending order): two sets that are similar share one of theirs."""
    return hashes[: len(hashes) - math.ceil(min_similarity * len(hashes) - 1e-9) + 1]


def range_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes of a set are in each range, 255 at most."""
    counts = np.bincount(((hashes * _SPREAD) >> np.uint64(64 - RANGE_BITS)).astype(np.int64), minlength=1 << RANGE_BITS)
    return np.minimum(counts, 255).astype(np.uint8)


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Names a row by its id and text; only rows that repeat both share a name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.xxhash64(F.col(id_col).cast("string"), F.xxhash64(text), F.octet_length(text))


def _signatures(size: int, min_similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            contents, prints, sizes, firsts, counts = [], [], [], [], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
                hashes = shingle_set(text.as_py() or b"", size)
                contents.append(xxhash.xxh128_digest(hashes.tobytes()))
                prints.append(fingerprint_set(hashes))
                sizes.append(len(hashes))
                firsts.append(prefix(hashes, min_similarity).view(np.int64))
                counts.append(range_counts(hashes).tobytes())
            found = [*(pa.array(v, pa.binary()) for v in (contents, counts)), *(pa.array(v, pa.list_(pa.int64())) for v in (prints, firsts)), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*batch.schema.names[:-1], "content", "counts", "prints", "prefix", "size"])

    return run


def _bits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``x`` and each of ``y``."""
    return sum(np.bitwise_count(x[:, None, i] ^ y[None, :, i]).astype(np.int16) for i in range(x.shape[1]))


class _Rows:
    """Texts of cells: names, labels, numbers of shingles, fingerprints (or counts by range)."""

    def __init__(self, uid: np.ndarray, label: np.ndarray, size: np.ndarray, prints: np.ndarray):
        self.uid, self.label, self.size, self.prints = uid, label, size, prints

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        if "counts" in batch.schema.names:
            prints = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        else:
            prints = np.stack([batch.column(f"f{i}").to_numpy() for i in range(4)], axis=1).view(np.uint64)
        return cls(batch.column("uid").to_numpy(), batch.column("label").to_numpy(), batch.column("size").to_numpy(), prints)

    def take(self, at: slice | np.ndarray) -> _Rows:
        return _Rows(self.uid[at], self.label[at], self.size[at], self.prints[at])

    @classmethod
    def joined(cls, parts: list[_Rows]) -> _Rows:
        return cls(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("uid", "label", "size", "prints")))


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _chosen(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of names, those with each text's closest partner and with its partner of smallest name."""
    x, y, apart = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([apart, apart])
    near, low = np.lexsort((y, apart, x)), np.lexsort((y, x))
    first = np.concatenate([order[np.diff(x[order], prepend=x[order][:1] - 1) != 0] for order in (near, low)])
    return x[first], y[first]


def _may_be_similar(x: _Rows, i: np.ndarray, y: _Rows, j: np.ndarray, min_similarity: float) -> np.ndarray:
    """Whether texts ``i`` of ``x`` and ``j`` of ``y`` can be similar by their counts: none that are get lost."""
    most = (x.size[i] + y.size[j]) * ((1 - min_similarity) / (1 + min_similarity)) + 1e-6
    apart = [
        np.abs(x.prints[i[at : at + 4096]].astype(np.int16) - y.prints[j[at : at + 4096]]).sum(1, dtype=np.int64) for at in range(0, len(i), 4096)
    ]
    return np.concatenate(apart) <= most if apart else np.zeros(0, bool)


def _fit(x: np.ndarray, y: np.ndarray, min_similarity: float) -> np.ndarray:
    """Whether texts with so many shingles can be similar."""
    return np.minimum(x, y) >= min_similarity * np.maximum(x, y) - 1e-6


def _light_pairs(every: bool, min_similarity: float, exact: bool = False):
    """Pairs of cells that one task holds whole; a batch's cells are compared at once, place by place."""

    def met(names: np.ndarray, rows: _Rows) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(1)]))
        counts = np.diff(starts, append=len(names))
        behind = np.repeat(starts + counts, counts) - np.arange(len(names)) - 1  # texts of the cell that follow
        a, b, bits = [], [], []
        i = np.arange(len(names))
        for d in range(1, int(counts.max())):
            i = i[behind[i] >= d]
            if exact:
                x = i[(rows.label[i] != rows.label[i + d]) & _fit(rows.size[i], rows.size[i + d], min_similarity)]
                x = x[_may_be_similar(rows, x, rows, x + d, min_similarity)]
                a.append(x)
                b.append(x + d)
                continue
            apart = np.bitwise_count(rows.prints[i] ^ rows.prints[i + d]).astype(np.int16).sum(1)
            good = (apart <= CLOSE_BITS) & (rows.label[i] != rows.label[i + d])
            x, y = i[good], i[good] + d
            fits = _fit(rows.size[x], rows.size[y], min_similarity)
            a.append(x[fits])
            b.append(y[fits])
            bits.append(apart[good][fits])
        if not sum(map(len, a)):
            return None
        x, y = np.concatenate(a), np.concatenate(b)
        if every:
            return _pairs_batch(rows.uid[x], rows.uid[y])
        apart = np.concatenate(bits)
        found = []
        cell = np.repeat(np.arange(len(starts)), counts)[x]
        order = np.argsort(cell, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(cell[order])) + 1), len(order)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            one = order[s:e]
            found.append(_chosen(rows.uid[x[one]], rows.uid[y[one]], apart[one]))
        return _pairs_batch(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new, own = np.stack([batch.column("band").to_numpy(), batch.column("cell").to_numpy()], axis=1), _Rows.of(batch)
            names, rows = (new, own) if names is None else (np.concatenate([names, new]), _Rows.joined([rows, own]))
            last = len(names) - int((names == names[-1]).all(1)[::-1].argmin() or len(names))  # the last cell may go on
            if last and (out := met(names[:last], rows.take(slice(last)))):
                yield out
            names, rows = names[last:], rows.take(slice(last, None))
        if names is not None and (out := met(names, rows)):
            yield out

    return run


def _heavy_pairs(every: bool, min_similarity: float, exact: bool = False):
    """Pairs of large cells: the stored texts of each part are met by all texts of the cell, in order of their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, store, near, close, low = None, [], None, None, None, None

        def chosen() -> pa.RecordBatch | None:
            if every or store is None:
                return None
            has = close <= CLOSE_BITS
            return _pairs_batch(np.concatenate([store.uid[has]] * 2), np.concatenate([near[has], low[has]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "cell", "part", "role")], axis=1)
            rows = _Rows.of(batch)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1), len(names)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if tuple(names[s][:3]) != key:
                    if out := chosen():
                        yield out
                    key, kept, store = tuple(names[s][:3]), [], None
                if names[s][3] == 0:
                    kept.append(rows.take(slice(s, e)))
                    continue
                if not kept:  # no text fell to this part
                    continue
                if store is None:
                    store = _Rows.joined(kept)
                    near, low = np.zeros(len(store.uid), np.int64), np.zeros(len(store.uid), np.int64)
                    close = np.full(len(store.uid), 999, np.int16)
                for at in range(s, e, 512):
                    x = rows.take(slice(at, min(at + 512, e)))
                    may = (x.label[:, None] != store.label) & _fit(x.size[:, None], store.size[None], min_similarity)
                    if exact:
                        i, j = np.nonzero(may & (x.uid[:, None] < store.uid))
                        fits = _may_be_similar(x, i, store, j, min_similarity)
                        if fits.any():
                            yield _pairs_batch(x.uid[i[fits]], store.uid[j[fits]])
                        continue
                    apart = _bits(x.prints, store.prints)
                    apart[~may] = 999
                    good = apart <= CLOSE_BITS
                    if every:
                        i, j = np.nonzero(good & (x.uid[:, None] < store.uid))
                        if len(i):
                            yield _pairs_batch(x.uid[i], store.uid[j])
                        continue
                    first, least = good.argmax(0), apart.argmin(0)
                    here = np.arange(len(store.uid))
                    new = good[first, here] & (close > CLOSE_BITS)
                    low[new] = x.uid[first[new]]
                    better = good[least, here] & (apart[least, here] < close)
                    near[better] = x.uid[least[better]]
                    close[better] = apart[least, here][better]
        if out := chosen():
            yield out

    return run


def _pairs(cells: DataFrame, every: bool, min_similarity: float, exact: bool = False) -> DataFrame:
    """Pairs (``a`` > ``b``) of close texts of a cell that differ in ``label``.

    All texts of a cell are compared. With ``every`` all pairs come, else two for each text
    and cell. If ``exact``, all pairs come that can be similar by the texts' ``counts``. Cells beyond ``CELL_ROWS`` texts are split: each part is met by the whole cell.
    """
    heavy = cells.groupBy("band", "cell").count().where(F.col("count") > CELL_ROWS)
    heavy = stored(heavy.select("band", "cell", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("parts")), "similar")
    light = cells if (none := heavy.isEmpty()) else cells.join(heavy, ["band", "cell"], "left_anti")
    light = light.repartition("band", "cell").sortWithinPartitions("band", "cell", "uid")
    found = light.mapInArrow(_light_pairs(every, min_similarity, exact), "a bigint, b bigint")
    if not none:
        many = cells.join(heavy, ["band", "cell"])
        store = many.withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts").cast("bigint")).cast("int")).withColumn("role", F.lit(0))
        stream = many.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("role", F.lit(1))
        met = store.unionByName(stream).drop("parts").repartition("band", "cell", "part").sortWithinPartitions("band", "cell", "part", "role", "uid")
        found = found.union(met.mapInArrow(_heavy_pairs(every, min_similarity, exact), "a bigint, b bigint"))
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _pivot_pairs(distinct: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs (``a`` > ``b``) of texts that the tables of distances to references find for the first fingerprint.

    All pairs of fingerprints ``max_distance`` bits apart or fewer are found; the text of smallest
    name stands for a fingerprint and is paired with the others that have it.
    """
    named = distinct.select("rep", F.col("prints")[0].alias("fp"))
    prints = stored(named.groupBy("fp").agg(F.min("rep").alias("rep")), "similar")
    same = named.join(prints.withColumnRenamed("rep", "b"), "fp").where("rep <> b").select(F.col("rep").alias("a"), "b")
    found = linked_pairs(prints, max_distance).union(same)
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _prefix_pairs(distinct: DataFrame, found: DataFrame, min_similarity: float) -> DataFrame:
    """Pairs (``a`` > ``b``) of texts that share a hash of their prefixes, may be similar and are not linked by ``found`` yet.

    Hashes of one text only, or of linked texts only, are dropped where they meet; what else is
    needed of a text is joined to the few that stay.
    """
    own = distinct.join(found, F.col("rep") == F.col("node"), "left")
    own = stored(own.select(F.col("rep").alias("uid"), F.coalesce("component", "rep").alias("label"), "prefix", "counts", "size"), "similar")
    met, of = own.select(F.explode("prefix").alias("cell"), "uid", "label"), Window.partitionBy("cell")
    met = met.withColumns({"low": F.min("label").over(of), "high": F.max("label").over(of)}).where("low <> high").select("cell", "uid")
    cells = stored(met, "similar").join(own.drop("prefix"), "uid").withColumn("band", F.lit(0))
    return _pairs(cells, True, min_similarity, True)


def _verified(min_similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= min_similarity * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


#: Names of rows (8 bytes each) that may go to all tasks, so that texts need not be shuffled.
BROADCAST_ROWS = 1_000_000


def _matched(rows: DataFrame, names: DataFrame, on: str, how: str) -> DataFrame:
    """Semi or anti join of texts with a stored table of names; the names are broadcast if they are few."""
    return rows.join(F.broadcast(names) if names.count() <= BROADCAST_ROWS else names, on, how)


def similar_groups(docs: DataFrame, shingle: int = 5, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

    Returns for each row ``uid`` (its name), ``doc_id`` and ``group`` (texts of equal content
    or linked, directly or in steps, share it). Every link is verified, and every pair at 0.8 or
    more is verified or linked in steps: most of them by the cells of the fingerprints, all
    others by a hash that both have among their smallest ones. Texts without a word are equal.
    """
    named = docs.select(_row_key(docs, id_col, text_col).alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = stored(named.mapInArrow(_signatures(shingle, min_similarity), f"uid bigint, doc_id {kind}, content binary, counts binary, prints array<bigint>, prefix array<bigint>, size int"), "similar")
    distinct = rows.groupBy("content").agg(F.min("uid").alias("rep"), *(F.first(c).alias(c) for c in ("prints", "prefix", "counts", "size")))
    distinct = stored(distinct, "similar")
    per = 64 // BAND_BITS
    cell = [
        F.struct(F.lit(n).alias("band"), F.shiftrightunsigned(F.col("prints")[n // per], BAND_BITS * (n % per)).bitwiseAND((1 << BAND_BITS) - 1).alias("cell"))
        for n in range(PRINTS * per)
    ]
    near = [f"f{i}" for i in range(4)]
    pivoted = _pivot_pairs(distinct)
    met = distinct.select(F.col("rep").alias("uid"), F.col("rep").alias("label"), "size", *(F.col("prints")[i].alias(n) for i, n in enumerate(near)), F.explode(F.array(*cell)).alias("x"))
    met = met.select("x.band", "x.cell", "uid", "label", "size", *near)
    pairs = stored(pivoted.union(_pairs(met, False, min_similarity)).distinct(), "similar")

    # Texts that are close to none in any of their cells are in no pair and need not be looked at again.
    wanted = stored(pairs.select(F.col("a").alias("uid")).union(pairs.select(F.col("b").alias("uid"))).distinct(), "similar")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [shingle_set(t.as_py() or b"", shingle).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["uid", "set"])

    def held_of(wanted: DataFrame) -> DataFrame:
        return stored(_matched(named.select("uid", "t"), wanted, "uid", "left_semi").mapInArrow(sets, "uid bigint, set binary").dropDuplicates(["uid"]), "similar")

    def links(pairs: DataFrame, held: DataFrame) -> DataFrame:
        both = pairs.join(held.select(F.col("uid").alias("a"), F.col("set").alias("x")), "a")
        both = both.join(held.select(F.col("uid").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")
        return stored(both.mapInArrow(_verified(min_similarity), "a bigint, b bigint"), "similar")

    held = held_of(wanted)
    linked = links(pairs, held)
    found = stored(components(linked), "similar")
    met = stored(_matched(met, wanted, "uid", "left_semi"), "similar")
    for every in (False, True):
        label = F.coalesce("component", "uid").alias("label")
        now = met.drop("label").join(found, F.col("uid") == F.col("node"), "left").select("band", "cell", "uid", label, "size", *near)
        more = stored(_pairs(now, every, min_similarity).join(pairs, ["a", "b"], "left_anti"), "similar")
        pairs, linked = pairs.union(more), linked.union(links(more, held))
        found = stored(components(linked), "similar")
    more = stored(_prefix_pairs(distinct, found, min_similarity).join(pairs, ["a", "b"], "left_anti"), "similar")
    wanted = stored(more.select(F.col("a").alias("uid")).union(more.select(F.col("b").alias("uid"))).distinct(), "similar")
    linked = linked.union(links(more, held_of(wanted)))
    found = stored(components(linked), "similar")
    group = distinct.select("content", "rep").join(found, F.col("rep") == F.col("node"), "left")
    group = group.select("content", F.coalesce("component", "rep").alias("group"))
    return rows.select("uid", "doc_id", "content").join(group, "content").select("uid", "doc_id", "group")


def without_near_duplicates(docs: DataFrame, shingle: int = 5, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of similar texts: the one of smallest id (null ids come last).

    All columns stay as they are. Of rows that repeat id and text one stays.
    """
    groups = stored(similar_groups(docs, shingle, min_similarity, id_col, text_col), "similar")
    best = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("k")).select(F.col("k.uid").alias("__uid"))
    repeated = groups.groupBy("uid").count().where("count > 1").select(F.col("uid").alias("__uid"))
    gone = groups.select(F.col("uid").alias("__uid")).distinct().join(best, "__uid", "left_anti")
    kept = _matched(docs.withColumn("__uid", _row_key(docs, id_col, text_col)), stored(gone, "similar"), "__uid", "left_anti")
    if repeated.isEmpty():
        return kept.drop("__uid")
    once = kept.join(repeated, "__uid", "left_semi").dropDuplicates(["__uid"])
    return kept.join(repeated, "__uid", "left_anti").unionByName(once).drop("__uid")
