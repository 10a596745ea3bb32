"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping segments, so that a passage of 75 characters or more
(about 13 words) taken from an item holds one of them in full, as does a whole item. Of a segment's q-grams each edit spoils q at most; an occurrence within
the edit budget k therefore shares at least (number of q-grams - k q) of them, on diagonals
(place in the document minus place in the segment) that lie within 2 k of each other. The
shared q-grams are counted in overlapping diagonal bands, bands that reach the bound are
retained, and retained regions are verified by banded alignment.

Documents are searched where they lie, a batch of texts at a time; the index of a block of
items goes to all tasks. A block is bounded by ``block_chars`` characters of benchmark text;
larger benchmarks are searched block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from callmeter.llm.common import sliced, union_all

Q = 8
#: Characters of a segment and between their beginnings.
SEGMENT, STRIDE = 60, 16
EDIT_RATE = 0.1
BLOCK_CHARS = 4_000_000
_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are searched at a time, and places that are looked up at a time.
_SLAB = 4_000_000
_PLACES = 1 << 16


def plain(text: bytes) -> bytes:
    """A-Z in lower case, runs of white space as one blank."""
    return b" ".join(text.replace(b"\0", b" ").lower().split())


@dataclass
class Index:
    """Segments of a block of items and where their q-grams stand."""

    items: np.ndarray
    segments: list[bytes]
    offsets: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    posted: np.ndarray

    @property
    def reach(self) -> int:
        return max((len(s) + int(k) for s, k in zip(self.segments, self.budget, strict=True)), default=0)


def _grams(text: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one number."""
    return np.ndarray((max(len(text) - Q + 1, 0),), "<u8", text, strides=(1,))


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)


def build_index(items: list[tuple[int, bytes]], segment: int = SEGMENT, rate: float = EDIT_RATE, stride: int = STRIDE) -> Index:
    """Index of items (id, normalised text); those shorter than a q-gram hold nothing to search for."""
    owner, segments, offsets = [], [], []
    for item, text in items:
        last = max(len(text) - segment, 0)
        for at in sorted({*range(0, last, stride), last}):
            if len(text) >= Q:
                owner.append(item)
                segments.append(text[at : at + segment])
                offsets.append(at)
    sizes = np.array([len(s) - Q + 1 for s in segments], np.int64)
    length = sizes + Q - 1
    budget = np.minimum((length * rate).astype(np.int64), np.maximum(sizes - 1, 0) // Q)
    codes = [_grams(np.frombuffer(s, np.uint8)).copy() for s in segments]
    flat = np.concatenate(codes) if codes else np.empty(0, np.uint64)
    who = np.repeat(np.arange(len(segments)), sizes)
    where = np.concatenate([np.arange(n) for n in sizes]) if codes else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    posted = np.stack([who[order], where[order]], axis=1) if codes else np.empty((0, 2), np.int64)
    return Index(np.array(owner, np.int64), segments, np.array(offsets, np.int64), budget, sizes - budget * Q, grams, np.append(first, len(flat)), posted)


def _met(codes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Places whose q-gram may be one of the index; a part at a time, as slots take many times the text's bytes."""
    parts = [np.flatnonzero(seen[_slot(codes[at : at + _PLACES])]) + at for at in range(0, len(codes), _PLACES)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _dense(places: np.ndarray, reach: int, bound: int) -> np.ndarray:
    """Places that have ``bound`` places at least within ``reach``, themselves included."""
    return places[np.searchsorted(places, places + reach, "right") - np.searchsorted(places, places - reach) >= bound]


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array and how often each occurs."""
    cuts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    return ordered[cuts], np.diff(cuts, append=len(ordered))


def candidates(text: np.ndarray, index: Index, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment and first diagonal of each band (4 k + 1 wide) that shares enough q-grams."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    codes = _grams(text)
    least = int(index.bound.min())
    places = _met(codes, seen)
    places = _dense(places, index.reach, least)
    at = np.minimum(np.searchsorted(index.grams, codes[places]), len(index.grams) - 1)
    real = index.grams[at] == codes[places]
    places, at = places[real], at[real]
    kept = np.isin(places, _dense(places, index.reach, least), assume_unique=True)
    places, at = places[kept], at[kept]
    if not len(places):
        return none
    counts = index.first[at + 1] - index.first[at]
    row = np.repeat(index.first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    who, where = index.posted[row].T
    diagonal = np.repeat(places, counts) - where + index.reach  # never negative
    half = 2 * index.budget[who] + 1
    found = []
    for shift in (0, 1):  # bands of either kind overlap by half
        band = (diagonal + shift * half) // (2 * half)
        cell = band * len(index.segments) + who
        hit, shared = _runs(np.sort(cell))
        hit = hit[shared >= index.bound[hit % len(index.segments)]]
        if len(hit):  # now let one q-gram of the segment count once for each band
            at = np.minimum(np.searchsorted(hit, cell), len(hit) - 1)
            mine = hit[at] == cell
            once, _ = _runs(np.sort(cell[mine] * (SEGMENT * 8) + where[mine]))
            hit, shared = _runs(once // (SEGMENT * 8))
            hit = hit[shared >= index.bound[hit % len(index.segments)]]
        s, b = hit % len(index.segments), hit // len(index.segments)
        found.append((s, b * 2 * (2 * index.budget[s] + 1) - shift * (2 * index.budget[s] + 1) - index.reach))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def align(text: np.ndarray, index: Index, who: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each segment against any stretch of text within its band, and where that ends.

    Diagonals ``low - k`` to ``low + 5 k + 2`` are followed, row by row of the segment, for
    all candidates at once. Places outside the text never match. Edits never fall from a row to
    the next, so a candidate whose band is above its budget everywhere is left there, with one
    edit too many.
    """
    lengths = index.bound + index.budget * Q + Q - 1
    edits, ends = index.budget[who] + 1, np.zeros(len(who), np.int64)
    pad = 4 * index.reach + 8
    padded = np.concatenate([np.zeros(pad, np.uint8), text, np.zeros(pad, np.uint8)])
    for n, k in np.unique(np.stack([lengths[who], index.budget[who]], axis=1), axis=0).tolist():
        mine = np.flatnonzero((lengths[who] == n) & (index.budget[who] == k))
        width = 6 * k + 3
        step = np.arange(width, dtype=np.int16)
        windows = np.lib.stride_tricks.sliding_window_view(padded, width)
        patterns = {s: np.frombuffer(index.segments[s], np.uint8) for s in np.unique(who[mine]).tolist()}
        for at in range(0, len(mine), 4096):
            part = mine[at : at + 4096]
            pattern = np.stack([patterns[s] for s in who[part].tolist()])
            base = np.clip(low[part] - k, -pad, len(text)) + pad
            cost = np.zeros((len(part), width), np.int16)
            for i in range(n):
                new = cost + (windows[base + i] != pattern[:, i, None])
                np.minimum(new[:, :-1], cost[:, 1:] + 1, out=new[:, :-1])
                new -= step
                np.minimum.accumulate(new, axis=1, out=new)
                new += step
                cost = new
                if i % 8 == 7 and i < n - 1:
                    alive = cost.min(1) <= k
                    if not alive.all():
                        part, pattern, base, cost = part[alive], pattern[alive], base[alive], cost[alive]
                        if not len(part):
                            break
            if len(part):
                best = cost.argmin(1)
                edits[part] = cost[np.arange(len(part)), best]
                ends[part] = base - pad + n + best
    return edits, ends


def search(texts: list[bytes], index: Index, seen: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, edits, start) of the best stretch for each item found in each text; texts are plain."""
    if not len(index.segments):
        return
    gap = b"\0" * Q
    at = 0
    while at < len(texts):
        size, some = 0, []
        while at < len(texts) and (not some or size + len(texts[at]) <= _SLAB):
            some.append(texts[at])
            size += len(texts[at]) + Q
            at += 1
        text = np.frombuffer(gap.join([b"", *some, b""]), np.uint8)
        starts = np.cumsum([Q, *(len(t) + Q for t in some)])
        who, low = candidates(text, index, seen)
        if not len(who):
            continue
        edits, ends = align(text, index, who, low)
        good = edits <= index.budget[who]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for s, e, end in zip(who[good], edits[good], ends[good], strict=True):
            start = int(end) - len(index.segments[s])
            doc = int(np.searchsorted(starts, max(start + len(index.segments[s]) // 2, Q), "right")) - 1
            key = at - len(some) + doc, int(index.items[s])
            best[key] = min(best.get(key, (1 << 60, 0)), (int(e), max(start - int(starts[doc]), 0)))
        for (doc, item), (e, start) in sorted(best.items()):
            yield doc, item, e, start


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, rate: float, block_chars: int) -> Iterator[tuple[Index, list[int | None]]]:
    """Index of each block; its items are places in the list of ids that comes with it."""
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    total = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = -(-total // block_chars)
    # All texts of an item are in one block; a text without an id is an item of its own.
    name = F.when(F.col("i").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("i"))
    for b in range(n):
        block: list[Row] = rows.where(F.pmod(name, F.lit(n)) == b).collect()
        items = sorted({(r.i is None, r.i or 0, r.t if r.i is None else "") for r in block})
        place = {item: n for n, item in enumerate(items)}
        texts = [(place[r.i is None, r.i or 0, r.t if r.i is None else ""], plain(r.t.encode())) for r in block]
        yield build_index(sorted(texts), rate=rate), [None if none else i for none, i, _ in items]


def _shared(docs: DataFrame, index: Index):
    seen = np.zeros(1 << _BITS, bool)
    seen[_slot(index.grams)] = True
    return docs.sparkSession.sparkContext.broadcast((index, seen))


def _plain_texts(column: pa.Array) -> list[bytes]:
    return [plain(t.as_py() or b"") for t in column.cast(pa.binary())]


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Benchmark items found in documents: ``doc_id``, ``item_id``, ``edits`` and ``start``.

    One row per document row and item (``item_id`` of ``benchmark``): the fewest edits of any
    of the item's segments, at most ``rate`` of its length, and where it starts in the
    normalised text (a smaller ``start`` wins ties). Null and empty texts and items match
    nothing, nor do items of under eight characters; repeated document rows are reported
    each, repeated items once; items without an id are items of their own. Lengths, edits
    and places are in bytes. Columns besides those named are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {kind}, item_id bigint, edits int, start int"
    found = []
    for index, ids in _blocks(benchmark, "item_id", "text", rate, block_chars):
        shared = _shared(docs, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, ids=ids) -> Iterator[pa.RecordBatch]:
            index, seen = shared.value
            for batch in sliced(batches):
                hits = list(search(_plain_texts(batch.column(1)), index, seen))
                where = pa.array([h[0] for h in hits], pa.int64())
                columns = [pa.array([ids[h[1]] for h in hits], pa.int64()), *(pa.array([h[c] for h in hits], pa.int32()) for c in (2, 3))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(where), *columns], ["doc_id", "item_id", "edits", "start"])

        found.append(rows.mapInArrow(run, schema))
    return union_all(found) if found else docs.sparkSession.createDataFrame([], schema)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no benchmark item, all their columns unchanged; rows stay where they lie."""
    place = docs.columns.index(text_col)
    out = docs
    for index, _ in _blocks(benchmark, "item_id", "text", rate, block_chars):
        shared = _shared(docs, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, seen = shared.value
            for batch in sliced(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[[h[0] for h in search(_plain_texts(batch.column(place)), index, seen)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
