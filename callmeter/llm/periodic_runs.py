"""Runs of words that repeat with a period, found by minimizers at several scales.

Periods up to ``SHORT`` are found by comparing every word with the one ``q`` places on. Longer
ones are found by scale: at scale K, for periods above K / 2 and up to K, every place has the hash
of the K words from it, and the smallest hash of each window of K / 2 places marks its place.

Inside a run of period q, windows q places apart hold the same hashes, so marks repeat q places
apart; and since K >= q and q is the smallest period, the hashes at the q places of one period
all differ, so the next equal mark is exactly q places on. A run of four periods leaves room for
such a pair: its 4q - K + 1 places hold a window of K / 2 and another q places on. Each pair of
successive equal marks at a distance that belongs to the scale is compared word by word and
extended both ways, so nothing false is reported; a hash that happens to equal another (64 bits)
could at worst hide one seed among several of a run.

All is done on arrays over portions of texts; a document stays within its row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import column
from callmeter.llm.words import Words, mixed, portions, split_words

#: Longest period that is looked for by comparing at its distance.
SHORT = 8
#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of texts handled at once.
PORTION = 4 << 20

Run = tuple[int, int, int]


def _primitive(codes: np.ndarray, start: int, q: int) -> bool:
    """Whether no divisor of ``q`` is a period of the run too.

    A smaller period of a stretch of four periods would have a common divisor with q that is
    a period as well, so divisors suffice, and one period beside the next shows it.
    """
    return not any(
        q % d == 0 and np.array_equal(codes[start : start + q], codes[start + d : start + d + q]) for d in range(1, q // 2 + 1)
    )


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ``same`` holds for ``least`` places or more, as starts and ends."""
    step = np.diff(same.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - start >= least
    return start[long], end[long]


def _least(q: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * q)


def _short(codes: np.ndarray, text: np.ndarray) -> Iterator[Run]:
    for q in range(1, min(SHORT, len(codes) - 1) + 1):
        same = (codes[q:] == codes[:-q]) & (text[q:] == text[:-q])
        for start, end in zip(*_stretches(same, _least(q) - q), strict=True):
            if _primitive(codes, start, q):
                yield int(start), int(end - start + q), q


def _agree(codes: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``at``, within [low, high), whose words equal those ``q`` places on."""
    end, step = at, 64
    while end + q < high:
        n = min(step, high - q - end)
        if len(other := np.flatnonzero(codes[end : end + n] != codes[end + q : end + q + n])):
            end += int(other[0])
            break
        end, step = end + n, 2 * step
    start, step = at, 64
    while start > low:
        n = min(step, start - low)
        if len(other := np.flatnonzero(codes[start - n : start] != codes[start - n + q : start + q])):
            start = start - n + int(other[-1]) + 1
            break
        start, step = start - n, 2 * step
    return start, end


def _marks(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some window of that many places (a power of two)."""
    low, w = hashes, 1
    while w < window and w < len(low):
        nxt = low.copy()
        np.minimum(low[:-w], low[w:], out=nxt[:-w])
        low, w = nxt, 2 * w
    high, w = low, 1
    while w < window and w < len(high):
        nxt = high.copy()
        np.maximum(high[w:], high[:-w], out=nxt[w:])
        high, w = nxt, 2 * w
    return high == hashes


def _seeds(hashes: np.ndarray, valid: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of marks whose next equal mark is at a distance of this scale, and the distances."""
    at = np.flatnonzero(_marks(hashes, scale // 2) & valid)
    at = at[np.argsort(hashes[at], kind="stable")]
    gap = at[1:] - at[:-1]
    fits = (hashes[at[1:]] == hashes[at[:-1]]) & (gap > scale // 2) & (gap <= scale)
    return at[:-1][fits], gap[fits]


def _long(codes: np.ndarray, text: np.ndarray) -> Iterator[Run]:
    size = np.bincount(text) if len(text) else np.zeros(0, np.int64)
    place = np.arange(len(codes))  # of what is still looked at, among all words
    stop = np.cumsum(size)[text] if len(text) else place  # where each word's text ends
    begin = stop - size[text] if len(text) else place
    hashes, width, scale = mixed(codes.astype(np.uint64) + np.uint64(1)), 1, 2 * SHORT
    while True:
        # Texts with room for the least run of this scale; whole texts stay or go, so neighbours stay neighbours.
        room = (stop - begin)[place] >= LEAST_PERIODS * (scale // 2 + 1)
        place, hashes = place[room], hashes[room]
        if not len(place):
            return
        while width < scale:
            onward = np.zeros_like(hashes)
            onward[:-width] = hashes[width:]
            hashes = mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + (onward ^ np.uint64(width)))
            width *= 2
        valid = place + scale <= stop[place]
        ranked = np.where(valid, hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
        at, gaps = _seeds(ranked, valid, scale)
        for q in np.unique(gaps).tolist():
            done = -1
            for p in np.sort(place[at[gaps == q]]).tolist():
                if p < done:
                    continue
                start, end = _agree(codes, p, q, int(begin[p]), int(stop[p]))
                done = max(end, p + 1)
                if end - start + q >= _least(q) and _primitive(codes, start, q):
                    yield start, end - start + q, q
        scale *= 2


def find_runs(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Start, length and period of every run; words of different texts never meet.

    ``codes`` are the words of texts one after the other, ``text`` (not decreasing) says whose
    each is. Ordered by start, then period.
    """
    found = [*_short(codes, text), *_long(codes, text)]
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: Words, kept: np.ndarray, texts: int) -> pa.Array:
    """Kept words of each text joined by one space."""
    start, end, text = words.start[kept], words.end[kept], words.text[kept]
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    take = np.zeros(len(words.data) + 1, np.int8)
    take[start] += 1
    # A word that is not its text's last brings one more byte along, which becomes a space.
    np.add.at(take, end + ~last, -1)
    taken = np.cumsum(take[:-1], dtype=np.int8).view(bool)
    letters = words.data.copy()
    letters[end[~last]] = ord(" ")
    sizes = np.bincount(text, end - start + ~last, texts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    joined = pa.LargeStringArray.from_buffers(texts, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters[taken])))
    return joined.cast(pa.string())


def _portion_runs(texts: list[bytes]) -> list[pa.Array]:
    words = split_words(texts)
    runs = find_runs(words.codes, words.text)
    inside = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(inside[:-1]) == 0
    counts = np.bincount(words.text, minlength=len(texts))
    first = np.cumsum(counts) - counts
    of = words.text[runs[:, 0]]
    fields = [runs[:, 0] - first[of], runs[:, 1], runs[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "length", "period"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]).astype(np.int32)
    return [pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), structs), _collapsed(words, kept, len(texts))]


def _per_batch(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            texts = (batch.column("text")[i].as_buffer() for i in range(batch.num_rows))
            for some in portions((b.to_pybytes() if b is not None else b"" for b in texts), most):
                columns = _portion_runs(some)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(some)), *columns], ["id", "n_words", "runs", "collapsed"])
                at += len(some)

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", portion: int = PORTION) -> DataFrame:
    """All runs of each text, and the text with each run cut to its first period.

    Words are what stands between blanks (space, tab, line separators), compared as they are and
    numbered from 0. A run is a stretch of 6 words and 4 periods or more that no neighbouring word
    extends; its period is its smallest. A word that follows the first period of any run goes.

    Returns ``id`` (the column named), ``n_words``, ``runs`` (start, length, period; by start,
    then period) and ``collapsed`` (kept words joined by one space). Each input row gives one
    row, whatever its id: ids may be null or repeat. A text that is null, empty or blank has no
    words, no runs and an empty ``collapsed``. Other columns are not read. A text is handled
    whole, in a few arrays of its number of words.
    """
    rows = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(_per_batch(portion), kind)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of which one in ten repeats from a place on, by a rule of its id alone.

    With h the CRC-32 of the id's decimal text and g = h div 10, the n words of a text whose h
    ends in 0 become, from word a = g mod n on, copies of the words a to a + p - 1 in turn, where
    p = 1 + (n - a) div (3 + g mod 8). Such texts come out joined by one space; all others, and
    texts without words or id, stay. Returns ``id`` and ``text``.
    """
    h = F.crc32(F.col("id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    rows = rows.withColumn("w", F.when(h % 10 == 0, words)).withColumn("g", F.floor(h / 10)).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    turned = F.transform(
        "w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    )
    return rows.select("id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))
