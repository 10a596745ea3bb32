"""Language of texts and of spans within them.

Words are runs of letters. Each word's score for a language is the sum of the logarithms of
the shares that its letter trigrams (word ends count as a sign) have in that language's
training text. Scripts narrow the candidates: a language competes for a word only if a part
of its own training letters is in the word's script. Viterbi over the words, with a penalty
for changing the language, labels spans; the language with the most letters is the text's.

Training sums trigram counts per language over all training rows (tables of a fixed size,
merged before they are shuffled); prediction reads each text where it lies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import sliced

BUCKET_BITS = 15
SWITCH = 8.0
SCRIPT_SHARE = 0.01
_POINTS = 0x30000
#: Letters of text that are scored at a time.
_SLAB = 2_000_000

# First code points of script ranges, and the scripts that begin there.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its small letter (0 if it is no letter) and its script's number."""
    folded = np.zeros(_POINTS, np.uint32)
    for p in range(min(_POINTS, sys.maxunicode)):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            folded[p] = ord(low) if len(low) == 1 and ord(low) < _POINTS else p
    starts = np.array([s for s, _ in SCRIPTS])
    numbers = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.int8)
    return folded, numbers[np.searchsorted(starts, np.arange(_POINTS), "right") - 1]


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of the texts, one 0 around each, and the text each place belongs to."""
    joined = "\0".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    x = _characters()[0][np.where(points < _POINTS, points, 0)]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    return x, np.concatenate([[0], owner])[: len(x)] if len(texts) else np.zeros(len(x), np.int64)


def _trigrams(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each place; a word's ends are zeros."""
    code = x[at - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    code = (code ^ x[at]) * np.uint64(0xC2B2AE3D27D4EB4F)
    code = (code ^ (code >> np.uint64(31)) ^ x[at + 1]) * np.uint64(0x165667B19E3779F9)
    return (code >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _slabs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(texts):
        some, size, start = [], 0, at
        while at < len(texts) and (not some or size + len(texts[at] or "") <= _SLAB):
            some.append(texts[at] or "")
            size += len(some[-1])
            at += 1
        yield start, some


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # buckets x languages, logarithms
    scripts: np.ndarray  # scripts x languages, whether the language is written in it


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts trigrams and scripts by language over all rows with a language and a text."""
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("lang is not null and text is not null")
    width = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, some in _slabs(texts):
                x, owner = _letters(some)
                at = np.flatnonzero(x)
                names = langs[start : start + len(some)]
                known = sorted(set(names))
                code = np.array([known.index(n) for n in names])[owner[at]]
                grams = np.bincount(code * width + _trigrams(x, at), minlength=len(known) * width).reshape(-1, width)
                script = _characters()[1][x[at]]
                kinds = np.bincount(code * len(SCRIPT_NAMES) + script, minlength=len(known) * len(SCRIPT_NAMES)).reshape(len(known), -1)
                for n, name in enumerate(known):
                    both = np.concatenate([grams[n], kinds[n]])
                    sums[name] = sums[name] + both if name in sums else both
                if len(sums) > 256:
                    yield from _parts(sums)
                    sums = {}
        yield from _parts(sums)

    parts = rows.mapInArrow(run, "lang string, part int, counts array<bigint>")
    # Parts of a table are added up element by element; each is at most 4,096 long.
    one = parts.select("lang", "part", F.posexplode("counts").alias("i", "n")).where("n > 0")
    summed = one.groupBy("lang", F.expr(f"part * {_PART} + i").alias("i")).agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # bounded: languages times buckets
    languages = tuple(sorted(found["lang"].unique()))
    table = np.zeros((len(languages), width + len(SCRIPT_NAMES)))
    table[found["lang"].map({n: k for k, n in enumerate(languages)}).to_numpy(int), found["i"].to_numpy(int)] = found["n"]
    grams, kinds = table[:, :width], table[:, width:]
    scores = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * width))
    shares = kinds / np.maximum(kinds.sum(1, keepdims=True), 1)
    return Model(languages, scores.T.astype(np.float32), (shares >= SCRIPT_SHARE).T)


_PART = 4096


def _parts(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, counts in sums.items():
        cuts = range(0, len(counts), _PART)
        lists = pa.array([counts[c : c + _PART] for c in cuts], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(lists)), pa.array(range(len(lists)), pa.int32()), lists], ["lang", "part", "counts"]
        )


def _viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """Language of each word. ``first`` and ``count``: the words of each text; all texts step together."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    labels = np.zeros(len(scores), np.int16)
    came = np.zeros(scores.shape, bool)  # whether the best way to this label changed language here
    best_before = np.zeros(len(scores), np.int16)
    value = np.zeros((len(first), scores.shape[1]), np.float64)
    steps = int(count[0]) if len(count) else 0
    alive = np.searchsorted(-count, -np.arange(steps), "left")  # texts with more than i words
    for i in range(steps):
        n = alive[i]
        word = first[:n] + i
        v = value[:n]
        if i:
            top = v.argmax(1)
            jump = v[np.arange(n), top][:, None] - switch
            came[word] = jump > v
            best_before[word] = top
            np.maximum(v, jump, out=v)
        v += scores[word]
    last = first + count - 1
    labels[last] = value.argmax(1)
    for i in range(steps - 1, 0, -1):
        word = first[: alive[i]] + i
        now = labels[word]
        labels[word - 1] = np.where(came[word, now], best_before[word], now)
    return labels


def label_words(texts: list[str], model: Model, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the texts: the text it is in, its letters, its language, its place in the text."""
    x, owner = _letters(texts)
    at = np.flatnonzero(x)
    if not len(at) or not model.languages:
        return (np.empty(0, np.int64),) * 4
    begins = np.flatnonzero(x[at - 1] == 0)
    letters = np.diff(np.append(begins, len(at)))
    scores = np.add.reduceat(model.scores[_trigrams(x, at)], begins, axis=0, dtype=np.float64)
    allowed = model.scripts[_characters()[1][x[at[begins]]]]
    allowed = allowed | ~allowed.any(1)[:, None]  # a script that no language has seen narrows nothing
    scores = np.where(allowed, scores, -1e6)
    text = owner[at[begins]]
    holders, first, count = np.unique(text, return_index=True, return_counts=True)
    return text, letters, _viterbi(scores, first, count, switch), at[begins]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), switch: float = SWITCH) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``lang_pred``, ``score`` and ``spans``.

    ``lang_pred`` is the language of most letters (the first in order on ties), ``und`` for a
    text that is null or has no letter (or if nothing was learned); ``score`` its share of the
    letters, 0 for ``und``. ``spans`` lists runs of words of one language: first word, number
    of words, language. Only the text is used. Each row, repeated or not, gives one row.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (id_col, *keep)}
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("__text"))
    names = np.array([*model.languages, "und"], object)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            langs, shares, spans = [], [], []
            for _, some in _slabs(texts):
                text, letters, label, _ = label_words(some, model, switch)
                width = max(len(model.languages), 1)
                sums = np.bincount(text * width + label, letters, len(some) * width).reshape(len(some), width)
                total = sums.sum(1)
                langs.append(np.where(total > 0, names[sums.argmax(1)], "und"))
                shares.append(sums.max(1) / np.maximum(total, 1))
                starts = np.searchsorted(text, np.arange(len(some) + 1))
                turn = np.flatnonzero(np.diff(label, prepend=-1) | np.diff(text, prepend=-1)) if len(text) else np.empty(0, np.int64)
                run_text = text[turn]
                length = np.diff(np.append(turn, len(text)))
                cuts = np.searchsorted(run_text, np.arange(len(some) + 1))
                flat = pa.StructArray.from_arrays(
                    [pa.array(turn - starts[run_text], pa.int32()), pa.array(length, pa.int32()), pa.array(names[label[turn]] if len(turn) else [], pa.string())],
                    ["first_word", "n_words", "lang"],
                )
                spans.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat))
            if texts:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(np.concatenate(langs), pa.string()), pa.array(np.concatenate(shares)), pa.concat_arrays(spans)],
                    [*batch.schema.names[:-1], "lang_pred", "score", "spans"],
                )

    kept = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return rows.mapInArrow(
        run,
        f"doc_id {kinds[id_col]}, {kept}lang_pred string, score double, "
        "spans array<struct<first_word: int, n_words: int, lang: string>>",
    )
