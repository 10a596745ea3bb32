"""Quality of documents without gold labels.

Several simple labellers look at different sides of a text and vote "reject", "keep" or
nothing. Their accuracies and the share of bad documents are estimated by expectation
maximisation over the counts of vote patterns of all documents (there are at most 3^8
patterns, whatever the number of documents). The posterior of a pattern is the label of its
documents, and a linear scorer on hashed features learns from a bounded sample of them
(``SAMPLE`` rows; the sample is the rows of smallest hash). It scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import sliced

#: Most documents the scorer is fitted on.
SAMPLE = 6_000
DIM = 2048
_LEVELS = 8
#: How often a labeller rejects good and bad documents, to begin with: each knows one kind of fault.
_FALSE, _TRUE = 0.002, 0.2

# Each labeller's figure, the bound to keep and the bound to reject.
LABELLERS = (
    ("symbols", 0.02, 0.06),  # share of characters that are symbols
    ("shouting", 0.2, 0.5),  # share of capitals among letters of the alphabet
    ("exclaiming", 0.05, 0.3),  # exclamation marks for each word
    ("piped", 0.02, 0.2),  # bars for each word
    ("repeated_lines", 0.2, 0.5),  # share of lines that stood before
    ("echoed_words", 0.08, 0.3),  # share of words that repeat the word before or the one before that
    ("repeated_pairs", 0.4, 0.7),  # share of neighbouring words that stood together before
    ("marked_words", 0.05, 0.3),  # share of words that end in a symbol
)

_CLASS = np.full(256, 10, np.uint8)
for _n, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r", b"\n", b".,;:?", b"!", b"|", b"#$%&*@^~+=<>_/\\`", b"()[]{}'\"-")):
    _CLASS[list(_chars)] = _n
_CLASS[128:] = 11
_SYMBOLS = b"#$%&*@^~+=<>_\\`|"


def figures(text: bytes) -> tuple[float, ...] | None:
    """What the labellers look at; none for a text without a word."""
    words = text.split()
    if not words:
        return None
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=12)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n = len(words)
    letters = kinds[0] + kinds[1]
    return (
        (kinds[8] + kinds[7]) / len(text),
        kinds[1] / letters if letters >= 20 else 0.0,  # a capital or two shout nothing
        kinds[6] / n,
        kinds[7] / n,
        1 - len(set(lines)) / len(lines),
        max(sum(map(eq, words, words[1:])), sum(map(eq, words, words[2:]))) / max(n, 10),
        1 - len(set(zip(words, words[1:], strict=False))) / (n - 1) if n >= 10 else 0.0,
        sum(w[-1] in _SYMBOLS and len(w) > 1 for w in words) / n,
    )


def votes(found: tuple[float, ...] | None) -> int:
    """A base-3 number: 0 nothing, 1 keep, 2 reject for each labeller; -1 for a text without a word."""
    if found is None:
        return -1
    code = 0
    for value, (_, keep, reject) in zip(found, LABELLERS, strict=True):
        code = code * 3 + (2 if value >= reject else 1 if value < keep else 0)
    return code


def features(text: bytes, found: tuple[float, ...] | None) -> np.ndarray:
    """Hashed shares of trigrams of character classes, and a hashed sign for each figure's level."""
    x = np.zeros(DIM, np.float32)
    if found is None:
        return x
    c = _CLASS[np.frombuffer(text, np.uint8)].astype(np.int64)
    if len(c) >= 3:
        code = np.bincount(c[:-2] * 144 + c[1:-1] * 12 + c[2:], minlength=1728)
        at = np.flatnonzero(code)
        np.add.at(x, (at * 2654435761 >> 7) % DIM, np.sqrt(code[at] / (len(c) - 2)))
    for k, (value, (_, keep, reject)) in enumerate(zip(found, LABELLERS, strict=True)):
        level = int(np.clip((value - keep) / (reject - keep) * 4 + 2, 0, _LEVELS - 1))
        x[((k * _LEVELS + level + 4096) * 2654435761 >> 7) % DIM] += 0.5
    return x


@dataclass(frozen=True)
class LabelModel:
    """Share of bad documents, and for each labeller how it votes on good and bad ones."""

    bad: float
    rates: np.ndarray  # class (good, bad) x labeller x vote (nothing, keep, reject)

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is bad."""
        v = _digits(codes)
        each = np.log(self.rates[:, np.arange(len(LABELLERS)), v]).sum(2)
        odds = each[1] - each[0] + np.log(self.bad / (1 - self.bad))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _digits(codes: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return np.asarray(codes)[:, None] // powers % 3


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation maximisation from a start that trusts each labeller.

    Only what a labeller says when it votes tells of its accuracy, so the rate at which it
    stays silent is shared by both classes. The weight of one document of each kind is added,
    which keeps the rates off 0 and 1.
    """
    v = _digits(codes)
    m = len(LABELLERS)
    said = np.stack([(v == k) * counts[:, None] for k in range(3)]).sum(1)  # vote x labeller
    silent = (said[0] + 1) / (counts.sum() + 3)
    start = np.empty((2, m, 3))
    start[:, :, 0] = silent
    for c, reject in ((0, _FALSE), (1, _TRUE)):
        start[c, :, 2], start[c, :, 1] = (1 - silent) * reject, (1 - silent) * (1 - reject)
    model = LabelModel(0.1, start)
    for _ in range(rounds):
        p = model.posterior(codes)
        weight = np.stack([(1 - p) * counts, p * counts])
        rates = start.copy()
        for c in range(2):
            yes = weight[c] @ (v == 2) + (_FALSE, _TRUE)[c] * 2
            no = weight[c] @ (v == 1) + (1 - _FALSE, 1 - _TRUE)[c] * 2
            rates[c, :, 2], rates[c, :, 1] = (1 - silent) * yes / (yes + no), (1 - silent) * no / (yes + no)
        bad = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 1e-4, 0.5))
        done = abs(bad - model.bad) < 1e-9 and np.abs(rates - model.rates).max() < 1e-9
        model = LabelModel(bad, rates)
        if done:
            break
    return model


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model on soft labels, both classes weighing alike; the last column of ``x`` is 1."""
    weight = np.where(y > 0.5, 0.5 / max((y > 0.5).mean(), 1e-3), 0.5 / max((y <= 0.5).mean(), 1e-3)) / len(y)
    w, m, s = (np.zeros(x.shape[1]) for _ in range(3))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
    return w


@dataclass(frozen=True)
class Model:
    labels: LabelModel
    weights: np.ndarray


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes]:
    return [t.as_py() or b"" for t in batch.column(at).cast(pa.binary())]


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, int] = {}
    for batch in sliced(batches):
        for text in _texts(batch, 0):
            code = votes(figures(text))
            counts[code] = counts.get(code, 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["code", "n"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        found = [(t, figures(t)) for t in _texts(batch, 0)]
        x = [features(t, f) for t, f in found]
        at = [np.flatnonzero(one).astype(np.int32) for one in x]
        cells = [pa.array([one.tobytes() for one in at], pa.binary()), pa.array([one[i].tobytes() for one, i in zip(x, at, strict=True)], pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([votes(f) for _, f in found], pa.int32()), batch.column(1), *cells], ["code", "h", "at", "x"])


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Label model over all documents, scorer on ``sample`` of them at most."""
    texts = docs.select(F.col(text_col).alias("t"))
    found = texts.mapInArrow(_vote, "code int, n bigint").where("code >= 0").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    if found.empty:
        return Model(LabelModel(0.1, np.full((2, len(LABELLERS), 3), 1 / 3)), np.zeros(DIM + 1))
    labels = estimate(found["code"].to_numpy(), found["n"].to_numpy(float))
    # The sample is the distinct texts of smallest hash: first the bound, then the texts below it.
    hashed = texts.where("t is not null").withColumn("h", F.xxhash64("t"))
    bound = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    few = hashed.where(F.col("h") <= bound).select("t", "h").mapInArrow(_featured, "code int, h bigint, at binary, x binary")
    rows = few.where("code >= 0").dropDuplicates(["h"]).orderBy("h").toArrow()
    if not rows.num_rows:
        return Model(labels, np.zeros(DIM + 1))
    # Few cells of a row are not 0, so only these travel, and the driver holds one matrix.
    x = np.zeros((rows.num_rows, DIM + 1))
    x[:, -1] = 1
    for row, at, values in zip(x, rows["at"], rows["x"], strict=True):
        row[np.frombuffer(at.as_py(), np.int32)] = np.frombuffer(values.as_py(), np.float32)
    return Model(labels, fit_scorer(x, labels.posterior(rows["code"].to_numpy())))


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``votes`` (one sign a labeller: + keep, - reject, . nothing), ``posterior`` and ``score``.

    Both are probabilities of a bad document: by the votes, and by the scorer. A text that is
    null or has no word is bad (both are 1). All rows and columns stay; columns of these names
    are replaced.
    """
    docs = docs.drop("votes", "posterior", "score")
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = [*docs.columns, "votes", "posterior", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            signs, codes, scores = [], [], []
            for text in _texts(batch, place):
                found = figures(text)
                code = votes(found)
                codes.append(code)
                signs.append("".join(".+-"[d] for d in _digits(np.array([code]))[0]) if code >= 0 else "")
                z = features(text, found) @ model.weights[:-1] + model.weights[-1]
                scores.append(1.0 if found is None else float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            codes = np.array(codes, np.int64)
            posterior = np.where(codes < 0, 1.0, model.labels.posterior(np.maximum(codes, 0))) if len(codes) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.string()), pa.array(posterior), pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, f"{columns}, votes string, posterior double, score double")
