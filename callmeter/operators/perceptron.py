"""Passes of a perceptron over rows in blocks (loss, gradient, figures), and solver steps.

The rows of a partition are packed into blocks once. A pass computes on whole blocks inside the
tasks; what many tasks found is summed in two steps before the driver gets it, and always in the
order of the partitions, so that the sum does not depend on which task ended first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are computed on at once.
BLOCK = 2048
#: So many partial sums at most go to the driver.
FEW = 8
#: Steps whose change of weights and of gradient tell the solver of the loss's curvature.
KEPT = 10


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            x, y, n, train = batch.slice(at, BLOCK).columns
            labels, taken = y.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
            chosen = train.to_numpy(zero_copy_only=False)
            if not np.isin(labels[chosen], (0.0, 1.0)).all():
                raise ValueError("a label to train on must be 0 or 1")
            order = np.argsort(taken <= 0, kind="stable")
            values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)
            cells = [np.ascontiguousarray(v[order], dtype=np.float64) for v in (values, labels, taken, chosen)]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], ["x", "y", "n", "train"])


def blocks(rows: DataFrame) -> RDD:
    """Rows (``features``, ``_y``, ``_n``, ``_train``) as blocks of bytes, held in memory, then on disk.

    ``_n`` is how often a row counts in the fit, 0 for rows that are only measured; these come last in a block.
    """
    flat = rows.select(vector_to_array("features").alias("x"), F.col("_y").alias("y"), F.col("_n").cast("double").alias("n"), F.col("_train").alias("train"))
    packed = flat.mapInArrow(_packed, "x binary, y binary, n binary, train binary")
    return packed.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _arrays(found: Iterator[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
    for cells in found:
        x, y, n, train = (np.frombuffer(c, np.float64) for c in cells)
        yield x.reshape(len(y), -1), y, n, train == 1


def _layers(weights: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix and offsets of each layer, in the order in which Spark's network keeps its weights."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def _outputs(layers: list, x: np.ndarray, room: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """What each layer gives, the input first: sigmoid units, at last the probability of each class.

    The units are computed in numbers of the layers' kind, the probabilities in 64 bits. Units
    are written to ``room``, if given, as memory that is new for every block costs its first touch.
    """
    given = [x.astype(layers[0][0].dtype, copy=False)]
    for i, (matrix, offsets) in enumerate(layers[:-1]):
        z = np.matmul(given[-1], matrix, out=room[i][: len(x)] if room else None)
        z += offsets
        np.negative(z, out=z)
        with np.errstate(over="ignore"):
            np.exp(z, out=z)
        z += 1
        given.append(np.reciprocal(z, out=z))
    matrix, offsets = layers[-1]
    z = given[-1].astype(np.float64, copy=False) @ matrix
    z += offsets
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    given.append(z)
    return given


def _summed(rows: RDD, task: Callable[[Iterator[tuple]], np.ndarray]) -> np.ndarray:
    """The sum of what ``task`` gives for each partition, in order; beyond ``FEW`` of them by way of partial sums."""

    def added(at: int, found: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        parts = [value for _, value in sorted(found, key=lambda f: f[0])]
        return iter([(at, sum(parts[1:], parts[0]))] if parts else [])

    each = rows.mapPartitionsWithIndex(lambda at, found: iter([(at, task(_arrays(found)))]))
    if (n := rows.getNumPartitions()) > FEW:
        wide = math.isqrt(n - 1) + 1
        some = each.partitionBy(wide, lambda at: at // wide).mapPartitionsWithIndex(added)
        each = some.partitionBy(1, lambda at: 0).mapPartitionsWithIndex(added)
    return next(added(0, iter(each.collect())))[1]


class Measured(NamedTuple):
    """What a pass finds: the loss the solver lowers and its gradient, and the figures of both sets."""

    loss: float
    gradient: np.ndarray
    #: Mean weighted loss and F1 of the train and of the validation rows; None where there are none.
    train: tuple[float, float] | None
    val: tuple[float, float] | None


#: So far from the threshold a score in 32 bits decides as one in 64 bits does.
UNSURE = 1e-3


def measure(
    rows: RDD, weights: np.ndarray, sizes: Sequence[int], pos_weight: float, threshold: float, kind: type = np.float64
) -> Measured:
    """Mean cross-entropy of the rows, each as often as it counts, its gradient, and the figures.

    The figures are as in ``evaluate``: rows without a label are left out of the loss, and a score
    that is not a number decides nothing. With 32 bits as ``kind`` units and slopes of a block are
    computed in 32 bits; probabilities, losses and all sums over blocks have 64, and rows whose
    score is close to the threshold are scored in 64 bits, so that decisions are the same.
    """

    def task(found: Iterator[tuple]) -> np.ndarray:
        total, layers = np.zeros(12 + len(weights)), _layers(weights, sizes)
        sums, slopes = total[2:12].reshape(2, 5), _layers(total[12:], sizes)
        narrow = [(matrix.astype(kind, copy=False), offsets.astype(kind, copy=False)) for matrix, offsets in layers[:-1]]
        narrow.append(layers[-1])
        room = [[np.empty((BLOCK, n), kind) for n in sizes[1:-1]] for _ in range(2)]
        for x, y, n, train in found:
            given = _outputs(narrow, x, room[0])
            back, used = given.pop(), int(np.count_nonzero(n > 0))
            score, known = back[:, 1], ~np.isnan(y)
            rest, p = (np.where(np.isnan(score), other, np.clip(v, 1e-15, 1 - 1e-15)) for v, other in zip(back.T, (1e-15, 1 - 1e-15)))
            loss, sure = -(pos_weight * y * np.log(p) + (1 - y) * np.log(rest)), score
            if kind != np.float64 and len(near := np.flatnonzero(np.abs(score - threshold) < UNSURE)):
                sure = score.copy()
                sure[near] = _outputs(layers, x[near])[-1][:, 1]
            guess = (sure >= threshold).astype(float)
            for part, here in enumerate((train, ~train)):
                at = here & known
                sums[part] += here.sum(), at.sum(), loss[at].sum(), (y * guess)[at].sum(), y[at].sum() + guess[here].sum()
            given, back, n = [g[:used] for g in given], back[:used], n[:used]
            cell = np.arange(used), y[:used].astype(int)
            with np.errstate(divide="ignore"):
                total[:2] += n.sum(), -(n @ np.log(back[cell]))
            back[cell] -= 1
            back *= n[:, None]
            back = back.astype(kind, copy=False)
            for at, ((matrix, _), (slope, offset)) in reversed(list(enumerate(zip(narrow, slopes)))):
                units = given.pop()
                slope += units.T @ back
                offset += back.sum(axis=0, dtype=np.float64)
                if given:
                    back = np.matmul(back, matrix.T.astype(kind, copy=False), out=room[1][at - 1][:used])
                    back *= units
                    np.subtract(1, units, out=units)
                    back *= units
        return total

    found = _summed(rows, task)
    one = lambda n, known, loss, hits, called: (loss / known if known else math.nan, 2 * hits / called if called else 0.0)
    parts = [tuple(map(float, one(*row))) if row[0] else None for row in found[2:12].reshape(2, 5)]
    return Measured(float(found[1] / found[0]), found[12:] / found[0], *parts)


def _towards(slope: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The direction of L-BFGS from the last changes of weights and of gradient."""
    left, shares = slope.copy(), []
    for s, y in reversed(pairs):
        shares.append((s @ left) / (s @ y))
        left -= shares[-1] * y
    if pairs:
        s, y = pairs[-1]
        left *= (s @ y) / (y @ y)
    for (s, y), share in zip(pairs, reversed(shares)):
        left += s * (share - (y @ left) / (s @ y))
    return -left


def steps(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]],
    weights: np.ndarray,
    pairs: Sequence[tuple[np.ndarray, np.ndarray]],
    count: int,
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """``count`` steps of L-BFGS: the new weights, and the pairs with which the next steps go on.

    A step is shortened until the loss falls as its slope lets expect. It ends early where the
    gradient vanishes, or no step lowers the loss; then the pairs are forgotten.
    """
    pairs = list(pairs)
    value, slope = loss(weights)
    for _ in range(count):
        if not math.isfinite(value) or np.linalg.norm(slope) <= max(1e-6 * abs(value), 1e-8):
            break
        towards = _towards(slope, pairs)
        fall = float(towards @ slope)
        if not fall < 0:
            pairs, towards, fall = [], -slope, -float(slope @ slope)
        length = 1.0 if pairs else min(1.0, 1 / float(np.linalg.norm(slope)))
        for _ in range(20):
            there, found = loss(weights + length * towards)
            if math.isfinite(there) and there <= value + 1e-4 * length * fall:
                break
            bend = there - value - length * fall
            best = -fall * length / (2 * bend) if math.isfinite(bend) and bend > 0 else 0.5
            length *= min(max(best, 0.1), 0.5)
        else:
            return weights, []
        s, y = length * towards, found - slope
        weights, value, slope = weights + s, there, found
        if s @ y > 1e-10 * (y @ y):
            pairs = [*pairs, (s, y)][-KEPT:]
    return weights, pairs


def remembered(find: Callable[[np.ndarray], Measured]) -> Callable[[np.ndarray], Measured]:
    """``find`` that gives what it found last again, so that steps begin where others ended."""
    last: list = [None, None]

    def again(weights: np.ndarray) -> Measured:
        if last[0] is None or not np.array_equal(last[0], weights):
            last[:] = weights.copy(), find(weights)
        return last[1]

    return again
