"""Scores of a small causal language model, and of a word-count baseline.

Texts become ids of subwords: the longest pieces of a public vocabulary that match from the
left, word by word. Pieces belong to classes, classes to groups. The model predicts a group,
a class within it, and takes the piece's share of its class from the corpus:

- *Counts*: how often each word occurs is counted over all training documents. Piece shares
  and the logarithms of which class follows which piece come from that table, so they cover
  the whole corpus without a further pass over the text.
- *Attention*: one causal self-attention layer adds what the context says. It is trained in
  numpy: a start on a small sample of documents, then every partition of the training
  documents goes on by itself, over all of their texts, and the weights are averaged.

A text is scored in windows of ``2 * BLOCK`` ids that overlap by half: each id is scored
once, in the second half of its window, so that it sees ``BLOCK`` ids at least (all there are
at a text's start). Windows of a batch go through masked attention together.

Texts are cut into words and pieces once; what training and scoring read are the pieces' ids.

The baseline's words are a distributed join: frequent words (a bounded table) are looked up
where the text lies, the long tail is joined by word and summed up by document.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import sliced, stored

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 16
KNOWN = 2046  # pieces with a vector of their own
SINGLE = 448  # pieces with a class of their own
GROUPS, PER_GROUP = 16, 32
WIDTH, KEY, VALUE = 16, 12, 24
SHARE = 1  # one stretch in so many is trained on; 1: whole texts
STRETCH = 64  # words
START_DOCS = 400  # documents of the start sample
HEADS = 60_000  # words looked up without a join
END = b"\n"  # no word holds it
_CACHE = 250_000
_LONG = 40  # bytes of words that are cut one by one


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case: whatever stands between blanks and controls 9 to 13."""
    return text.lower().split()


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]
    cache: dict[bytes, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        """States are beginnings of pieces, by length, then bytes: the state that follows from one by a byte is 1 + the place of both among ``steps``."""
        begun = sorted({p[:n] for p in self.ranks for n in range(1, len(p) + 1)}, key=lambda p: (len(p), p))
        state = {b"": 0} | {p: n for n, p in enumerate(begun, 1)}
        self.steps = np.array([*(state[p[:-1]] << 9 | p[-1] for p in begun), 1 << 60])
        self.rank = np.array([-1, *(self.ranks.get(p, -1) for p in begun)], np.int32)
        self.second = np.zeros((257, 257), np.int32)  # after two bytes
        for p in begun:
            if len(p) == 2:
                self.second[p[0], p[1]] = state[p]
        self.first = np.array([state.get(bytes([b]), 0) for b in range(256)] + [0], np.int32)
        self.longest = max(map(len, self.ranks))

    @property
    def end(self) -> int:
        return len(self.ranks)

    @property
    def kind(self) -> type:
        """Of an id."""
        return np.uint16 if self.end < 1 << 16 else np.int32

    def pieces(self, word: bytes) -> list[int]:
        """Ranks of the longest pieces from the left of a word with a blank before it."""
        text, at, out = b" " + word, 0, []
        while at < len(text):
            for n in range(min(self.longest, len(text) - at), 0, -1):
                rank = self.ranks.get(text[at : at + n])
                if rank is not None:
                    out.append(rank)
                    at += n
                    break
        return out

    def cut(self, words: list[bytes]) -> list[bytes]:
        """Bytes of the ranks of the pieces of each of some words, of no more than ``_LONG`` bytes each; all go on a piece at a time."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        text = np.full(sizes.sum(), 256, np.int32)  # between words stands what continues no piece
        at = np.cumsum(sizes) - sizes
        inside = np.ones(len(text), bool)
        inside[at] = inside[at + sizes - 1] = False
        text[inside] = np.frombuffer(b"".join(words), np.uint8)
        text[at] = 32
        out, many = np.zeros((len(words), _LONG + 1), self.kind), np.zeros(len(words), np.int64)
        who = np.arange(len(words))
        for n in range(_LONG + 1):
            state = self.first[text[at]]
            best, length = self.rank[state], np.ones(len(at), np.int64)
            state = self.second[text[at], text[at + 1]]
            on = np.flatnonzero(state)
            state, depth = state[on], 2
            while len(on):
                rank = self.rank[state]
                good = rank >= 0
                best[on[good]] = rank[good]
                length[on[good]] = depth
                step = state.astype(np.int64) << 9 | text[at[on] + depth]
                place = np.searchsorted(self.steps, step)
                good = self.steps[place] == step
                on, state, depth = on[good], place[good] + 1, depth + 1
            out[who, n] = best
            many[who] += 1
            at += length
            left = np.flatnonzero(text[at] < 256)
            if not len(left):
                break
            who, at = who[left], at[left]
        ranks = out[np.arange(_LONG + 1) < many[:, None]].tobytes()
        stops = (np.cumsum(many) * out.itemsize).tolist()
        return [ranks[s:e] for s, e in zip([0, *stops], stops, strict=False)]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Bytes of the ranks of each word's pieces."""
        if len(self.cache) > _CACHE:
            self.cache.clear()
        out = list(map(self.cache.get, words))
        new = [n for n, packed in enumerate(out) if packed is None]
        short = list({words[n] for n in new if len(words[n]) <= _LONG})
        for at in range(0, len(short), 20_000):
            some = short[at : at + 20_000]
            self.cache.update(zip(some, self.cut(some), strict=True))
        for n in new:
            out[n] = self.cache.get(words[n]) or np.array(self.pieces(words[n]), self.kind).tobytes()
        return out

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Ranks of the words' pieces and the end."""
        return np.frombuffer(b"".join([*self.packed(words), self.kind(self.end).tobytes()]), self.kind)


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """Reads a file of pieces on the driver; by default the public one of 50,256 pieces."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@dataclass
class Model:
    """``vector``, ``cls`` and ``share`` by rank (the end is the last); ``direct*`` by vector; the attention's weights."""

    vector: np.ndarray
    cls: np.ndarray
    share: np.ndarray
    direct1: np.ndarray
    direct2: np.ndarray
    weights: dict[str, np.ndarray]

    @cached_property
    def direct(self) -> np.ndarray:
        """Logits of the groups and, beside them, of the classes within one, by vector and group."""
        groups = np.repeat(self.direct1[:, None], GROUPS, axis=1)
        return np.concatenate([groups, self.direct2], axis=2).reshape(-1, GROUPS + PER_GROUP)

    @cached_property
    def group(self) -> np.ndarray:
        """By rank; the last one, where -1 leads, stands for no piece."""
        return np.append(self.cls // PER_GROUP, GROUPS).astype(np.uint8)


def _spans(batches: Iterator[pa.RecordBatch], size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches whose last column, the text, has about so many bytes, or one row."""
    for batch in batches:
        total = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(total // size)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if s < e:
                yield batch.slice(s, e - s)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, a null one none, and all of them; as ``words_of``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    there = pc.binary_length(words).to_numpy() > 0  # what stands before or behind the blanks at a text's ends is empty
    before = np.concatenate([[0], np.cumsum(there)])
    return np.diff(before[lists.offsets.to_numpy()]), words.filter(pa.array(there))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for span in _spans(batches):
        found = _split(span.column(0))[1].value_counts()
        words = pa.concat_arrays([found.field("values").cast(pa.binary()), pa.array([END], pa.binary())])
        yield pa.RecordBatch.from_arrays([words, pa.concat_arrays([found.field("counts"), pa.array([span.num_rows], pa.int64())])], ["word", "c"])


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (binary; the end included) and ``c``, over all rows."""
    texts = train.select(F.col(text_col).alias("t"))
    return stored(texts.mapInArrow(_count_words, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")), "words")


def _pair_counts(vocabulary) -> object:
    """Counts of pieces and of neighbours within words, from the words' counts.

    A pair's key is the first rank times 2^20 plus the second; a word's first piece follows
    rank 2^20 - 1, and what follows its last piece has the second rank 2^20 - 1.
    """
    edge = (1 << 20) - 1

    def summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        pair, c = np.concatenate(pairs), np.concatenate(counts)
        by = np.argsort(pair, kind="stable")
        pair, c = pair[by], c[by]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(pair[first]), pa.array(np.add.reduceat(c, first))], ["pair", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, end, pairs, counts = vocabulary.value.kind, vocabulary.value.end, [], []
        for batch in sliced(batches, 10_000):
            words = batch.column(0).to_pylist()
            packed = [kind(end).tobytes() if w == END else p for w, p in zip(words, vocabulary.value.packed(words), strict=True)]
            many = np.array(list(map(len, packed))) // kind().itemsize
            ranks = np.frombuffer(b"".join(packed), kind)
            # Each word has a pair more than it has pieces: a piece is second in its pair, and first in the next.
            at = np.arange(len(ranks)) + np.repeat(np.arange(len(words)), many)
            a, b = np.full((2, len(ranks) + len(words)), edge)
            b[at] = a[at + 1] = ranks
            pairs.append(a << 20 | b)
            counts.append(np.repeat(batch.column(1).to_numpy(), many + 1))
            if sum(map(len, pairs)) > 1_000_000:
                yield summed(pairs, counts)
                pairs, counts = [], []
        if pairs:
            yield summed(pairs, counts)

    return run


def prepare(counts: DataFrame, vocabulary: Vocabulary) -> Model:
    """Classes, piece shares and the direct path, from counts over the whole corpus."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)
    pairs = counts.mapInArrow(_pair_counts(shared), "pair bigint, c bigint").groupBy("pair").agg(F.sum("c").alias("c"))
    edge, size = (1 << 20) - 1, vocabulary.end + 1
    pairs = stored(pairs.select((F.shiftright("pair", 20)).alias("a"), (F.col("pair").bitwiseAND(edge)).alias("b"), "c"), "pairs")
    # Bounded by the vocabulary: one figure a piece.
    ones = pairs.where(F.col("b") != edge).groupBy("b").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("a") == edge, F.col("c"))).alias("first")).toPandas()
    count, first = np.zeros(size), np.zeros(size)
    count[ones["b"]], first[ones["b"]] = ones["c"], ones["first"].fillna(0)

    order = np.argsort(-count, kind="stable")
    vector = np.full(size, KNOWN, np.int32)  # KNOWN: any other piece; KNOWN + 1: a text's start
    vector[order[:KNOWN]] = np.arange(KNOWN)
    cls = np.empty(size, np.int32)
    cls[order[:SINGLE]] = np.arange(SINGLE)
    rest, kinds = order[SINGLE:], GROUPS * PER_GROUP - SINGLE
    leading = first[rest] * 2 >= np.maximum(count[rest], 1)
    for at, (some, many) in enumerate(((rest[leading], kinds // 2), (rest[~leading], kinds // 2))):
        mass = np.cumsum(count[some] + 0.1)
        part = np.minimum((mass / max(mass[-1] if len(mass) else 1, 1e-9) * many).astype(np.int32), many - 1)
        cls[some] = SINGLE + at * (kinds // 2) + part
    # Classes are dealt to groups in turn by what they are: first the leading ones, then by frequency.
    lead = np.bincount(cls, first, GROUPS * PER_GROUP) / np.maximum(np.bincount(cls, count, GROUPS * PER_GROUP), 1)
    place = np.empty(GROUPS * PER_GROUP, np.int32)
    place[np.lexsort((np.arange(GROUPS * PER_GROUP), lead < 0.5))] = np.arange(GROUPS * PER_GROUP)
    cls = place[cls]
    whole = np.bincount(cls, count + 0.1, GROUPS * PER_GROUP)
    share = np.log((count + 0.1) / whole[cls])

    # What follows a piece: a class within the word, or the word's end and any word's first class.
    table = counts.sparkSession.createDataFrame([(int(i), int(v), int(c)) for i, (v, c) in enumerate(zip(vector, cls, strict=True))], "rank int, v int, k int")
    inner = pairs.where(F.col("a") != edge).join(F.broadcast(table.select("rank", "v")), F.col("a") == F.col("rank")).drop("rank")
    inner = inner.join(F.broadcast(table.select("rank", "k")), F.col("b") == F.col("rank"), "left")
    rows = inner.groupBy("v", F.coalesce("k", F.lit(-1)).alias("k")).agg(F.sum("c").alias("c")).toPandas()  # bounded: vectors times classes
    follow = np.zeros((KNOWN + 2, GROUPS * PER_GROUP))
    begin = np.bincount(cls, first, GROUPS * PER_GROUP) + 0.01
    begin /= begin.sum()
    ends = rows["k"] < 0
    np.add.at(follow, (rows["v"][~ends].to_numpy(int), rows["k"][~ends].to_numpy(int)), rows["c"][~ends].to_numpy(float))
    stops = np.zeros(KNOWN + 2)
    np.add.at(stops, rows["v"][ends].to_numpy(int), rows["c"][ends].to_numpy(float))
    follow += stops[:, None] * begin
    usual = whole / whole.sum()
    follow[KNOWN + 1] = begin * 1e6
    follow = (follow + 5 * usual) / (follow.sum(1, keepdims=True) + 5)
    grouped = follow.reshape(-1, GROUPS, PER_GROUP)
    totals = np.maximum(grouped.sum(2), 1e-20)
    direct1 = np.log(totals).astype(np.float32)
    direct2 = np.log(np.maximum(grouped / totals[:, :, None], 1e-20)).astype(np.float32)
    rng = np.random.default_rng(42)
    shapes = {"e": (KNOWN + 2, WIDTH), "q": (WIDTH, KEY), "k": (WIDTH, KEY), "v": (WIDTH, VALUE)}
    weights = {n: (rng.standard_normal(s) * (0.3 if n == "e" else 0.25)).astype(np.float32) for n, s in shapes.items()}
    weights |= {"far": np.zeros(2 * BLOCK, np.float32), "b1": np.zeros((VALUE, GROUPS), np.float32), "b2": np.zeros((GROUPS, VALUE, PER_GROUP), np.float32)}
    return Model(vector, cls, share, direct1, direct2, weights)


def windows(texts: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of input vectors (with the block before), whether that is of the same text, targets (-1: none), texts."""
    if not texts:
        return np.empty((0, 2 * BLOCK), np.int32), np.empty(0, bool), np.empty((0, BLOCK), np.int64), np.empty(0, np.int64)
    many = np.array([-(-len(t) // BLOCK) for t in texts])
    starts = np.cumsum(many) - many
    ids = np.full(many.sum() * BLOCK, KNOWN, np.int32)
    target = np.full(len(ids), -1, np.int64)
    for t, at in zip(texts, starts * BLOCK, strict=True):
        target[at : at + len(t)] = t
    inside = target >= 0
    ids[1:][inside[:-1]] = model.vector[target[:-1][inside[:-1]]]
    ids[starts * BLOCK] = KNOWN + 1
    block = ids.reshape(-1, BLOCK)
    before = np.roll(block, 1, axis=0)
    joined = np.ones(len(block), bool)
    joined[starts] = False
    return np.hstack([before, block]), joined, target.reshape(-1, BLOCK), np.repeat(np.arange(len(texts)), many)


_AGE = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)
_MASK = np.where((_AGE >= 0) & (_AGE < 2 * BLOCK), 0.0, -1e9).astype(np.float32)
_FIRST = np.where(np.arange(2 * BLOCK) < BLOCK, -1e9, 0.0).astype(np.float32)


_AGES = np.clip(_AGE, 0, 2 * BLOCK - 1)
_SCALE = np.float32(1 / np.sqrt(KEY))
#: Sums up the exponentials of the groups, and of the classes within one.
_PARTS = np.repeat(np.eye(2, dtype=np.float32), [GROUPS, PER_GROUP], axis=0)


def _projections(w: dict[str, np.ndarray]) -> np.ndarray:
    """Query, key and value of every vector side by side, and a one, which sums up weights next to values."""
    out = np.empty((len(w["e"]), 2 * KEY + VALUE + 1), np.float32)
    out[:, -1] = 1
    np.matmul(w["e"], np.hstack([w["q"] * _SCALE, w["k"], w["v"]]), out=out[:, :-1])
    return out


def _places(ids: np.ndarray) -> np.ndarray:
    """Vectors of windows that follow each other, each once: the first half of a window is the second half of the one before."""
    return np.concatenate([ids[0, :BLOCK], ids[:, BLOCK:].ravel()])


def _attend(w: dict[str, np.ndarray], every: np.ndarray, at: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masked attention of each window's second half over the whole of it.

    Returns what is attended to, the weights before they are divided by their sums, the sums,
    and queries, keys, and values with a one.
    """
    rows = every.take(at, axis=0)
    q = rows[BLOCK:, :KEY].reshape(-1, BLOCK, KEY)
    # A view in which each window begins a block of rows after the one before.
    both = np.ndarray((len(joined), 2 * BLOCK, rows.shape[1]), rows.dtype, rows, 0, (BLOCK * rows.strides[0], *rows.strides))
    k, v = both[:, :, KEY : 2 * KEY], both[:, :, 2 * KEY :]
    s = q @ k.transpose(0, 2, 1)
    s += _MASK + w["far"][_AGES]
    s[~joined] += _FIRST
    np.minimum(s, 60, out=s)
    np.exp(s, out=s)
    a = (s @ v).reshape(-1, VALUE + 1)
    return a[:, :-1] / a[:, -1:], s, a[:, -1], q, k, v


def _by_group(model: Model, target: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places that have a target, in order of its group; their targets and groups, where each group begins, and the targets' places among logits."""
    t = target.ravel()
    group = model.group.take(t)
    cuts = [0, *np.cumsum(np.bincount(group, minlength=GROUPS))[:GROUPS].tolist()]
    live = np.argsort(group, kind="stable")[: cuts[-1]]
    t, group = t.take(live), group.take(live)
    first = np.arange(0, len(t) * len(_PARTS), len(_PARTS))
    return live, t, group, cuts, np.stack([first + group, first + (GROUPS + model.cls.take(t) % PER_GROUP)])


def _logits(model: Model, a: np.ndarray, x: np.ndarray, group: np.ndarray, cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of the groups, and beside them of the classes within each row's group, whose rows stand together; the weights by group."""
    w = np.concatenate([np.broadcast_to(model.weights["b1"], (GROUPS, VALUE, GROUPS)), model.weights["b2"]], axis=2)
    z = np.empty((len(a), len(_PARTS)), np.float32)
    for g, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        np.matmul(a[s:e], w[g], out=z[s:e])
    z += model.direct.take(x * GROUPS + group, axis=0)
    # Logits are logarithms of shares and a small term, so no maximum need be taken off.
    return np.minimum(z, 60, out=z), w


def log_probabilities(model: Model, every: np.ndarray, ids: np.ndarray, joined: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logarithms of each target's probability, 0 where there is none."""
    at = _places(ids)
    live, t, group, cuts, picked = _by_group(model, target)
    a = _attend(model.weights, every, at, joined)[0].take(live, axis=0)
    z, _ = _logits(model, a, at[BLOCK:].take(live), group, cuts)
    found = z.ravel().take(picked).sum(0)
    np.exp(z, out=z)
    found -= np.log(z @ _PARTS).sum(1)
    out = np.zeros(target.size)
    out[live] = found + model.share.take(t)
    return out


def gradients(model: Model, ids: np.ndarray, joined: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative logarithm, by each weight. Windows follow each other."""
    w, at, many = model.weights, _places(ids), len(ids)
    live, _, group, cuts, picked = _by_group(model, target)
    a, p, total, q, k, v = _attend(w, _projections(w), at, joined)
    a = a.take(live, axis=0)
    z, by = _logits(model, a, at[BLOCK:].take(live), group, cuts)
    n = np.float32(max(len(live), 1))
    np.exp(z, out=z)
    z *= (1 / (z @ _PARTS * n)) @ _PARTS.T
    z.ravel()[picked] -= 1 / n
    back, each = np.empty((len(a), VALUE + 1), np.float32), np.empty_like(by)
    for g, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        np.matmul(a[s:e].T, z[s:e], out=each[g])
        np.matmul(z[s:e], by[g].T, out=back[s:e, :-1])
    out = {"b1": each[:, :, :GROUPS].sum(0), "b2": each[:, :, GROUPS:]}
    # Weights have sums of one, so what is attended to comes off; the ones next to the values do that.
    a *= back[:, :-1]
    back[:, -1] = a @ -np.ones(VALUE, np.float32)
    back /= total.take(live)[:, None]
    da = np.zeros((many * BLOCK, VALUE + 1), np.float32)
    da[live] = back
    da = da.reshape(many, BLOCK, -1)
    ds = da @ v.transpose(0, 2, 1)
    ds *= p
    out["far"] = np.bincount(_AGES.ravel(), np.ones(many, np.float32) @ ds.reshape(many, -1), 2 * BLOCK).astype(np.float32)
    # Slopes of queries, keys and values; those of an id come from the two windows that it is in.
    both = np.empty((many, 2 * BLOCK, 2 * KEY + VALUE), np.float32)
    both[:, :BLOCK, :KEY] = 0
    np.matmul(ds, k, out=both[:, BLOCK:, :KEY])
    np.matmul(ds.transpose(0, 2, 1), q, out=both[:, :, KEY : 2 * KEY])
    np.matmul(p.transpose(0, 2, 1), da[:, :, :-1], out=both[:, :, 2 * KEY :])
    both = both.reshape(many, 2, -1)
    d = np.empty((many + 1, both.shape[2]), np.float32)
    d[0], d[1:] = 0, both[:, 1]
    d[:-1] += both[:, 0]
    d = d.reshape(-1, 2 * KEY + VALUE)
    own = w["e"].take(at, axis=0).T @ d
    out["q"], out["k"], out["v"] = own[:, :KEY] * _SCALE, own[:, KEY : 2 * KEY], own[:, 2 * KEY :]
    out["e"] = np.zeros(w["e"].shape, np.float32)
    # One place at a time: adding whole rows at places takes far longer.
    np.add.at(out["e"].ravel(), (at[:, None] * WIDTH + np.arange(WIDTH)).ravel(), (d @ np.hstack([w["q"] * _SCALE, w["k"], w["v"]]).T).ravel())
    return out


def stretches(words: list[bytes], share: int, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Ids of one in ``share`` of a text's stretches of ``STRETCH`` words, of one at least.

    With a share of 1 the text is one stretch. Else, which comes first follows from the text's length; only the last one has the text's end.
    """
    if share == 1:
        return [vocabulary.encode(words)]
    many = max(-(-len(words) // STRETCH), 1)
    out = []
    for n in range(len(words) % min(share, many), many, share):
        ids = vocabulary.encode(words[n * STRETCH : (n + 1) * STRETCH])
        out.append(ids if n == many - 1 else ids[:-1])
    return out


class _Trainer:
    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.t, self.seen = model, rate, 0, 0
        # The weights become parts of one array, so that a step is taken in all of them at once.
        self.names, shapes = sorted(model.weights), {n: a.shape for n, a in model.weights.items()}
        self.flat = np.concatenate([model.weights[n].ravel() for n in self.names])
        cuts = np.cumsum([model.weights[n].size for n in self.names])[:-1]
        model.weights = {n: a.reshape(shapes[n]) for n, a in zip(self.names, np.split(self.flat, cuts), strict=True)}
        self.m, self.s = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def learn(self, texts: list[np.ndarray]) -> None:
        """Steps over all windows of the texts."""
        ids, joined, target, _ = windows(texts, self.model)
        self.seen += int((target >= 0).sum())
        for at in range(0, len(ids), 128):
            some = slice(at, at + 128)
            g = gradients(self.model, ids[some], joined[some], target[some])
            self.t += 1
            x = np.concatenate([g[n].ravel() for n in self.names])
            self.m *= 0.9
            self.m += 0.1 * x
            self.s *= 0.99
            x *= x
            x *= 0.01
            self.s += x
            spread = (1 - 0.99**self.t) ** 0.5
            by = np.sqrt(self.s, out=x)
            by += 1e-7 * spread
            np.divide(self.m, by, out=by)
            by *= self.rate * spread / (1 - 0.9**self.t)
            self.flat -= by


def _slabs(batch: pa.RecordBatch, kind: type, size: int = 1_000_000) -> Iterator[list[np.ndarray]]:
    """Ids of so many bytes of text at a time; the last two columns have the texts' bytes and their ids."""
    some, total = [], 0
    for bytes_, ids in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
        some.append(np.frombuffer(ids, kind))
        total += bytes_
        if total > size:
            yield some
            some, total = [], 0
    if some:
        yield some


def _trained(shared, kind: type, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replace(shared.value, weights=dict(shared.value.weights))
        trainer = _Trainer(model, rate)
        for batch in sliced(batches):
            for some in _slabs(batch, kind):
                trainer.learn(some)
        if trainer.seen:
            flat = trainer.flat.astype(np.float64) * trainer.seen
            cuts = range(0, len(flat), 4096)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int32()), pa.array([trainer.seen] * len(cuts), pa.int64()), pa.array([flat[c : c + 4096] for c in cuts], pa.list_(pa.float64()))],
                ["part", "seen", "sums"],
            )

    return run


def train(docs: DataFrame, learned: DataFrame, model: Model, vocabulary: Vocabulary, text_col: str = "text") -> Model:
    """Trains the attention: a start on a bounded sample of ``docs``, then all partitions of ``learned`` (``bytes`` and ``ids``) on their own, averaged."""
    texts = docs.select(F.col(text_col).alias("t")).where("t is not null")
    few = texts.where(F.length("t") <= 20_000).orderBy(F.xxhash64("t"), "t").limit(START_DOCS).collect()
    sample = [vocabulary.encode(words_of(r.t.encode())) for r in few]
    for rate in (0.02, 0.01, 0.005):
        start = _Trainer(model, rate)
        for _ in range(2):
            start.learn(sample)
    model = replace(model)  # without what was worked out from it
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = learned.select("bytes", "ids").mapInArrow(_trained(shared, vocabulary.kind, 0.004), "part int, seen bigint, sums array<double>")
    # One row a weight and partition, summed before the shuffle; the result is bounded by the weights.
    one = parts.select("part", "seen", F.posexplode("sums").alias("i", "x"))
    sums = one.groupBy("part", "i").agg(F.sum("x").alias("x"), F.sum("seen").alias("n")).toPandas()
    if len(sums):
        flat = np.zeros(len(sums))
        flat[(sums["part"] * 4096 + sums["i"]).to_numpy(int)] = sums["x"] / sums["n"]
        at = 0
        for name, a in sorted(model.weights.items()):
            model.weights[name] = flat[at : at + a.size].reshape(a.shape).astype(np.float32)
            at += a.size
    return model


def score_texts(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Base-10 logarithms of the probabilities of texts (ranks of their pieces and the end)."""
    ids, joined, target, text = windows(texts, model)
    out = np.zeros(len(texts))
    every = _projections(model.weights)
    # So few at a time that what is made of them stays in a core's cache.
    for at in range(0, len(ids), 256):
        s = slice(at, at + 256)
        found = log_probabilities(model, every, ids[s], joined[s], target[s]).reshape(-1, BLOCK).sum(1)
        out += np.bincount(text[s], found, len(texts))
    return out / np.log(10)


def _encoded(shared, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, heads = shared.value
        for span in _spans(batches):
            texts = span.column(span.num_columns - 1)
            many, found = _split(texts)
            found = found.dictionary_encode()
            words = [*found.dictionary.cast(pa.binary()).to_pylist(), END]
            # Each text's words, by their places among the different ones, and the end.
            which = np.full(len(found) + len(many), len(words) - 1)
            which[np.arange(len(found)) + np.repeat(np.arange(len(many)), many)] = found.indices.to_numpy()
            stops = np.cumsum(many + 1)
            starts = stops - many - 1

            packed = [*vocabulary.packed(words[:-1]), vocabulary.kind(vocabulary.end).tobytes()]
            pool, lengths = np.frombuffer(b"".join(packed), vocabulary.kind), np.array(list(map(len, packed))) // vocabulary.kind().itemsize
            each = lengths[which]
            behind = np.cumsum(each)
            ids = pool[np.arange(behind[-1]) + np.repeat((np.cumsum(lengths) - lengths)[which] - behind + each, each)]
            ends = np.concatenate([[0], behind[stops - 1]])
            parts = [None if share == 1 else [p.tobytes() for p in stretches([words[w] for w in which[s : e - 1]], share, vocabulary)] for s, e in zip(starts, stops, strict=True)]

            logs = np.array(list(map(heads.get, words)), float)[which]  # not a number: in the long tail
            rare = np.isnan(logs)
            rows, counts = np.unique(np.repeat(np.arange(len(many)), many + 1)[rare] * len(words) + which[rare], return_counts=True)
            tail = pa.StructArray.from_arrays([pa.array(words, pa.binary()).take(pa.array(rows % len(words))), pa.array(counts.astype(np.int32))], ["word", "tf"])
            added = {
                "n_tokens": pa.array(many + 1, pa.int64()),
                "base": pa.array(np.add.reduceat(np.where(rare, 0, logs), starts)),
                "known": pa.array(np.add.reduceat(~rare, starts, dtype=np.int64)),
                "tail": pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(len(many) + 1) * len(words)).astype(np.int32)), tail),
                "bytes": pc.binary_length(texts).fill_null(0),
                "ids": pa.array([ids[s:e].tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary()),
                "parts": pa.array(parts, pa.list_(pa.binary())),
            }
            yield pa.RecordBatch.from_arrays([*span.columns[:-1], *added.values()], [*span.schema.names[:-1], *added])

    return run


def _scored(shared, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            scores = [score_texts(some, model) for some in _slabs(batch, kind)]
            if scores:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(np.concatenate(scores))], [*batch.schema.names[:-2], "score"])

    return run


def score_documents(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    share: int = SHARE,
    heads: int = HEADS,
) -> DataFrame:
    """Scores all documents with models learned from those that are not ``held_out``.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (tokens
    that occur in training), ``train_tokens``, ``base_score`` (sum of log10 of the smoothed
    share of each token) and ``score`` (log10 of the text's probability by the model). A null
    text is empty: one token, the end. Each row, repeated or not, gives one row; without
    training rows the baseline knows no word. Columns besides the two named, and those that
    ``held_out`` uses, are not read.
    """
    vocabulary = load_vocabulary(path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("t"))
    learned = rows.where("not held_out")
    counts = word_counts(learned, "t")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = {bytes(r.word): float(np.log10(r.c + 1)) for r in counts.orderBy(F.desc("c"), "word").limit(heads).collect()}
    context, kind = docs.sparkSession.sparkContext, docs.schema[id_col].dataType.simpleString()
    named = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", (~F.col("held_out") & F.col("t").isNotNull()).alias("learned"), "t")
    coded = named.mapInArrow(
        _encoded(context.broadcast((vocabulary, common)), share),
        f"uid bigint, doc_id {kind}, held_out boolean, learned boolean, n_tokens bigint, base double, known bigint, "
        "tail array<struct<word: binary, tf: int>>, bytes int, ids binary, parts array<binary>",
    )
    coded = stored(coded, "ids")
    to_learn = coded.where("learned")
    if share != 1:
        to_learn = to_learn.select(F.explode("parts").alias("ids")).withColumn("bytes", F.octet_length("ids"))
    model = train(learned, to_learn, prepare(counts, vocabulary), vocabulary, "t")
    scored = coded.select("uid", "doc_id", "held_out", "n_tokens", "base", "known", "bytes", "ids").mapInArrow(
        _scored(context.broadcast(model), vocabulary.kind),
        f"uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, base double, known bigint, score double",
    )
    scored = stored(scored, "scores")
    tail = coded.select("uid", F.explode("tail").alias("x")).select("uid", F.col("x.word").alias("word"), F.col("x.tf").alias("tf"))
    found = tail.join(counts, "word").groupBy("uid").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("more"), F.sum("tf").alias("more_known"))
    out = scored.join(found, "uid", "left")
    zero = F.lit(0)
    smooth = F.lit(float(np.log10(total + distinct + 1)))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * smooth).alias("base_score"),
        "score",
    )
