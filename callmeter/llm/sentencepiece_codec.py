"""SentencePiece encoding and decoding by dynamic programming over cuts.

The vocabulary is of the byte-pair kind: a segmentation is the model's own exactly if each two
neighbouring pieces, merged anew as a text of their own, come out as these two. Such a
segmentation of any text is unique. It is the path of weight zero through states (a cut and
the piece before it) whose steps weigh zero if the pieces go together, else minus infinity:
a max-plus problem, solved from left to right.

Units (a run of blanks and the letters or the punctuation behind it, a line break) are never
crossed by a piece, so a unit is solved on its own, depth first, and remembered within a worker.

Giant texts are cut into chunks at any character, in a parallel scan: a chunk yields a
transfer matrix from the states at its left border (how far before the border the last cut
lies, and how long the piece before it is) to those at its right border. The matrices of a
text could be multiplied in any order, as max-plus algebra is associative; here states are
carried through them from first to last, by one task for a document; that fixes the state at every
border, and each chunk is then traced back on its own.

Characters outside the vocabulary become byte pieces; a blank is the piece mark. A literal
piece mark in a text is spelled in bytes, so decoding gives back every text exactly.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import column, sliced, stored

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Texts longer than this are cut into chunks of this many characters.
CHUNK = 32_768
#: Units that a worker remembers (twice as many while older ones are at hand), and pairs of pieces.
_CACHE, _PAIRS = 120_000, 300_000
#: Numbers of characters that are no pieces start here; a pair's key holds two numbers of so many bits.
_OTHER, _BITS = 1 << 21, 22


class Solved(dict):
    """Packed ids of units, solved when first asked for.

    When it is full its entries become the older half; those still in use come back from there.
    """

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.older = pieces, {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            found = array("i", solve(unit, self.pieces)).tobytes()
        if len(unit) <= 40:
            if len(self) > _CACHE:
                self.older = dict(self)
                self.clear()
            self[unit] = found
        return found


@dataclass
class Pieces:
    """A vocabulary: pieces with blanks for piece marks, their ids and scores, and byte pieces.

    ``marks`` are the signs and digits; no piece joins a letter to one behind it that is not
    in ``behind``, nor to one before it that is not in ``before``.
    """

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_of: list[int]
    longest: int
    spelled: list[bytes]
    marks: set[str] = field(default_factory=set)
    behind: set[str] = field(default_factory=set)
    before: set[str] = field(default_factory=set)
    tails: dict[str, int] = field(default_factory=dict)
    heads: dict[str, int] = field(default_factory=dict)
    halves: dict[str, tuple[str, str] | None] = field(default_factory=dict)
    odd: set[str] = field(default_factory=set)
    pairs: dict[int, bool] = field(default_factory=dict)
    solved: Solved = field(init=False)

    def __post_init__(self) -> None:
        self.solved = Solved(self)
        self.marks = {chr(c) for c in range(33, 127) if not chr(c).isalpha()}
        joined = {(x, y) for p in self.ids for x, y in zip(p, p[1:], strict=False)}
        # A blank inside a piece, behind something else, would tie units together.
        assert not any(x != " " and y == " " for x, y in joined), "pieces of several words"
        self.behind = {y for x, y in joined if y in self.marks and x != " " and x not in self.marks}
        self.before = {x for x, y in joined if x in self.marks and y not in self.marks}
        for p in self.ids:
            if len(p) > 1 and (two := self.last_merge(p)):
                self.halves[p] = two
            self.tails[p[-2:]] = max(self.tails.get(p[-2:], 1), len(p))
            self.heads[p[:3]] = max(self.heads.get(p[:3], 1), len(p))
        # Pieces with a part that scores worse than the whole: what they are made of does not follow from scores.
        for p in sorted(self.halves, key=len):
            if any(x in self.odd or self.scores[x] <= self.scores[p] for x in self.halves[p] if len(x) > 1):
                self.odd.add(p)
        m, left, right = (re.escape("".join(sorted(x))) for x in (self.marks, self.behind, self.before))
        word = rf"(?:[^ \n{m}]+|[{m}]+)"
        more = (rf"(?<![ {m}])[{left}][{m}]*" if left else "(?!)") + "|" + (rf"(?<=[{right}])[^ \n{m}]+" if right else "(?!)")
        self.units = re.compile(rf"\n| +(?:{word}(?:{more})*)?|{word}(?:{more})*")

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by merging: the best-scored neighbours first, the left one of equals."""
        return self._merges(text)[0]

    def _merges(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The parts that are left, and the two that were merged last."""
        parts, scores, never, last = list(text), self.scores, -np.inf, None
        ways = [scores.get(x + y, never) for x, y in zip(parts, parts[1:], strict=False)]
        while ways and (best := max(ways)) != never:
            i = ways.index(best)
            last = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ways[i]
            for k in range(max(i - 1, 0), min(i + 1, len(ways))):
                ways[k] = scores.get(parts[k] + parts[k + 1], never)
        return parts, last

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that become the piece in the end; none if merging does not lead to it."""
        parts, last = self._merges(piece)
        return last if parts == [piece] else None

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the text of two pieces never joins what meets at their border.

        Goes back in time from the whole pieces: the one with the lower score was made later (of
        equals the right one), so before that its part at the border stood there. Two parts that
        met there would have been merged if that scores better than what happened next; of equal
        scores the left place comes first.
        """
        scores, halves, never = self.scores, self.halves, -np.inf
        if any(len(x) > 1 and x not in halves for x in (left, right)):
            return False
        if left in self.odd or right in self.odd:
            return self.merged(left + right) == [left, right]
        following, on_right = never, False
        while True:
            crossing = scores.get(left + right, never)
            if crossing > following or (on_right and crossing == following):
                return False
            x, y = halves.get(left), halves.get(right)
            if x is None and y is None:
                return True
            on_right = x is None or (y is not None and scores[right] <= scores[left])
            if on_right:
                following, right = scores[right], y[0]
            else:
                following, left = scores[left], x[1]

    def together(self, left: str, right: str) -> bool:
        """Whether two pieces may stand side by side; nothing may stand left of a unit's first."""
        key = self.number(left) << _BITS | self.number(right)
        found = self.pairs.get(key)
        return self.paired(key, left, right) if found is None else found

    def paired(self, key: int, left: str, right: str) -> bool:
        if len(self.pairs) > _PAIRS:
            self.pairs.clear()
        found = self.apart(left, right) if left else len(right) == 1 or right in self.halves
        self.pairs[key] = found
        return found

    def number(self, piece: str) -> int:
        """Id of a piece, a number beyond them for another character, 0 for nothing."""
        found = self.ids.get(piece)
        return found if found is not None else _OTHER + ord(piece) if piece else 0

    def is_cut(self, text: str, p: int) -> bool:
        """Whether a unit begins at place ``p`` of a text."""
        if p == 0:
            return True
        x, y = text[p - 1], text[p] if p < len(text) else "\n"
        if x == "\n" or y == "\n":
            return True
        if x == " " or y == " ":
            return x != " "
        if (x in self.marks) == (y in self.marks):
            return False
        return y not in self.behind if y in self.marks else x not in self.before

    def candidates(self, text: str, end: int) -> Iterator[int]:
        """Lengths of pieces that may end at a place; a character of its own always may."""
        for n in range(min(end, self.tails.get(text[end - 2 : end], 1)), 1, -1):
            if text[end - n : end] in self.ids:
                yield n
        yield 1


def load_pieces(path: str | None = None) -> Pieces:
    """Reads a model file on the driver; by default the public one of 32,000 pieces."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, bytes_of, spelled = {}, {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_of[int(piece[3:5], 16)] = i
            spelled.append(bytes([int(piece[3:5], 16)]))
            continue
        text = piece.replace(MARK, " ")
        spelled.append(b"" if model.is_control(i) or model.is_unknown(i) else text.encode())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[text], scores[text] = i, float(model.get_score(i))
    return Pieces(ids, scores, bytes_of, max(map(len, ids)), spelled)


def _ids(parts: list[str], pieces: Pieces) -> list[int]:
    out: list[int] = []
    for part in parts:
        found = pieces.ids.get(part)
        out += [found] if found is not None else [pieces.bytes_of[x] for x in part.encode()]
    return out


def solve(unit: str, pieces: Pieces) -> list[int]:
    """Ids of a unit: its one path of weight zero, found depth first.

    From a start that is known, each place is reached by one path at most, so a place that
    leads nowhere is never entered again. Longer pieces are tried first.
    """
    ids, heads, pairs = pieces.ids, pieces.heads, pieces.pairs
    size, at, left, before = len(unit), 0, 0, ""
    path: list[tuple[int, str]] = []
    closed: set[int] = set()
    n = min(size, heads.get(unit[:3], 2))
    while at < size:
        while n:
            piece = unit[at : at + n]
            i = ids.get(piece)
            if i is None and n == 1:
                i = _OTHER + ord(piece)
            if i is not None and at + n not in closed:
                key = left << _BITS | i
                good = pairs.get(key)
                if good or (good is None and pieces.paired(key, before, piece)):
                    break
            n -= 1
        if n:
            path.append((i, piece))
            at, left, before = at + n, i, piece
            n = min(size - at, heads.get(unit[at : at + 3], 2))
        else:
            closed.add(at)
            n = len(path.pop()[1])
            at -= n
            left, before = path[-1] if path else (0, "")
            n -= 1
    if max(path)[0] < _OTHER:
        return [i for i, _ in path]
    return _ids([piece for _, piece in path], pieces)


def encode(units: list[str], pieces: Pieces) -> bytes:
    """Ids of units as packed 32-bit integers."""
    return b"".join(map(pieces.solved.__getitem__, units))


def chunks(text: str, size: int, longest: int) -> list[tuple[int, int, str]]:
    """(number, characters before the left border, text) of each chunk, with what its states need to know."""
    full = " " + text
    out = []
    for n, at in enumerate(range(0, len(full), size)):
        low = max(at - 2 * longest, 0)
        out.append((n, at - low, full[low : at + size]))
    return out


#: A state at a border: characters since the last cut, length of the piece before it (0 where a unit begins).
State = tuple[int, int]


def _entries(text: str, border: int, pieces: Pieces) -> list[State]:
    out = []
    for i in range(min(border, pieces.longest - 1) + 1):
        at = border - i
        out += [(i, 0)] if pieces.is_cut(text, at) else [(i, n) for n in pieces.candidates(text, at)]
    return out


def _spread(text: str, start: dict[int, dict[int, int]], border: int, last: int, pieces: Pieces) -> dict[int, dict[int, int]]:
    """Sets of entries (bits) from which each state (place, length of the piece before it) is reached.

    ``start`` has the entries' own states; the first piece of each crosses the border.
    """
    reached = {at: dict(states) for at, states in start.items()}
    for end in range(border + 1, last + 1):
        here: dict[int, int] = {}
        for n in pieces.candidates(text, end):
            at = end - n
            for before, entries in reached.get(at, {}).items():
                if pieces.together(text[at - before : at], text[at:end]):
                    key = 0 if end < len(text) and pieces.is_cut(text, end) else n
                    here[key] = here.get(key, 0) | entries
        if here:
            reached[end] = here
    return reached


def _syncs(text: str, border: int, pieces: Pieces) -> tuple[int, int] | None:
    """First and last place from the border on where a unit begins."""
    places = range(border, len(text))
    first = next((p for p in places if pieces.is_cut(text, p)), None)
    return None if first is None else (first, next(p for p in reversed(places) if pieces.is_cut(text, p)))


def transfer(text: str, border: int, pieces: Pieces) -> list[tuple[int, int, int, int]]:
    """The matrix's zeros: pairs of states at the left and at the right border with a path between them."""
    entries = _entries(text, border, pieces)
    start: dict[int, dict[int, int]] = {}
    for k, (i, n) in enumerate(entries):
        start.setdefault(border - i, {})[n] = 1 << k
    sync = _syncs(text, border, pieces)
    ends = range(len(text), max(len(text) - pieces.longest, border), -1)
    if sync is None:
        reached = _spread(text, start, border, len(text), pieces)
    else:  # all paths meet where a unit begins: what lies between two such places does not matter
        head = _spread(text, start, border, sync[0], pieces).get(sync[0], {}).get(0, 0)
        reached = _spread(text, {sync[1]: {0: head}}, sync[1], len(text), pieces)
    out = []
    for end in ends:
        for n, mask in reached.get(end, {}).items():
            out += [(*entries[k], len(text) - end, n) for k in range(len(entries)) if mask >> k & 1]
    return out


def combine(matrices: list[list[tuple[int, int, int, int]]]) -> list[tuple[State, State]]:
    """States at both borders of each chunk on the one path of weight zero through all of them.

    A state at a right border names the piece before its cut; at the next left border it is 0
    if a unit begins there, which only that chunk sees.
    """
    at: set[State] = {(0, 0)}
    steps = []
    for zeros in matrices:
        moves = [((i, n), (j, m)) for i, n, j, m in zeros if (i, n) in at or (n == 0 and any(k == i for k, _ in at))]
        steps.append(moves)
        at = {b for _, b in moves}
    after = next(s for s in at if s[0] == 0)
    out: list[tuple[State, State]] = []
    for moves in reversed(steps):
        before = next(a for a, b in moves if b == after or (after[1] == 0 and b[0] == after[0]))
        exit_ = next(b for a, b in moves if a == before and (b == after or (after[1] == 0 and b[0] == after[0])))
        out.append((before, exit_))
        after = before
    return out[::-1]


def _walk(text: str, first: int, before: int, border: int, last: int, after: int | None, pieces: Pieces) -> list[str]:
    """Pieces from a cut to another; ``before`` and ``after`` are the lengths of the pieces ending there."""
    came: dict[State, State] = {}
    states = {first: [before]}
    for end in range(border + 1, last + 1):
        for n in pieces.candidates(text, end):
            at = end - n
            for m in states.get(at, ()):
                if pieces.together(text[at - m : at], text[at:end]):
                    states.setdefault(end, []).append(n)
                    came[end, n] = (at, m)
    end = (last, next(n for n in states[last] if after in (None, 0, n))) if last > first else (first, before)
    parts = []
    while end[0] > first:
        parts.append(text[end[0] - end[1] : end[0]])
        end = came[end]
    return parts[::-1]


def trace(text: str, border: int, before: State, after: State, pieces: Pieces) -> bytes:
    """Packed ids of the pieces that end within a chunk, given its states at both borders."""
    first, last = border - before[0], len(text) - after[0]
    sync = _syncs(text, border, pieces)
    if sync is None or sync[0] >= last:
        return np.array(_ids(_walk(text, first, before[1], border, last, after[1], pieces), pieces), "<i4").tobytes()
    low, high = sync
    while high > last:  # the last cut lies before the last unit's beginning only if that is the border
        high = next(p for p in range(high - 1, low - 1, -1) if pieces.is_cut(text, p))
    head = _walk(text, first, before[1], border, low, None, pieces)
    tail = _walk(text, high, 0, high, last, after[1], pieces)
    middle = encode(pieces.units.findall(text[low:high]), pieces)
    return np.array(_ids(head, pieces), "<i4").tobytes() + middle + np.array(_ids(tail, pieces), "<i4").tobytes()


def _encoded(pieces, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is remembered holds no cycles; looking through it for some would cost a third of the time.
        gc.disable()
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            packed = [None if t is None else encode(pieces.value.units.findall(" " + t), pieces.value) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _int_lists(packed)], [*batch.schema.names, "ids"])

    return run


def _int_lists(packed: list[bytes | None]) -> pa.Array:
    ends = np.cumsum([0, *(len(p or b"") // 4 for p in packed)])
    flat = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array([p is None for p in packed]))


def _checked(spelled: list[bytes], place: int, ids_place: int):
    """In place of a decoded text, whether it is the text."""
    decode = _decoded(spelled, ids_place, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode(batches):
            text, decoded = batch.column(place), batch.column(batch.num_columns - 1)
            same = pc.fill_null(pc.equal(text, decoded), False)
            same = pc.or_(same, pc.and_(pc.is_null(text), pc.is_null(decoded)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], same], [*batch.schema.names[:-1], "round_trip"])

    return run


def encode_documents(
    docs: DataFrame, pieces: Pieces, text_col: str = "text", chunk: int = CHUNK, check: bool = False
) -> DataFrame:
    """Adds ``ids`` (array of int) to the documents; null for a null text, empty for none.

    An empty text has one piece, the blank that every text begins with. All rows, repeated or
    not, and all columns stay; a column ``ids`` of the input is replaced. With ``check`` ids are
    decoded again in the same pass, and ``round_trip`` (which replaces such a column too) tells
    whether that gives the text; a null text gives null.
    """
    given = docs.columns
    kept = [c for c in given if c != "ids" and not (check and c == "round_trip")]
    # Names of the steps below never meet those of the input.
    docs = docs.select([column(c).alias(f"c{i}") for i, c in enumerate(kept)])
    text_col = f"c{kept.index(text_col)}"
    added = ["ids", "round_trip"] if check else ["ids"]
    coded = _coded(docs, pieces, text_col, chunk, check)
    return coded.toDF(*kept, *added)


def _coded(docs: DataFrame, pieces: Pieces, text_col: str, chunk: int, check: bool) -> DataFrame:
    spark, place = docs.sparkSession, docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(pieces)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    long = F.length(text_col) > chunk
    encoded, checked = _encoded(shared, place), _checked(pieces.spelled, place, len(docs.columns))
    kind = f"{columns}, ids array<int>" + (", round_trip boolean" if check else "")
    passed = (lambda batches: checked(encoded(batches))) if check else encoded
    short = docs.where(F.coalesce(~long, F.lit(True))).mapInArrow(passed, kind)

    giant = stored(docs.where(long).withColumn("__uid", F.monotonically_increasing_id()), "giants")
    longest = pieces.longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, border, part = zip(*chunks(text, chunk, longest), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid] * len(n), pa.int64()), pa.array(n, pa.int32()), pa.array(border, pa.int32()), pa.array(part)],
                    ["uid", "n", "border", "part"],
                )

    parted = "uid bigint, n int, border int, part string"
    parts = giant.select("__uid", text_col).mapInArrow(cut, parted).repartition("uid", "n")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            border, part = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [np.array(transfer(t, b, shared.value), np.int32).ravel().tolist() for t, b in zip(part, border, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "matrix"])

    moved = stored(parts.mapInArrow(matrices, f"{parted}, matrix array<int>"), "chunks")

    def scan(group: pa.Table) -> pa.Table:
        group = group.sort_by("n")
        found = combine([[tuple(x) for x in np.array(m).reshape(-1, 4).tolist()] for m in group["matrix"].to_pylist()])
        states = pa.array([[*before, *after] for before, after in found], pa.list_(pa.int32()))
        return pa.table({"uid": group["uid"], "n": group["n"], "states": states})

    states = moved.select("uid", "n", "matrix").groupBy("uid").applyInArrow(scan, "uid bigint, n int, states array<int>")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "border", "states")), strict=True)
            packed = [trace(t, b, (s[0], s[1]), (s[2], s[3]), shared.value) for t, b, s in rows]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("n"), _int_lists(packed)], ["uid", "n", "ids"])

    solved = moved.drop("matrix").join(states, ["uid", "n"]).mapInArrow(traced, "uid bigint, n int, ids array<int>")
    whole = solved.groupBy("uid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("n", "ids"))), lambda x: x.ids)).alias("ids"))
    joined = giant.join(whole.withColumnRenamed("uid", "__uid"), "__uid").select(*docs.columns, "ids")
    return short.unionByName(joined.mapInArrow(checked, kind) if check else joined)


def _decoded(spelled: list[bytes], place: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(b"".join(spelled), np.uint8)
        sizes = np.array([len(s) for s in spelled])
        starts = np.cumsum(sizes) - sizes
        for batch in sliced(batches):
            lists = batch.column(place)
            ids, counts = lists.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            width = sizes[ids]
            ends = np.cumsum(width)
            data = flat[np.repeat(starts[ids] - ends + width, width) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
            at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
            texts = [None if x is None else data[a + 1 : b].decode(errors="replace") for x, a, b in zip(lists.is_valid().to_pylist(), at[:-1], at[1:], strict=True) for x in [x or None]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return run


def decode_documents(rows: DataFrame, pieces: Pieces, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text that ``ids`` spell, without the blank that every text begins with."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_decoded(pieces.spelled, rows.columns.index(ids_col), name), f"{columns}, `{name}` string")
