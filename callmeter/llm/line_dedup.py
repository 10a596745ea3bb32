"""Line deduplication by a tree of log templates.

The tree has a fixed depth: a line's number of tokens, then its first three tokens (those
with a digit count as variable), lead to a leaf. Within a leaf a token stays part of the
template if enough documents have it at its place; other tokens are variable fields. How
many are enough is tried from ``min_docs`` on in steps of two: where values of a field recur
too, a line falls back to a more general template. A template recurs if lines of it stand in
``min_docs`` documents or more; so do lines that stand there as they are, whatever their
tokens, and lines of ``LONG_WORDS`` words in ``LONG_DOCS`` documents. Such lines are dropped,
but for those in the first of these documents, so no content is lost entirely.

Only lines in leaves that recur at all are shuffled, and leaves are counted within tasks
first. A leaf whose distinct lines have ``LEAF_TOKENS`` tokens at most meets in one group, where
its templates are found on arrays; so its lines move, not their tokens. The tokens of larger
leaves are counted by place with joins, which gives the same templates. What the last pass needs
to know goes to all tasks if it is small: the names of the lines to drop, not the lines. Beyond a
limit these names are joined to the documents instead.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.llm.common import sliced, stored
from callmeter.llm.words import split_words

DEPTH = 3
MIN_DOCS = 10
MIN_FIXED = 0.6
#: Lines of so many words or more go if they recur as they are in so many documents.
LONG_WORDS, LONG_DOCS = 50, 2
VARIABLE = "<*>"
#: Leaves, and names of lines to drop (24 bytes each), that go to all tasks; beyond it they are joined.
LEAF_LIMIT, LINE_LIMIT = 1_000_000, 1_000_000
#: Tokens of the distinct lines of a leaf whose templates are found in one group.
LEAF_TOKENS = 2_000_000
_DIGITS = b"0123456789"


def _tokens(line: bytes) -> list[bytes]:
    return line.split()


def leaf(tokens: list[bytes]) -> int:
    lead = [VARIABLE.encode() if any(d in t for d in _DIGITS) else t for t in tokens[:DEPTH]]
    return xxhash.xxh64_intdigest(b"\x1f".join([str(len(tokens)).encode(), *lead])) - 2**63


def _leaf_counts(batches: Iterator[pa.RecordBatch], long_words: int) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[int, bool]] = Counter()
    for batch in sliced(batches):
        for text in batch.column(0).cast(pa.binary()):
            lines = {tuple(t) for line in set((text.as_py() or b"").split(b"\n")) if (t := _tokens(line))}
            counts.update({(leaf(list(t)), len(t) >= long_words) for t in lines})
        if len(counts) > 500_000:
            yield _counted(counts)
            counts.clear()
    yield _counted(counts)


def _counted(counts: Counter[tuple[int, bool]]) -> pa.RecordBatch:
    leaves, long = [c[0] for c in counts], [c[1] for c in counts]
    return pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(long, pa.bool_()), pa.array(list(counts.values()), pa.int64())], ["leaf", "long", "docs"])


#: Kinds of leaves: only verbatim lines may recur there, or templates too.
_EXACT, _TEMPLATED = 0, 1


def _lines_in(leaves: dict[int, int] | None):
    """Lines of each document, once each, of the leaves given (all, of a kind not known yet)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            row, leaves_of, kinds, lines = [], [], [], []
            for n, text in enumerate(batch.column(1).cast(pa.binary())):
                for tokens in {tuple(_tokens(line)) for line in set((text.as_py() or b"").split(b"\n"))}:
                    if not tokens:
                        continue
                    place = leaf(list(tokens))
                    if leaves is None or place in leaves:
                        row.append(n)
                        leaves_of.append(place)
                        kinds.append(leaves[place] if leaves is not None else _EXACT)
                        lines.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(leaves_of, pa.int64()), pa.array(kinds, pa.int32()), pa.array(lines, pa.string())],
                ["doc", "leaf", "kind", "line"],
            )

    return run


_TEMPLATES = "leaf bigint, key bigint, docs bigint, fixed int, template string"


def _templates_of_leaf(min_docs: int, min_fixed: float):
    """Templates of each line of one leaf, from the most specific to the most general."""

    def run(lines: pa.Table) -> pa.Table:
        words = split_words([b.as_buffer().to_pybytes() for b in lines["line"]], b" ", b"")
        docs, sizes = lines["docs"].to_numpy(), np.bincount(words.text, minlength=lines.num_rows)
        vocabulary = words.vocabulary.to_pylist()
        plain = np.array([not any(d in t for d in _DIGITS) for t in vocabulary], bool)
        out: dict[str, list] = {"row": [], "fixed": [], "template": []}
        for width in np.unique(sizes):  # one, but for leaves whose names are the same by chance
            rows = np.flatnonzero(sizes == width)
            codes = words.codes[np.isin(words.text, rows)].reshape(len(rows), width)
            cells, inverse = np.unique(np.arange(width) * len(vocabulary) + codes, return_inverse=True)
            support = np.zeros(len(cells), np.int64)
            np.add.at(support, inverse.ravel(), np.repeat(docs[rows], width))
            times = (support // min_docs)[inverse.reshape(codes.shape)]
            level = np.where((times > 0) & plain[codes], np.frexp(times.astype(np.float64))[1] - 1, -1)
            least = math.ceil(width * min_fixed)
            for at in np.unique(level[level >= 0]):
                stays = level >= at
                count = stays.sum(1)
                for i in np.flatnonzero((level == at).any(1) & (count >= least)):
                    out["row"].append(rows[i])
                    out["fixed"].append(count[i])
                    out["template"].append(" ".join([vocabulary[c].decode() if s else VARIABLE for c, s in zip(codes[i], stays[i], strict=True)]))
        taken = lines.take(pa.array(out["row"], pa.int64()))
        return pa.table(
            [taken["leaf"], taken["key"], taken["docs"], pa.array(out["fixed"], pa.int32()), pa.array(out["template"], pa.string())],
            ["leaf", "key", "docs", "fixed", "template"],
        )

    return run


def _templates_by_joins(lines: DataFrame, min_docs: int, min_fixed: float) -> DataFrame:
    """The same, for leaves of any size: the tokens of a place are counted wherever they are."""
    tokens = lines.select("leaf", "key", "docs", F.size(F.split("line", " ")).alias("words"), F.posexplode(F.split("line", " ")).alias("place", "token"))
    common = tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs)
    common = common.withColumn("level", F.length(F.bin(F.expr(f"support div {min_docs}"))) - 1)
    fixed = tokens.where(~F.col("token").rlike("[0-9]")).join(common, ["leaf", "place", "token"])
    kept = fixed.groupBy("leaf", "key").agg(F.collect_list(F.struct("place", "token", "level")).alias("kept"), F.first("words").alias("words"), F.first("docs").alias("docs"))
    least = F.ceil(F.col("words") * min_fixed)
    # From the most specific template to the most general: tokens of a level and above stay.
    kept = kept.where(F.size("kept") >= least).withColumn("from", F.explode(F.array_distinct(F.transform("kept", lambda x: x["level"]))))
    kept = kept.withColumn("kept", F.filter("kept", lambda x: x["level"] >= F.col("from"))).where(F.size("kept") >= least)
    kept = kept.withColumn("map", F.map_from_entries(F.transform("kept", lambda x: F.struct(x["place"], x["token"]))))
    template = F.transform(F.sequence(F.lit(0), F.col("words") - 1), lambda i: F.coalesce(F.col("map")[i], F.lit(VARIABLE)))
    return kept.select("leaf", "key", "docs", F.size("kept").alias("fixed"), F.array_join(template, " ").alias("template"))


def recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_fixed: float = MIN_FIXED,
    leaf_limit: int = LEAF_LIMIT,
    long_words: int = LONG_WORDS,
    leaf_tokens: int = LEAF_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """Lines of recurring templates (``leaf``, ``key``, ``line``, ``template``, ``docs``, ``first``) and who holds which (``doc``, ``leaf``, ``key``)."""
    named, held, distinct, by_hash = _recurring_names(docs, id_col, text_col, min_docs, min_fixed, leaf_limit, long_words, leaf_tokens)
    found = named.join(distinct.select("leaf", "key", "line"), ["leaf", "key"])
    found = found.join(by_hash.select("leaf", "key", "template", "text"), ["leaf", "key", "template"], "left")
    text = F.coalesce("text", "line").alias("template")
    return stored(found.select("leaf", "key", "line", text, "docs", "first"), "templates"), held


def _recurring_names(
    docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_fixed: float, leaf_limit: int, long_words: int, leaf_tokens: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Recurring lines by name (``leaf``, ``key``, ``template``, ``docs``, ``first``), who holds which, and the texts of lines and of templates."""
    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(lambda batches: _leaf_counts(batches, long_words), "leaf bigint, long boolean, docs bigint")
    leaves = counted.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.max("long").alias("long"))
    leaves = leaves.where(F.col("docs") >= F.when(F.col("long"), LONG_DOCS).otherwise(min_docs))
    templated = F.when(F.col("docs") >= min_docs, _TEMPLATED).otherwise(_EXACT)
    leaves = stored(leaves.select("leaf", templated.alias("kind")), "leaves")
    kind = docs.schema[id_col].dataType.simpleString()
    rows, schema = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), f"doc {kind}, leaf bigint, kind int, line string"
    if leaves.count() <= leaf_limit:
        known = {r["leaf"]: r["kind"] for r in leaves.collect()}
        held = rows.mapInArrow(_lines_in(known), schema)
    else:
        held = rows.mapInArrow(_lines_in(None), schema).drop("kind").join(leaves, "leaf")
    # Beyond this table a line goes by its hash within its leaf: 128 bits in all.
    held = stored(held.select("doc", "leaf", "kind", F.xxhash64("line").alias("key"), "line"), "lines")

    distinct = stored(held.groupBy("leaf", "kind", "key").agg(F.first("line").alias("line"), F.count("*").alias("docs")), "lines")
    held = held.select("doc", "leaf", "key")
    words = F.size(F.split("line", " "))
    tried = distinct.where(F.col("kind") == _TEMPLATED).select("leaf", "key", "docs", "line")
    large = tried.groupBy("leaf").agg(F.sum(words).alias("tokens")).where(F.col("tokens") > leaf_tokens)
    large = stored(large.select("leaf"), "leaves")
    if n := large.count():
        listed = F.broadcast(large) if n <= leaf_limit else large
        templates = _templates_by_joins(tried.join(listed, "leaf", "left_semi"), min_docs, min_fixed)
        tried = tried.join(listed, "leaf", "left_anti")
        templates = templates.union(tried.groupBy("leaf").applyInArrow(_templates_of_leaf(min_docs, min_fixed), _TEMPLATES))
    else:
        templates = tried.groupBy("leaf").applyInArrow(_templates_of_leaf(min_docs, min_fixed), _TEMPLATES)
    templates = stored(templates, "templates")
    # From here on a template goes by its hash within its leaf, as lines do.
    by_hash = templates.withColumn("text", F.col("template")).withColumn("template", F.xxhash64("template"))
    likely = by_hash.groupBy("leaf", "template").agg(F.sum("docs").alias("most")).where(F.col("most") >= min_docs)
    named = by_hash.join(likely, ["leaf", "template"], "left_semi").select("leaf", "key", "template", "fixed", F.lit(min_docs).alias("least"))
    # Lines that recur as they are need no fixed tokens; long ones recur in two documents.
    need = F.when(words >= long_words, LONG_DOCS).otherwise(min_docs)
    exact = distinct.where(F.col("docs") >= need).select("leaf", "key", F.col("key").alias("template"), F.lit(0).alias("fixed"), need.alias("least"))
    named = stored(named.union(exact), "templates")
    # A document counts once for a template, however many lines of it it holds.
    group = ["leaf", "template", (F.col("fixed") == 0).alias("exact")]
    spread = held.join(named, ["leaf", "key"]).select(*group, "least", "doc").distinct()
    spread = spread.groupBy("leaf", "template", "exact").agg(F.count("*").alias("docs"), F.min("doc").alias("first"), F.first("least").alias("least"))
    spread = spread.where(F.col("docs") >= F.col("least")).drop("least")
    named = named.select("key", "fixed", *group).join(spread, ["leaf", "template", "exact"])
    # A line goes by its most specific template that recurs.
    named = named.groupBy("leaf", "key").agg(F.max(F.struct("fixed", "template", "docs", "first")).alias("best")).select("leaf", "key", "best.template", "best.docs", "best.first")
    return stored(named, "templates"), held, distinct, by_hash


def _key(words: list[bytes]) -> int:
    """A line's name within its leaf, as Spark's ``xxhash64`` gives it."""
    key = xxhash.xxh64_intdigest(b" ".join(words), 42)
    return key - 2**64 if key >= 2**63 else key


class _Recurring:
    """Lines to drop by name, and the document that keeps each: 16 bytes a line and an id."""

    def __init__(self, lines: pa.Table):
        lines = lines.combine_chunks().sort_by("key")
        self.keys, self.leaves = (lines[c].to_numpy() for c in ("key", "leaf"))
        self.first = lines["first"].combine_chunks()

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where the first line of each key is, -1 if there is none."""
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == keys[found]
        return np.where(found, at, -1)

    def goes(self, at: int, words: list[bytes], doc: object) -> bool:
        """Whether the line is one of those of its key, from place ``at`` on, and is kept by another document."""
        key, place = self.keys[at], leaf(words)
        while at < len(self.keys) and self.keys[at] == key:
            if self.leaves[at] == place:
                return doc is None or self.first[at].as_py() != doc
            at += 1
        return False


def _rewritten(texts: pa.Array, ids: pa.Array, lines: _Recurring) -> list[tuple[bytes | None, int, int, bool]]:
    """Texts without the lines to drop, lines before, lines dropped, whether a text lost all its words."""
    held = [None if t is None else t.split(b"\n") for t in texts.to_pylist()]
    keys = np.array([_key(line.split()) for of in held for line in of or ()], np.int64)
    return _left(held, lines.places(keys), lambda n, at, words: lines.goes(at, words, ids[n].as_py()))


def _rewritten_by_lists(texts: pa.Array, drops: pa.ListArray) -> list[tuple[bytes | None, int, int, bool]]:
    """The same, where each row brings the names of the lines it loses."""
    held = [None if t is None else t.split(b"\n") for t in texts.to_pylist()]
    gone = [{(d["leaf"], d["key"]) for d in of or ()} for of in drops.to_pylist()]
    keys = [{key for _, key in of} for of in gone]
    places = np.array([0 if known and _key(line.split()) in known else -1 for of, known in zip(held, keys, strict=True) for line in of or ()], np.int64)
    return _left(held, places, lambda n, at, words: (leaf(words), _key(words)) in gone[n])


def _left(held: list[list[bytes] | None], places: np.ndarray, goes) -> list[tuple[bytes | None, int, int, bool]]:
    """What is left of each text's lines; only lines that have a place may go."""
    out, at = [], 0
    for n, of in enumerate(held):
        if of is None:
            out.append((None, 0, 0, False))
            continue
        here = places[at : at + len(of)].tolist()
        at += len(of)
        kept = [line for line, place in zip(of, here, strict=True) if place < 0 or not goes(n, place, line.split())]
        gone = len(of) - len(kept)
        out.append((b"\n".join(kept), len(of), gone, gone > 0 and not any(line.strip() for line in kept)))
    return out


def without_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_fixed: float = MIN_FIXED,
    leaf_limit: int = LEAF_LIMIT,
    line_limit: int = LINE_LIMIT,
    leaf_tokens: int = LEAF_TOKENS,
) -> DataFrame:
    """The documents without lines of recurring templates.

    All columns stay, with the text rewritten, and ``__lines``, ``__dropped`` and
    ``__emptied`` (nothing but white space is left of a text that lost lines) are added.
    Lines are compared by their tokens, so blanks around and between them don't count; lines
    without a token are kept. The first document, by id, keeps its lines; rows that repeat
    its id keep them too, a row without an id loses them. Null and empty texts stay as they
    are.
    """
    lines, held, *_ = _recurring_names(docs, id_col, text_col, min_docs, min_fixed, leaf_limit, LONG_WORDS, leaf_tokens)
    place, key = docs.columns.index(text_col), docs.columns.index(id_col)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = f"{columns}, __lines int, __dropped int, __emptied boolean"

    def renewed(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        columns = list(batch.columns[: len(docs_columns)])
        columns[place] = pa.array([f[0] for f in found], pa.binary()).cast(pa.string())
        counts = [pa.array([f[n] for f in found], kind) for n, kind in ((1, pa.int32()), (2, pa.int32()), (3, pa.bool_()))]
        return pa.RecordBatch.from_arrays([*columns, *counts], [*docs_columns, "__lines", "__dropped", "__emptied"])

    docs_columns = docs.columns
    lines = lines.select("leaf", "key", "first")
    if lines.count() <= line_limit:
        shared = docs.sparkSession.sparkContext.broadcast(_Recurring(lines.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                yield renewed(batch, _rewritten(batch.column(place).cast(pa.binary()), batch.column(key), shared.value))

        return docs.mapInArrow(run, schema)

    # Names of lines move to the documents, not lines. A row without an id loses all of them.
    drop = held.join(lines, ["leaf", "key"]).where(F.coalesce(F.col("doc") != F.col("first"), F.lit(True)))
    drop = drop.groupBy("doc").agg(F.collect_set(F.struct("leaf", "key")).alias("__drop"))
    joined = docs.join(drop, docs[id_col].eqNullSafe(drop["doc"]), "left").drop(drop["doc"])

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield renewed(batch, _rewritten_by_lists(batch.column(place).cast(pa.binary()), batch.column(len(docs_columns))))

    return joined.mapInArrow(run_joined, schema)
