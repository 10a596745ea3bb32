"""Phrases whose words keep company, mined with stripes.

A stripe belongs to a prefix of words (the empty one included) and counts the words that follow
it. Tasks build stripes of portions of texts; stripes of one prefix are merged by adding their
counters. One structure then holds all that is needed: a stripe's entries are the extensions of
its prefix, the entry of the next shorter stripe is the prefix's own total, and the largest entry
of the next longer stripe tells whether a phrase is subsumed.

Stripes are built level by level. A phrase can only be frequent if the phrases of one word less
at its start and end are, so a level looks only at places where both are, according to a table
of bytes by hash that comes from the level before. The table has a bounded size and goes to all
tasks; two phrases that share a byte only let a rare one through, which its exact count then
drops. The byte also says into how many parts the stripe of a phrase is split (by hash of the next
word), so that a part receives about ``PART`` counts however frequent its prefix is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.llm.common import column, stored, union_all
from callmeter.llm.words import Words, mixed, split_words

#: Bytes that end a piece, and those that only end a word.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LEAST, LONGEST, SHARE, FIRST = 10, 3, 50, 2000
#: Bytes of one language that are counted at once; longer texts are cut between words.
PORTION = 4 << 20
#: Words of stripes that are merged at once.
MERGED_WORDS = 1 << 18
#: Counts that a part of a stripe receives, about; parts of the empty prefix are 2 to this power.
PART, EMPTY_PARTS = 1 << 16, 10
#: Bytes of the table of frequent phrases: eight for each, within these bounds (as powers of two).
SMALLEST, LARGEST = 16, 24

_STRIPES = "lang string, prefix string, part int, nexts string, counts array<bigint>"


def _hash(text: str | bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, words), np.uint64, len(words))


def _onward(so_far: np.ndarray | np.uint64, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word, from theirs."""
    return mixed(so_far * np.uint64(0x9E3779B97F4A7C15) + word)


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(size - 1)).astype(np.int64)


def _cut(text: bytes, most: int, overlap: int) -> Iterator[bytes]:
    """The text in portions cut between words, each led by the last ``overlap`` words before it.

    A phrase of one word more is then whole in exactly one portion.
    """
    at, back, ends = 0, 0, BLANKS + BREAKS
    while len(text) - at > most:
        end = at + most
        while end < len(text) and text[end] not in ends:
            end += 1
        yield text[back:end]
        at = back = end
        for _ in range(overlap):
            while back and text[back - 1] in ends:
                back -= 1
            while back and text[back - 1] not in ends:
                back -= 1
    yield text[back:]


def _portions(batches: Iterator[pa.RecordBatch], most: int, level: int) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time; of all languages, about ``most`` bytes are held."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            if (whole := text.as_buffer()) is None:
                continue
            for some in _cut(whole.to_pybytes(), most // 2, level):
                held.setdefault(lang, []).append(some)
                size[lang] = size.get(lang, 0) + len(some)
                if sum(size.values()) >= most:  # the fullest goes, and leaves room for the others
                    fullest = max(size, key=size.get)
                    del size[fullest]
                    yield fullest, held.pop(fullest)
    yield from held.items()


def _places(words: Words, phrases: np.ndarray, level: int, frequent: np.ndarray | None) -> np.ndarray:
    """Places from which ``level + 1`` words of one piece are worth counting."""
    n = max(0, len(words.codes) - level)
    good = words.piece[level:] == words.piece[:n]
    if frequent is not None:
        known = frequent[_slots(phrases, len(frequent))] > 0
        good &= known[:-1] & known[1:]
    return np.flatnonzero(good)


def _joined(words: pa.Array, offsets: np.ndarray) -> pa.Array:
    """Words of each group joined by one space."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.cast(pa.string())), " ")


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Offsets of the stretches of equal keys."""
    n = len(keys[0])
    changed = np.ones(n, bool)
    changed[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(changed), n)


def _local_stripes(lang: str, texts: list[bytes], level: int, frequent: np.ndarray | None) -> pa.RecordBatch | None:
    """Stripes of the prefixes of ``level`` words in some texts."""
    words = split_words(texts, BLANKS, BREAKS, lower=True)
    hashes, codes = _hashes(words.vocabulary.to_pylist()), words.codes.astype(np.int64)
    starts = max(0, len(codes) - level + 1)
    phrases = np.full(starts, _hash(lang), np.uint64)
    for j in range(level):
        phrases = _onward(phrases, hashes[codes[j : j + starts]])
    at = _places(words, phrases, level, frequent)
    if not len(at):
        return None
    size, prefix = len(hashes), np.zeros(len(at), np.int64)
    for j in range(level):
        prefix = prefix * size + codes[at + j]
        if j:
            prefix = np.unique(prefix, return_inverse=True)[1]
    entries, first, counts = np.unique(prefix * size + codes[at + level], return_index=True, return_counts=True)
    prefix, after, place = entries // size, entries % size, at[first]
    if level:
        depth = frequent[_slots(phrases[place], len(frequent))] - np.uint8(1)
        mask = (np.uint64(1) << depth.astype(np.uint64)) - np.uint64(1)
    else:
        mask = np.uint64((1 << EMPTY_PARTS) - 1)
    part = (hashes[after] & mask).astype(np.int64)
    order = np.lexsort((part, prefix))
    offsets = _groups(prefix[order], part[order])
    place, part = place[order][offsets[:-1]], part[order][offsets[:-1]]
    leading = codes[(place[:, None] + np.arange(level)).ravel()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(place)),
            _joined(words.vocabulary.take(pa.array(leading)), np.arange(len(place) + 1) * level),
            pa.array(part, pa.int32()),
            _joined(words.vocabulary.take(pa.array(after[order])), offsets),
            _lists(counts[order], offsets),
        ],
        ["lang", "prefix", "part", "nexts", "counts"],
    )


def _striped(level: int, frequent: np.ndarray | None, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _portions(batches, most, level):
            if (out := _local_stripes(lang, texts, level, frequent)) is not None:
                for at in range(0, out.num_rows, 4096):
                    yield out.slice(at, 4096)

    return run


def _merged(least: int, keep_all: bool):
    """Adds up the stripes of each key, which come one after the other; a stripe's part is held at most."""

    def summed(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        langs, prefixes, parts = rows["lang"].to_numpy(), rows["prefix"].to_numpy(), rows["part"].to_numpy()
        groups = _groups(langs, prefixes, parts)
        words = split_words([b.as_buffer().to_pybytes() for b in rows["nexts"]], b" ", b"")
        key = np.repeat(np.arange(len(groups) - 1), np.diff(groups))[words.text]
        counts = rows["counts"].combine_chunks().flatten().to_numpy()
        mixed_key = key * len(words.vocabulary) + words.codes
        order = np.argsort(mixed_key, kind="stable")
        first = _groups(mixed_key[order])
        sums = np.add.reduceat(counts[order], first[:-1])
        at = order[first[:-1]]
        return rows.take(pa.array(groups[:-1])).select(["lang", "prefix", "part"]), key[at], sums, words.vocabulary, words.codes[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key = None
        for batch in _with_end(batches):
            tables = [t for t in (open_key, batch and pa.Table.from_batches([batch])) if t is not None and t.num_rows]
            if not tables:
                continue
            names, key, sums, vocabulary, codes = summed(pa.concat_tables(tables))
            keys = names.num_rows
            offsets = np.searchsorted(key, np.arange(keys + 1))
            done = keys if batch is None else keys - 1
            open_key = None
            if batch is not None:
                last = slice(offsets[-2], offsets[-1])
                n = np.array([0, offsets[-1] - offsets[-2]])
                open_key = names.slice(done).append_column("nexts", _joined(vocabulary.take(pa.array(codes[last])), n))
                open_key = open_key.append_column("counts", _lists(sums[last], n))
            if not done:
                continue
            total = np.add.reduceat(sums[: offsets[done]], offsets[:done])
            enough = np.flatnonzero((sums >= least) & (key < done))
            offsets = np.searchsorted(key[enough], np.arange(done + 1))
            nexts = vocabulary.take(pa.array(codes[enough])).cast(pa.string())
            columns = [
                *(names.slice(0, done)[c].combine_chunks() for c in ("lang", "prefix")),
                pa.array(total),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nexts),
                _lists(sums[enough], offsets),
            ]
            out = pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "total", "nexts", "counts"])
            yield out if keep_all else out.filter(pa.array(np.diff(offsets) > 0))

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches in slices of about ``MERGED_WORDS`` words or a single stripe, and an end mark."""
    for batch in batches:
        words = np.cumsum(batch.column("counts").value_lengths().to_numpy())
        at = 0
        while at < batch.num_rows:
            before = words[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(words, before + MERGED_WORDS, side="right")))
            yield batch.slice(at, end - at)
            at = end
    yield None


def _marks(size: int):
    """A byte of the table for each frequent phrase: one more than the power of two of its stripe's parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("counts")
            lengths = np.asarray(counts.value_lengths())
            begun = np.zeros(batch.num_rows, np.uint64)
            for i, (lang, prefix) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("prefix").to_pylist(), strict=True)):
                so_far = np.array([_hash(lang)], np.uint64)
                for word in prefix.split(" ") if prefix else ():
                    so_far = _onward(so_far, _hashes([word.encode()]))
                begun[i] = so_far[0]
            words = batch.column("nexts").flatten().cast(pa.binary()).to_pylist()
            phrases = _onward(np.repeat(begun, lengths), _hashes(words))
            depth = np.ceil(np.log2(np.maximum(counts.flatten().to_numpy() / PART, 1.0))).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_slots(phrases, size).astype(np.int32)), pa.array(depth + np.int8(1))], ["slot", "mark"]
            )

    return run


def _frequent(stripes: DataFrame) -> np.ndarray:
    """The table of bytes of the phrases that the stripes hold; of a size within fixed bounds."""
    found = stripes.agg(F.sum(F.size("counts"))).first()[0] or 0
    power = min(max((8 * found).bit_length(), SMALLEST), LARGEST)
    marks = stripes.select("lang", "prefix", "nexts", "counts").mapInArrow(_marks(1 << power), "slot int, mark tinyint")
    marks = marks.groupBy("slot").agg(F.max("mark").alias("mark"))

    def block(rows: pa.Table) -> pa.Table:
        slots = rows["slot"].to_numpy()
        out = np.zeros(1 << 12, np.uint8)
        out[slots & 0xFFF] = rows["mark"].to_numpy()
        return pa.table({"block": pa.array([slots[0] >> 12], pa.int32()), "marks": pa.array([out.tobytes()], pa.binary())})

    blocks = marks.groupBy(F.expr("slot >> 12")).applyInArrow(block, "block int, marks binary")
    table = np.zeros(1 << power, np.uint8)
    for row in blocks.toLocalIterator():
        table[row["block"] << 12 : (row["block"] + 1) << 12] = np.frombuffer(row["marks"], np.uint8)
    return table


def stripes_by_level(texts: DataFrame, longest: int = LONGEST, least: int = LEAST, portion: int = PORTION) -> list[DataFrame]:
    """Merged stripes of the prefixes of 0, 1, ... words, each level stored.

    ``texts`` has ``lang`` and ``text``. A stripe has ``lang``, ``prefix``, ``total`` (all its counts) and
    the entries of ``least`` or more, ``nexts`` and ``counts``. The stripe of a very frequent prefix is
    in several rows with different words.
    """
    levels, frequent = [], None
    for level in range(longest):
        local = texts.mapInArrow(_striped(level, frequent, portion), _STRIPES)
        dealt = local.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
        kind = "lang string, prefix string, total bigint, nexts array<string>, counts array<bigint>"
        levels.append(stored(dealt.mapInArrow(_merged(least, level == 0), kind), "stripes"))
        if level + 1 < longest:
            frequent = _frequent(levels[-1])
    return levels


def _words(phrase: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, n), " ")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    first: int = FIRST,
    portion: int = PORTION,
) -> DataFrame:
    """The ``first`` phrases of each language whose words keep company most.

    A-Z are lower-cased; texts are cut into pieces at ``.,;:!?`` and line separators, pieces into
    words at spaces and tabs. Candidates are phrases of 2 to ``longest`` words that occur ``least``
    times (``a``) or more within pieces. Cutting one after its first words gives the counts ``l``
    and ``r`` of both parts and the score floor(1,000,000 a a / (l r)); the cut of the lowest
    score counts, the first one on ties. A candidate goes if its words lie within a longer
    candidate that occurs at least ``share`` percent as often. By score, then ``a`` (both
    falling), then phrase (by UTF-8 bytes); ``n`` is the number of words of the language.

    Returns ``lang`` (null: ``und``), ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``. Null and
    empty texts hold no words; repeated rows count as often as they occur; other columns are
    not read. Counts may reach 10^16; products are exact decimals of 38 digits.
    """
    texts = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"), column(text_col).cast("string").alias("text"))
    levels = stripes_by_level(texts, longest, least, portion)
    entry = F.explode(F.arrays_zip("nexts", "counts")).alias("entry")
    phrases = union_all([s.select("lang", F.lit(i + 1).alias("words"), "prefix", entry) for i, s in enumerate(levels)])
    phrase = F.when(F.col("prefix") == "", F.col("entry.nexts")).otherwise(F.concat_ws(" ", "prefix", "entry.nexts"))
    phrases = stored(phrases.select("lang", "words", phrase.alias("phrase"), F.col("entry.counts").alias("a")), "phrases")
    sizes = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))

    # Words lie within a longer candidate if they do within one that is a word longer, which occurs as often at least.
    longer = phrases.where("words > 2").select(
        "lang",
        F.explode(F.array(*(_words(F.col("phrase"), i, F.col("words") - 1) for i in (1, 2)))).alias("phrase"),
        F.col("a").alias("longer"),
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = phrases.where("words > 1").join(longer, ["lang", "phrase"], "left")
    kept = kept.where((F.coalesce("longer", F.lit(0)) * 100 < F.col("a") * share)).drop("longer")

    k = F.col("k")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _words(F.col("phrase"), F.lit(1), k).alias("left"), _words(F.col("phrase"), k + 1, F.col("words") - k).alias("right")
    )
    count = lambda part, name: phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    whole = lambda name: F.col(name).cast("decimal(16,0)")
    top, bottom = (F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a"))), whole("l") * whole("r")
    cuts = cuts.withColumns({"top": top, "bottom": bottom}).withColumn("score", F.expr("top div bottom"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
