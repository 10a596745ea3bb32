"""Decontamination: edits of every kind are found, and blocks change nothing."""

import random
import tracemalloc

import numpy as np

from callmeter.llm import decontaminate


def edited(rng, text, n):
    """A text with ``n`` letters put in, taken out or changed."""
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice("xyzq"))
        elif kind == 1:
            del out[at]
        else:
            out[at] = rng.choice("xyzq")
    return "".join(out)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def test_insertions_deletions_and_changes_are_found(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, 12)) for i in range(30)]
    docs = []
    for i, text in items:
        docs += [(1000 + i, prose(rng, 40) + " " + edited(rng, text, max(0, len(text) // 20)) + " " + prose(rng, 40))]
    docs += [(5000 + k, prose(rng, 90)) for k in range(60)]
    found = decontaminate.matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1000 + i, i) for i, _ in items}


def least_edits(pattern: bytes, text: bytes) -> int:
    """Fewest edits of the pattern against any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edits_are_the_fewest(spark):
    rng = random.Random(3)
    for _ in range(40):
        item = prose(rng, 9)[: rng.randrange(20, 75)].strip()
        text = decontaminate.plain((prose(rng, 6) + " " + edited(rng, item, rng.randrange(0, len(item) // 14 + 1)) + " " + prose(rng, 6)).encode())
        index = decontaminate.build_index([(0, item.encode())])
        seen = np.zeros(1 << decontaminate._BITS, bool)
        seen[decontaminate._slot(index.grams)] = True
        truth = min(least_edits(s, text) for s in index.segments)
        hits = list(decontaminate.search([text], index, seen))
        assert len(hits) == (truth <= int(index.budget.max()))
        assert not hits or hits[0][2] == truth


def test_blocks_of_items_change_nothing(spark):
    rng = random.Random(5)
    texts = [prose(rng, 12) for _ in range(24)]
    items = [(i // 2, t) for i, t in enumerate(texts[:16])] + [(None, t) for t in texts[16:]] + [(3, texts[6]), (None, texts[20]), (99, None), (98, "")]
    docs = [(i, prose(rng, 10) + " " + " ".join(rng.sample(texts, 6))) for i in range(40)] + [(None, texts[0]), (7, texts[0]), (8, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = [
        sorted(map(str, map(tuple, decontaminate.matches(table, benchmark, block_chars=size).collect())))
        for size in (4_000_000, 700, 60)
    ]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 150
    left = [sorted(str(r.doc_id) for r in decontaminate.without_benchmark(table, benchmark, block_chars=size).collect()) for size in (4_000_000, 60)]
    assert left[0] == left[1] == ["8"]


def test_looking_up_places_takes_little_memory_and_misses_none(monkeypatch):
    rng = random.Random(4)
    item = prose(rng, 30).encode()
    index = decontaminate.build_index([(7, item)])
    seen = np.zeros(1 << 22, bool)
    seen[decontaminate._slot(index.grams)] = True
    text = np.frombuffer(b"0123456789" * 200_000 + item + b"0123456789" * 200_000, np.uint8)
    tracemalloc.start()
    try:
        found = decontaminate.candidates(text, index, seen)
        assert tracemalloc.get_traced_memory()[1] < 4 * len(text)
    finally:
        tracemalloc.stop()
    assert len(found[0])
    monkeypatch.setattr(decontaminate, "_PLACES", 7)
    short = text[1_999_000:2_001_000]
    few = decontaminate.candidates(short, index, seen)
    monkeypatch.setattr(decontaminate, "_PLACES", 1 << 30)
    for a, b in zip(few, decontaminate.candidates(short, index, seen), strict=True):
        assert np.array_equal(a, b)
    assert not len(decontaminate.candidates(text[:3], index, seen)[0])
