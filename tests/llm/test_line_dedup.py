"""Line dedup against its rules told plainly, over random lines of a few patterns."""

import math
import random
from collections import defaultdict

import pytest

from callmeter.llm import line_dedup


def brute(rows, min_docs, min_fixed=0.6):
    """Texts that are left, by the rules: all templates of all lines, in dictionaries."""
    digit = lambda t: any(c in "0123456789" for c in t)
    holders = defaultdict(set)  # documents of each distinct line
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if line.split():
                holders[tuple(line.split())].add(doc)
    leaf = lambda t: (len(t), tuple("<*>" if digit(x) else x for x in t[:3]))
    support = defaultdict(int)
    for t, docs in holders.items():
        for place, x in enumerate(t):
            support[leaf(t), place, x] += len(docs)
    templates = defaultdict(dict)  # of each line: template -> fixed tokens, or None where it stands as it is
    for t in holders:
        found = {}
        for place, x in enumerate(t):
            if not digit(x) and support[leaf(t), place, x] >= min_docs:
                found[place] = int(math.log2(support[leaf(t), place, x] // min_docs) + 1e-9)
        for low in set(found.values()):
            kept = [p for p in found if found[p] >= low]
            if len(kept) >= math.ceil(len(t) * min_fixed):
                templates[t][leaf(t), tuple(x if p in kept else "<*>" for p, x in enumerate(t))] = len(kept)
    users = defaultdict(set)
    for t, of in templates.items():
        for template in of:
            users[template] |= holders[t]
    first = {}
    for t, docs in holders.items():
        best = [(fixed, template, min(users[template])) for template, fixed in templates[t].items() if len(users[template]) >= min_docs]
        if best:
            first[t] = max(best)[2]
        elif len(docs) >= (2 if len(t) >= 50 else min_docs):
            first[t] = min(docs)
    keep = lambda doc, line: first.get(tuple(line.split()), doc) == doc
    return {doc: "\n".join(x for x in text.split("\n") if keep(doc, x)) for doc, text in rows}


@pytest.mark.parametrize("leaf_tokens", [500_000, 0, 400])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_the_rules(spark, seed, leaf_tokens):
    rng = random.Random(seed)
    word = lambda n=6: rng.choice("abcdefghijklmnop"[:n]) * 2
    patterns = [
        lambda: f"By {word(9)} {word()} for our readers today",
        lambda: f"Page {rng.randrange(30)} of {rng.randrange(4)}",
        lambda: "All rights reserved",
        lambda: f"aa bb cc {' '.join(word(3) for _ in range(5))}",
        lambda: f"Read more about {word(16)} {word(16)} here and there and everywhere",
        lambda: " ".join(word(16) for _ in range(rng.randrange(1, 9))),
        lambda: " ".join(["long"] * 54 + [word(5)]),
        lambda: "  ",
    ]
    rows = [(i, "\n".join(rng.choice(patterns)() for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = line_dedup.without_recurring_lines(docs, min_docs=6, leaf_tokens=leaf_tokens)
    want = brute(rows, 6)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == want
    assert sum(want[i] != t for i, t in rows) > 20


def test_names_of_lines_move_not_lines(spark):
    """Long lines that recur, and rows of no id, by both ways of the last pass."""
    long = [" ".join(f"w{i}x{n}" for n in range(400)) for i in range(30)]
    rows = [(d, f"own{d}\n{long[i]}") for i in range(30) for d in (2 * i, 2 * i + 1)]
    rows += [(None, long[7]), (None, long[7] + "\nno id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = [text if d is not None and d % 2 == 0 else "\n".join(x for x in text.split("\n") if x not in long) for d, text in rows]
    names, *_ = line_dedup._recurring_names(docs, "doc_id", "text", 10, 0.6, 100, 50, 2_000_000)
    assert {k for _, k in names.dtypes} == {"bigint"} and names.count() == 30
    for limit in (1000, 0):
        got = line_dedup.without_recurring_lines(docs, line_limit=limit).select("text").collect()
        assert sorted(r["text"] for r in got) == sorted(want)
    nameless = docs.withColumn("doc_id", docs.doc_id * None)
    for limit in (1000, 0):  # all count as one document: nothing recurs
        got = line_dedup.without_recurring_lines(nameless, line_limit=limit).select("text").collect()
        assert sorted(r["text"] for r in got) == sorted(t for _, t in rows)
