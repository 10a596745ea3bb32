"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from conftest import SF_DIR

from callmeter.llm import collocations, queries


def brute(rows, longest=3, least=10, share=50, first=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            within = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            if any(within(q) and 100 * b >= share * a for q, b in found.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["a", "B", "c", "é", "Ü", "dd", "e\x1cf", "g h", "the", "of", "𝒳", "z"]
    out = [(None, None), ("en", ""), ("en", " .,\n"), (None, "a b"), ("xx", "One two. " * 12), ("xx", "one\ttwo  three;" * 11)]
    for _ in range(150):
        n = rng.randrange(60)
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(n))
        out.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return out + out[-30:] * 2


@pytest.mark.parametrize("portion, part", [(8 << 20, 1 << 16), (200, 1 << 16), (40, 4)])
def test_against_counting(spark, rows, monkeypatch, portion, part):
    monkeypatch.setattr(collocations, "PART", part)
    docs = spark.createDataFrame([(t, l, 1, "x") for l, t in rows], "text string, lang string, a int, `p.q` string").repartition(3)
    assert result(collocations.collocations(docs, portion=portion)) == brute(rows)


def test_longer_phrases_and_other_bounds(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, longest=4, least=4, share=70, first=25)
    assert result(got) == brute(rows, 4, 4, 70, 25)


def test_empty_and_dotted(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert result(collocations.collocations(docs.toDF("l.g", "t.t"), lang_col="l.g", text_col="t.t")) == brute(rows)


def test_one_endless_piece(spark):
    rows = [("en", "one two three four " * 3000 + "word" * 5000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert result(collocations.collocations(docs, portion=1000)) == brute(rows)


def test_full_table_only_costs_time(spark, rows, monkeypatch):
    """Where every byte of the table is taken, all phrases are counted and results stay."""
    monkeypatch.setattr(collocations, "_frequent", lambda stripes: np.ones(1 << 12, np.uint8))
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert result(collocations.collocations(docs)) == brute(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 9_007_199_254_740_993, 9_999_999_999_999_989, 9_007_199_254_740_997
    row = spark.sql(
        f"SELECT (CAST(1000000 AS DECIMAL(7,0)) * (CAST({a} AS DECIMAL(16,0)) * CAST({a} AS DECIMAL(16,0))))"
        f" div (CAST({l} AS DECIMAL(16,0)) * CAST({r} AS DECIMAL(16,0))) AS s"
    ).first()
    assert row["s"] == 10**6 * a * a // (l * r)


def test_query_equals_sql(spark):
    assert differences(queries.op12_collocations(spark, SF_DIR), connect(SF_DIR), queries.ORACLE["op12_collocations"]) == []
