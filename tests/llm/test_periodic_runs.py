"""Periodic runs against a search of all periods at all places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_DIR

from callmeter.llm import periodic_runs, queries
from callmeter.llm.words import split_words


def brute(words):
    """Every run by its definition: each period up to a quarter of the words, longest stretches."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
                if not smaller:
                    found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(words, runs):
    out = set()
    for start, length, q in runs:
        out |= set(range(start + q, start + length))
    return " ".join(w for i, w in enumerate(words) if i not in out)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def blank_split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def numbers(sequences):
    codes = np.array([c for s in sequences for c in s], np.int32)
    text = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    return codes, text


@pytest.mark.parametrize("seed", range(6))
def test_arrays_find_what_brute_force_finds(seed):
    rng = random.Random(seed)
    sequences = []
    for _ in range(60):
        letters = rng.choice([1, 2, 3, 50])
        s = [rng.randrange(letters) for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            q = rng.choice([1, 2, 5, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 48])
            unit = [rng.randrange(rng.choice([1, 2, 4, 99])) for _ in range(q)]
            s += (unit * 7)[: rng.randrange(3 * q, 7 * q + 1)] + [rng.randrange(99) for _ in range(rng.randrange(3))]
        sequences.append(s)
    codes, text = numbers(sequences)
    runs = periodic_runs.find_runs(codes, text)
    first = np.cumsum([0] + [len(s) for s in sequences])
    for k, s in enumerate(sequences):
        mine = [tuple(r) for r in (runs[text[runs[:, 0]] == k] - [first[k], 0, 0]).tolist()] if len(s) else []
        assert mine == brute(s), s


def test_every_period_up_to_a_few_hundred():
    rng = random.Random(5)
    sequences = []
    for q in range(1, 300):
        unit = [rng.randrange(10**6) for _ in range(q)]
        extra = rng.randrange(0, q + 1)
        sequences.append([-1] * rng.randrange(3) + (unit * 8)[: max(6, 4 * q) + extra] + [-2, -3])
    codes, text = numbers(sequences)
    runs = periodic_runs.find_runs(codes, text)
    assert sorted(set(runs[:, 2].tolist())) == list(range(1, 300)) and len(runs) == 299


def test_words_are_cut_at_blanks_only():
    texts = ["a b c\x0bd\x1ce", "", " \t\n", "é\x85f  g\r\nh", " x"]
    got = split_words([t.encode() for t in texts])
    words = [got.vocabulary[int(c)].as_py().decode() for c in got.codes]
    assert words == [w for t in texts for w in blank_split(t)]
    assert got.text.tolist() == [k for k, t in enumerate(texts) for _ in blank_split(t)]


def test_operator_on_odd_input(spark):
    long = " ".join(["one two three"] * 30_000) + " end"
    texts = [None, "", " \n\t", "a a a a a a", "a a a a a", "x y x y x y x y z", "A a A a A a A a", long, "word" * 100_000, "a a a a a a"]
    ids = [1, 2, 3, 4, 5, 6, None, 8, 9, 4]
    rows = [(i, t, 7, "k", 1.5) for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int, `runs.x` string, n_words double")
    got = sorted(periodic_runs.periodic_runs(docs, portion=64).collect(), key=str)
    want = []
    for i, t in zip(ids, texts, strict=True):
        words = blank_split(t)
        runs = [(0, 90_000, 3)] if t is long else brute(words)
        want.append((i, len(words), runs, dropped(words, runs)))
    assert sorted(((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
    dotted = docs.withColumnRenamed("text", "a.b")
    assert periodic_runs.periodic_runs(dotted, text_col="a.b").count() == len(rows)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SF_DIR).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert len(got) == len(docs)
    with_runs = 0
    for doc in docs:
        words = planted(doc["doc_id"], blank_split(doc["text"]))
        if len(words) > 2500:
            continue
        runs = brute(words)
        with_runs += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = got[doc["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row["collapsed_sha256"] == sha(dropped(words, runs))
    assert with_runs > 5
