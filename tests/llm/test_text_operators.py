"""The text operators against brute force on small tables, and on odd input."""

import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callmeter.llm import (
    chat_format,
    decontaminate,
    embed_dedup,
    langid,
    license_scan,
    line_dedup,
    lm_score,
    quality,
    sentencepiece_codec,
    simhash_dedup,
)
from callmeter.llm.common import components

SF_DIR = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (None, "A b  c\nd e"), (4, " \n "), (5, "x" * 3000 + " " + "lo ng " * 2000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i else None, 1, 2, "k") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int, uid bigint, word string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def roots(nodes, links):
    to = {n: n for n in nodes}

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        to[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    true = roots({n for x in links for n in x}, links)
    assert all(found.get(n, n) == c for n, c in true.items())


def test_lm_baseline_and_model(docs, odd, empty):
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = {r.doc_id: r for r in lm_score.score_documents(docs, fold).collect()}
    texts = {r.doc_id: r.text.encode().lower().split() + [lm_score.END] for r in docs.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in texts.items() if not out[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for i, words in texts.items():
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[i], len(words), total)
        assert r.n_known == sum(w in counts for w in words)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base)
        assert r.score < 0
    few_heads = {r.doc_id: r.base_score for r in lm_score.score_documents(docs, fold, heads=5).collect()}
    assert all(abs(few_heads[i] - r.base_score) < 1e-6 * max(1, -r.base_score) for i, r in found.items())
    assert lm_score.score_documents(odd, F.lit(False)).count() == len(ODD)
    assert lm_score.score_documents(odd, F.lit(True)).agg(F.max("n_known")).first()[0] == 0
    assert lm_score.score_documents(empty, F.lit(False)).count() == 0


def test_lm_probabilities_sum_to_one_and_windows_score_once():
    rng = np.random.default_rng(0)
    size, classes = 60, lm_score.GROUPS * lm_score.PER_GROUP
    cls = rng.integers(0, classes, size).astype(np.int32)
    share = np.log(1 / np.bincount(cls, minlength=classes)[cls])
    used = np.bincount(cls, minlength=classes).reshape(lm_score.GROUPS, -1) > 0
    direct2 = np.where(used, 0, -1e9).astype(np.float32)[None].repeat(lm_score.KNOWN + 2, 0)
    direct1 = np.where(used.any(1), 0, -1e9).astype(np.float32)[None].repeat(lm_score.KNOWN + 2, 0)
    shapes = {"e": (lm_score.KNOWN + 2, 16), "q": (16, 12), "k": (16, 12), "v": (16, 24), "far": (32,), "b1": (24, 16), "b2": (16, 24, 32)}
    weights = {n: (rng.standard_normal(s) * 0.3).astype(np.float32) for n, s in shapes.items()}
    model = lm_score.Model(rng.integers(0, 2046, size).astype(np.int32), cls, share, direct1, direct2, weights)
    text = rng.integers(0, size, 45).astype(np.int32)
    ids, joined, target, _ = lm_score.windows([text], model)
    assert sorted(target[target >= 0]) == sorted(text)
    last = np.repeat(text[None], size, 0)
    last[:, -1] = np.arange(size)
    every = lm_score.score_texts(list(last), model) - lm_score.score_texts([text[:-1]], model)[0]
    assert abs((10.0**every).sum() - 1) < 1e-3
    lone = sum(lm_score.score_texts([t], model)[0] for t in (text, text[:7]))
    assert abs(lm_score.score_texts([text, text[:7]], model).sum() - lone) < 1e-4


def test_quality(spark, docs, odd, empty):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = quality.score_documents(docs, quality.fit(docs)).join(labels, "doc_id").toPandas()
    assert ((found["score"] > 0.5) == (found["quality"] == 0)).mean() > 0.95
    rows = quality.score_documents(odd, quality.fit(odd)).collect()
    assert len(rows) == len(ODD) and all(r.score == 1 for r in rows if not (r.text or "").split())
    assert quality.score_documents(empty, quality.fit(empty)).count() == 0


def test_chat_repairs_cost_least(spark):
    rng = random.Random(2)
    rows = [(i, t, rng.choice(["system", "user", "assistant", "bot", None]), f"t{t}", 0) for i in range(40) for t in range(rng.randrange(1, 13))]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, chunk int")
    found = chat_format.format_chats(table, chunk=3).toPandas()
    assert len(found) == len(rows)
    for i, g in found.groupby("conv_id"):
        olds = [r[2] for r in rows if r[0] == i]
        state, cost = 0, 0.0
        for old, new in zip(olds, g.sort_values(["turn", "place"])["role"], strict=True):
            new = chat_format.ROLES.index(new)
            move = next(m for m in chat_format.MOVES[new] if m[0] == state)
            cost += dict(chat_format._label_costs(old))[new] + move[2]
            state = new
        least = (chat_format.matrix(olds)[0] + np.array([0, 0, chat_format.INSERT, 0])).min()
        assert abs(cost + (state == 2) * chat_format.INSERT - least) < 1e-9
        text = "".join(g.sort_values(["turn", "place"])["rendered"])
        roles = re.findall(r"<\|(system|user|assistant)\|>", text)
        assert roles[-1] == "assistant" or roles == ["system"]
        legal = {("system", "user"), ("user", "assistant"), ("assistant", "user")}
        assert all(x in legal for x in zip(roles, roles[1:], strict=False))
    strange = spark.createDataFrame([(None, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert sorted(r.copies for r in chat_format.format_chats(strange).collect()) == [1, 2]
    assert chat_format.format_chats(strange.where("false")).count() == 0


def test_decontamination(spark, docs, odd, empty):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = {r.item_id: decontaminate.plain(r.text.encode()) for r in bench.collect()}
    whole = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in decontaminate.plain(r.text.encode())}
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert whole and whole <= found
    assert found == {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, block_chars=3000).collect()}
    kept = {r.doc_id for r in decontaminate.without_benchmark(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in found}
    rng, texts = random.Random(3), list(items.values())
    index = decontaminate.build_index(list(items.items()))
    seen = np.zeros(1 << 22, bool)
    seen[decontaminate._slot(index.grams)] = True
    edited = []
    for t in texts:
        t = bytearray(t)
        for _ in range(len(t) * 6 // 100):
            t[rng.randrange(len(t))] = rng.randrange(97, 123)
        edited.append(b"before it " + bytes(t) + b" and behind")
    assert {(n, i) for n, i in enumerate(items)} <= {(n, i) for n, i, _, _ in decontaminate.search(edited, index, seen)}
    assert decontaminate.matches(odd, bench).count() == 0
    assert decontaminate.without_benchmark(odd, bench).count() == len(ODD)
    assert decontaminate.matches(empty, bench).count() == decontaminate.matches(docs, bench.where("false")).count() == 0


def test_embeddings(spark, monkeypatch):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    rng = np.random.default_rng(1)
    x = np.stack(table["embedding"]).astype(float)[:300]
    close = x[:40] + rng.standard_normal((40, 64)) * np.linalg.norm(x[:40], axis=1)[:, None] * 0.03
    x = np.vstack([x, close, np.repeat(x[:1], 30, 0) + rng.standard_normal((30, 64)) * 1e-3, x[:5]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    bad = [(900, None, 0), (901, [0.0] * 64, 0), (902, [float("nan")] * 64, 0), (903, [None, 1.0], 0), (904, [], 0)]
    given = spark.createDataFrame([*rows, *bad], "vec_id bigint, embedding array<double>, uid int")
    true = roots(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)])
    for block in (1024, 8):
        monkeypatch.setattr(embed_dedup, "ROWS_PER_BLOCK", block)
        found = {r.vec_id: r for r in embed_dedup.near_duplicates(given).collect()}
        assert len(found) == len(rows) + len(bad)
        links = sum(found[i].n_links for i in range(len(x)))
        assert all(found[i].n_links <= near[i].sum() - 1 for i in range(len(x)))
        assert links >= 0.99 * (near.sum() - len(x))
        assert np.mean([found[i].component_id == c for i, c in true.items()]) > 0.99
        assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i, *_ in bad)
    assert embed_dedup.near_duplicates(given.where("false")).count() == 0


def test_simhash(spark, docs, odd, empty):
    found = simhash_dedup.near_duplicates(docs).toPandas()
    prints = {i: int(f, 16) for i, f in zip(found["doc_id"], found["fingerprint"], strict=True)}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert dict(zip(found["doc_id"], found["component_id"], strict=True)) == roots(prints, links)
    import xxhash

    for r in docs.limit(20).collect():
        w = r.text.encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        assert prints[r.doc_id] == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    rows = simhash_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r.fingerprint for r in rows if r.doc_id in (1, 2)} == {"0" * 16}
    assert {r.component_id for r in rows if r.doc_id in (3, None)} == {3}
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_similar_texts(spark, odd, empty):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.randrange(60, 300))]
        near = list(base)
        near[len(near) // 2] = "changed"
        texts += [base, near]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in simhash_dedup.without_near_duplicates(table).collect())
    assert set(range(0, 80, 2)) <= set(kept) and len(kept) <= 42
    assert sorted(r.doc_id or 0 for r in simhash_dedup.without_near_duplicates(odd).collect()) == [1, 3, 5]
    assert simhash_dedup.without_near_duplicates(empty).count() == 0


def test_line_dedup(spark, odd, empty):
    rows = [(i, f"own line {chr(97 + i)}q\nThis page was seen {i} times by all\nplain footer of the site") for i in range(12)]
    rows += [(50, "single line here\nplain footer of the site"), (51, None), (52, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    for limits in ({}, {"leaf_limit": 0, "line_limit": 0}):
        out = {r.doc_id: r for r in line_dedup.without_recurring_lines(table, **limits).collect()}
        assert out[0].text == rows[0][1]
        assert all(out[i].text == f"own line {chr(97 + i)}q" for i in range(1, 12))
        assert out[50].text == "single line here" and out[51].text is None and out[52].text == ""
    assert line_dedup.without_recurring_lines(odd).count() == len(ODD)
    assert line_dedup.without_recurring_lines(empty).count() == 0


def test_pieces_equal_the_library_and_chunks_equal_the_whole(spark, docs, odd, empty):
    import public_tokenizers
    import sentencepiece

    pieces = sentencepiece_codec.load_pieces()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
    rng = random.Random(4)
    texts = [r.text for r in docs.limit(60).collect()]
    texts += ["a" * 900, "日本" * 200 + "  x  ", "xx   yy\n\n z" * 9, "".join(rng.choice("abc eté.\n1(") for _ in range(900)), "def f(x):\n    return x+1 # ok"]
    for t in texts:
        whole = sentencepiece_codec.encode(pieces.units.findall(" " + t), pieces)
        assert np.frombuffer(whole, "<i4").tolist() == model.encode(t)
        for size in (40, 333):
            parts = sentencepiece_codec.chunks(t, size, pieces.longest)[:60]
            cut = "".join(p[b:] for _, b, p in parts)[1:]
            states = sentencepiece_codec.combine([sentencepiece_codec.transfer(p, b, pieces) for _, b, p in parts])
            ids = b"".join(sentencepiece_codec.trace(p, b, *s, pieces) for (_, b, p), s in zip(parts, states, strict=True))
            assert ids == sentencepiece_codec.encode(pieces.units.findall(" " + cut), pieces)
    for table, n in ((odd, len(ODD)), (empty, 0)):
        coded = sentencepiece_codec.decode_documents(sentencepiece_codec.encode_documents(table, pieces, chunk=700), pieces).collect()
        assert len(coded) == n and all(r.decoded == r.text for r in coded)
        assert all((r.ids is None) == (r.text is None) for r in coded)
        checked = sentencepiece_codec.encode_documents(table, pieces, chunk=700, check=True).collect()
        assert len(checked) == n and all(r.round_trip for r in checked)
        assert sorted(str(r.ids) for r in checked) == sorted(str(r.ids) for r in coded)
    clashing = odd.select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(("ids", "decoded", "__uid", "round_trip", "a.b", "uid"))])
    found = sentencepiece_codec.encode_documents(clashing, pieces, chunk=700, check=True)
    assert sorted(found.columns) == sorted(clashing.columns)
    assert found.where("decoded <> 1 or `__uid` <> 2 or `a.b` <> 4 or uid <> 5 or not round_trip").count() == 0 and found.count() == len(ODD)


def test_neighbours_from_scores_equal_merging(spark):
    pieces = sentencepiece_codec.load_pieces()
    rng, every = random.Random(2), list(pieces.ids)
    short = [p for p in every if len(p) < 4]
    for k in range(40_000):
        left, right = (rng.choice(every), rng.choice(every)) if k % 2 else (rng.choice(short), rng.choice(short))
        assert pieces.apart(left, right) == (pieces.merged(left + right) == [left, right]), (left, right)


def test_language(spark, docs, odd, empty):
    split = docs.withColumn("out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    model = langid.learn(split.where("not out"))
    found = langid.predict(split, model, keep=("out", "lang")).where("out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97
    mixed = spark.createDataFrame([(1, "the hethe and thinging of the tion. und ver die schung einheit der keit zuver"), (2, "123 !"), (3, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in langid.predict(mixed, model).collect()}
    assert [s.lang for s in rows[1].spans] == ["en", "de"]
    assert rows[2].lang_pred == rows[3].lang_pred == "und" and rows[2].score == 0
    rng = np.random.default_rng(0)
    scores = rng.standard_normal((7, 3)) * 4
    import itertools

    best = max(itertools.product(range(3), repeat=7), key=lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:], strict=False)))
    assert tuple(langid._viterbi(scores, np.array([0]), np.array([7]), 2.0)) == best
    assert langid.predict(odd, langid.learn(odd)).count() == len(ODD)
    assert langid.predict(empty, langid.learn(empty)).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.learn(empty)).collect()} == {"und"}


def test_licences(spark, docs, odd, empty):
    extra = [(9001, "CC BY and cc-by; All Rights\nReserved. GENERAL public license"), (9002, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (9003, "by cc rights all reserved K")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    found = {r.doc_id: r for r in license_scan.scan(table).collect()}
    for r in table.collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        x = found[r.doc_id]
        assert (x.n_words, x.n_base, x.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (x.first_word, x.last_word) == (min(places, default=None), max(places, default=None))
        assert labels <= set(x.labels.split(",")) | ({""} - labels) and 0 <= x.score <= 1
    assert found[9002].labels == "mit" and found[9002].score > 0.5
    assert [r.n_words for r in license_scan.scan(odd).orderBy("doc_id").collect() if r.doc_id in (1, 2, 4)] == [0, 0, 0]
    assert license_scan.scan(empty).count() == 0


def test_copies_with_edits_of_their_own_meet_their_base(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    texts = [list(base) for _ in range(1500)]
    for copy in texts[1:]:
        for place in rng.sample(range(5, 295, 6), 5):
            copy[place] = word()
    sets = [simhash_dedup.shingle_set(" ".join(t).encode(), 5) for t in texts[:50]]
    alike = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert all(alike(sets[0], x) >= 0.8 for x in sets) and np.mean([alike(x, y) < 0.8 for x, y in zip(sets[1:], sets[2:], strict=False)]) > 0.9
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for rows in (4096, 200):
        monkeypatch.setattr(simhash_dedup, "CELL_ROWS", rows, raising=False)
        # About 3 in 100 share no cell with the base.
        n = simhash_dedup.similar_groups(table).select("group").distinct().count()
        assert n <= 100


def test_lines_with_recurring_fields_long_lines_and_digits(spark):
    name = lambda n: "n" + "abcdefghij"[n // 10] + "abcdefghij"[n % 10]
    long = " ".join(f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(60))
    rows = []
    for i in range(1200):
        text = f"own line {name(i % 100)}{name(i // 100)}\nThis article was written by {name(i % 30)} {name(30 + i // 30)} for our readers"
        rows.append((i, text + "\nPage 3 of 10\n555 0199" * (i < 12) + f"\n{long}" * (i in (3, 7)) + "\nin nine 1 2" * (i < 9)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    for limits in ({}, {"leaf_limit": 0, "line_limit": 0}):
        out = {r.doc_id: r.text.split("\n")[1:] for r in line_dedup.without_recurring_lines(table, **limits).collect()}
        assert out[0] == rows[0][1].split("\n")[1:]
        # The first document of a variant that recurs itself keeps its line.
        assert out[3][1:] == [long, "in nine 1 2"] and out[7][1:] == ["in nine 1 2"] and out[10][1:] == []
        assert not any(out[i] for i in range(30, 1200))


def test_decontamination_finds_excerpts_and_items_without_id(spark):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = {r.item_id: decontaminate.plain(r.text.encode()) for r in bench.limit(8).collect()}
    index = decontaminate.build_index(list(items.items()))
    seen = np.zeros(1 << 22, bool)
    seen[decontaminate._slot(index.grams)] = True
    planted = [(i, b"before it " + t[at : at + 75] + b" and behind") for i, t in items.items() for at in range(max(len(t) - 74, 1))]
    found = {(n, i) for n, i, _, _ in decontaminate.search([t for _, t in planted], index, seen)}
    assert {(n, i) for n, (i, _) in enumerate(planted)} <= found
    lone = spark.createDataFrame([(None, "an item that has no id at all but says quite a lot of things")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "here is an item that has no id at all but says quite a lot of things"), (2, "other text")], "doc_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.matches(docs, lone).collect()] == [(1, None)]
    assert [r.doc_id for r in decontaminate.without_benchmark(docs, lone).collect()] == [2]


def test_lm_trains_on_whole_texts():
    vocabulary = lm_score.load_vocabulary()
    words = [b"word%d" % n for n in range(1000)]
    parts = lm_score.stretches(words, lm_score.SHARE, vocabulary)
    assert np.concatenate(parts).tolist() == vocabulary.encode(words).tolist()


def test_lm_step_is_right_and_costs_little_beyond_its_arithmetic():
    rng = np.random.default_rng(1)
    size, classes = 4000, lm_score.GROUPS * lm_score.PER_GROUP
    shapes = {"e": (lm_score.KNOWN + 2, 16), "q": (16, 12), "k": (16, 12), "v": (16, 24), "far": (32,), "b1": (24, 16), "b2": (16, 24, 32)}
    weights = {n: (rng.standard_normal(s) * 0.3).astype(np.float32) for n, s in shapes.items()}
    direct1, direct2 = (np.log(rng.dirichlet(np.ones(s[-1]), s[:-1]) + 1e-3).astype(np.float32) for s in ((lm_score.KNOWN + 2, 16), (lm_score.KNOWN + 2, 16, 32)))
    cls = rng.integers(0, classes, size).astype(np.int32)
    model = lm_score.Model(rng.integers(0, 2046, size).astype(np.int32), cls, np.zeros(size), direct1, direct2, weights)
    texts = [rng.integers(0, size, n).astype(np.int32) for n in (45, 1, 700, 16, 1100, 64)]
    ids, joined, target, _ = lm_score.windows(texts, model)

    def loss(by: float, along: dict[str, np.ndarray]) -> float:
        model.weights = {n: (w + by * along[n]).astype(np.float32) for n, w in weights.items()}
        found = lm_score.score_texts(texts, model).sum() * np.log(10) / -sum(map(len, texts))
        model.weights = weights
        return found

    slopes = lm_score.gradients(model, ids, joined, target)
    for name in shapes:
        along = {n: np.sign(slopes[n]) if n == name else 0 * a for n, a in weights.items()}
        assert abs((loss(3e-3, along) - loss(-3e-3, along)) / 6e-3 / np.abs(slopes[name]).sum() - 1) < 0.02

    def least(run) -> float:
        took = []
        for _ in range(60):
            began = time.perf_counter()
            run()
            took.append(time.perf_counter() - began)
        return min(took)

    # By a yardstick of the same machine: the exponentials of one step's attention.
    some = rng.standard_normal((len(ids), lm_score.BLOCK, 2 * lm_score.BLOCK)).astype(np.float32)
    assert least(lambda: lm_score.gradients(model, ids, joined, target)) < 75 * least(lambda: np.exp(some))


def test_lm_cuts_many_words_as_one_by_one():
    vocabulary, rng = lm_score.load_vocabulary(), random.Random(2)
    texts = [None, "", " ", "a\x0bB\x0cc\x1c\x1dd\x85 É  É\t\n x ", "ÀB c", "\n\n", "".join(rng.choices("abcABCÉé \n.,0123", k=20_000)), "Z" * 100 + " " + "z" * 100]
    many, found = lm_score._split(pa.array(texts, pa.string()))
    words = [lm_score.words_of((t or "").encode()) for t in texts]
    assert (many.tolist(), found.cast(pa.binary()).to_pylist()) == ([len(w) for w in words], [x for w in words for x in w])
    odd = [bytes(rng.choices(range(256), k=rng.randint(1, 60))) for _ in range(500)] + [x for w in words for x in w]
    assert [np.frombuffer(p, vocabulary.kind).tolist() for p in vocabulary.packed(odd)] == [vocabulary.pieces(w) for w in odd]
