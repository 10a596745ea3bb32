"""The stages in a row, and the queries' names."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from callmeter.llm import quality, queries, simhash_dedup
from callmeter.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_keeps_columns_and_spells_every_text(spark):
    docs = table(spark, SF_DIR, "documents")
    first = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == first.columns
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(rows) <= first.count() and all(r.round_trip for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


EXTRA = ("score", "votes", "posterior", "ids", "decoded", "__uid", "__dropped", "__lines", "__emptied", "x.y", "uid", "__drop", "round_trip")


def test_stages_on_odd_documents(spark):
    docs = table(spark, SF_DIR, "documents").limit(80)
    odd = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "word " * 9000), (None, "Some words of no id at all. " * 3), (-5, "the same row"), (-5, "the same row")]
    rows = docs.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"), allowMissingColumns=True)
    rows = rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)])
    now = rows
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR)
        assert now.columns == rows.columns
        for i, c in enumerate(EXTRA):
            assert now.where(F.col(f"`{c}`") != i).count() == 0
    coded = corpus_pipeline.encode(spark, rows, SF_DIR)
    assert coded.count() == rows.count() and coded.where("not round_trip").count() == 0
    assert set(coded.columns) == {*rows.columns, "ids", "n_pieces", "round_trip"} and len(set(coded.columns)) == len(coded.columns)
    assert coded.where("decoded <> 4 or `x.y` <> 9").count() == 0


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_stages_send_long_texts_to_python_a_few_mb_at_a_time(spark):
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 300).alias("text"))
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        try:
            stage(spark, docs.limit(0), SF_DIR)
            sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in batches), "size bigint")
            assert max(r.size for r in sizes.collect()) < 8 << 20
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_near_duplicates_are_found_by_distances_to_references(spark, monkeypatch):
    """Without the search in bands, all texts whose fingerprints are two bits apart are linked."""
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(1500)] for _ in range(30)]
    texts += [[*t[:700], "changed", *t[701:]] for t in texts]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    first = [simhash_dedup.fingerprint_set(simhash_dedup.shingle_set(t.encode(), 5))[0] for _, t in rows]
    close = [i for i in range(30) if ((first[i] ^ first[30 + i]) & (2**64 - 1)).bit_count() <= 2]
    assert len(close) > 5
    monkeypatch.setattr(simhash_dedup, "_pairs", lambda cells, *_: cells.where("false").selectExpr("uid a", "uid b"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_similar(spark, docs, SF_DIR).collect()}
    assert kept == set(range(60)) - {30 + i for i in close}


def test_all_texts_at_the_similarity_or_above_are_linked(spark, monkeypatch):
    """Pairs of few shingles, which the fingerprints often miss, and larger ones, against all pairs."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [t for _ in range(60) for t in (lambda w: (w, w[:-1]))(words(9))]  # 4 of 5 shingles
    texts += [t for _ in range(60) for t in (lambda w: (w, w[:16]))(words(19))]  # 12 of 15
    texts += [t for _ in range(20) for t in (lambda w: (w, [*w[:150], *words(1), *w[151:]], w[:90]))(words(250))]
    texts += [[*words(k), *"a phrase that very many texts have in them".split(), *words(k)] for k in range(1, 40)]
    sets = [set(simhash_dedup.shingle_set(" ".join(t).encode(), 5).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    smallest = {g: group.index(g) for g in group}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    monkeypatch.setattr(simhash_dedup, "CELL_ROWS", 8)  # cells of a task, and split ones
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_similar(spark, docs, SF_DIR).collect()}
    assert kept == set(smallest.values())


def test_few_cells_of_a_document_travel_to_the_scorer(spark):
    docs = table(spark, SF_DIR, "documents").select("text").limit(40)
    texts = [r.text.encode() for r in docs.collect() if r.text and r.text.split()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], ["t", "h"])
    (found,) = quality._featured(iter([batch]))
    for text, at, x in zip(texts, found["at"].to_pylist(), found["x"].to_pylist(), strict=True):
        dense = np.zeros(quality.DIM, np.float32)
        dense[np.frombuffer(at, np.int32)] = np.frombuffer(x, np.float32)
        assert (dense == quality.features(text, quality.figures(text))).all()
    assert sum(map(len, found["at"].to_pylist() + found["x"].to_pylist())) < len(texts) * quality.DIM * 2
