"""Nearest neighbours against brute force, and the pipeline against a plain version."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import ann, queries
from millrace.llm.common import fold

from . import brute


def exact(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = np.zeros(len(x))
        for j in range(x.shape[1]):
            s += x[i, j] * x[:, j]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if j != i][:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_tables(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    want = exact(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64), 20, 20)
    got = found(queries.op7_nearest(spark, sf))
    assert got.keys() == want.keys()
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want]) >= 0.95
    known = {q: dict(w) for q, w in want.items()}
    assert all(s == known[q][v] for q in got for v, s in got[q] if v in known[q])


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 32)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 40)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(40, 1, 16)) + 0.2 * rng.normal(size=(40, 40, 16))).reshape(-1, 16).astype(np.float32)
    x *= rng.uniform(0.5, 2, (len(x), 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    want, got = exact(np.arange(len(x)), x.astype(np.float64), 20, 20), found(ann.nearest(df))
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_neighbours_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 0.0]), (20, [1.0, 0.0]), (8, [1.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (40, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).withColumn("v", F.lit(1))
    assert found(ann.nearest(df)) == {0: [(1, 1.0), (20, 1.0), (2, 0.5)], 20: [(0, 1.0), (1, 1.0), (2, 0.5)]}
    assert found(ann.nearest(df, k=1)) == {0: [(1, 1.0)], 20: [(0, 1.0)]}
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id in (3, 4)")).count() == 0
    copies = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "vec_id long, embedding array<float>")
    assert {q: [v for v, _ in n] for q, n in found(ann.nearest(copies)).items()} == {q: [i for i in range(21) if i != q][:20] for q in range(0, 100, 20)}


def test_pipeline_matches_a_plain_version(spark, sf):
    from tokenizers import Tokenizer

    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    train = spark.read.parquet(f"{sf}/documents.parquet").where(fold("doc_id", 5) != 0).collect()
    known = brute.profiles([(r.text, r.lang) for r in train])
    rows = [(r.doc_id, r.text) for r in docs]
    kept = []
    for i, t in rows:
        lang, margin = brute.language(t, known)
        if lang != "und" and margin >= 0.005:
            kept.append((i, t))
    component = brute.components(kept)
    kept = [(i, t) for i, t in kept if component[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [(i, t) for i, t in kept if not brute.contaminated(t, items)]
    texts = [brute.masked(t, s) for (_, t), s in zip(kept, brute.all_spans([t for _, t in kept]))]
    library = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want = set()
    for (i, _), t in zip(kept, texts):
        ids = library.encode(t, add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf).collect()} == want


def test_stages_keep_the_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
