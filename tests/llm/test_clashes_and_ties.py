"""Columns that are named like results, repeated ids, and starts of rows with one id."""

from millrace.llm import langid, pii, quality, queries, token_files, toxicity

TEXTS = [(2, "one two three four five six seven"), (2, "a"), (1, "word"), (None, "x y")]


def test_starts_follow_the_files(spark, tmp_path):
    path, place = queries.tokenizer_path("word_bpe_49k.json"), str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame(TEXTS, "doc_id long, text string"), place, path, files=2)
    tokens = token_files.read_tokens(spark, place)
    at = 0
    got = {(r.doc_id, r.start, r.n_tokens) for r in token_files.token_stats(tokens).collect()}
    for r in tokens.orderBy("part", "row").collect():
        assert (r.doc_id, at, len(r.ids)) in got
        at += len(r.ids)


def test_columns_named_like_results_are_replaced(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame([(1, "some words", "a", "b", "c", "d")], "doc_id long, text string, score string, margin string, passages string, _found string")
    assert langid.identify(odd, langid.learn_profiles(docs)).select("score", "margin", "passages").first().passages == "c"
    assert quality.score(odd, quality.learn(docs, labels, "quality")).select("score", "margin").first().margin == "b"
    assert toxicity.score(odd, toxicity.learn(docs, labels, "toxic")).select("score", "margin").first().margin == "b"
    assert pii.mask(odd.withColumnRenamed("margin", "_masked")).columns == ["doc_id", "text", "score", "_masked", "passages", "_found"]


def test_repeated_ids_do_not_lengthen_a_sample(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    once, often = toxicity.learn(docs, labels, "toxic"), toxicity.learn(docs.unionByName(docs), labels, "toxic")
    assert once == often
