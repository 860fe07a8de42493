"""How many labelled rows the quality model learns from."""

import numpy as np

from millrace.llm import quality


def test_sample_of_six_thousand(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, buckets: seen.extend(rows))
    ids = spark.range(6500).selectExpr("id as doc_id", "concat('word', id, ' same same') as text", "cast(id % 2 as int) as quality")
    quality.learn(ids.select("doc_id", "text"), ids.select("doc_id", "quality"), "quality")
    assert len(seen) == 6000
    assert all(len(b) == len(n) and n.min() > 0 and (np.diff(b) > 0).all() for _, b, n in seen)
