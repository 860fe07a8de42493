"""Groups of near copies make no pairs as rows; rows with equal ids are told apart."""

import random

from millrace.llm import jaccard


def near_copies(n, words=60):
    rng = random.Random(n)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for k in range(rng.randrange(4)):  # up to three edits: some copies don't link with the original
            text[rng.randrange(words)] = f"x{i}_{k}"
        out.append(" ".join(text))
    return out


def test_overlaps_grow_with_the_group(spark, monkeypatch):
    rows = []

    def counted(matrix, grouped, real=jaccard._overlaps):
        found = real(matrix, grouped)
        rows.append((matrix.count(), found.count()))
        return found

    monkeypatch.setattr(jaccard, "_overlaps", counted)
    for n in (1000, 2000):
        df = spark.createDataFrame(list(enumerate(near_copies(n))), "doc_id long, text string").repartition(4)
        jaccard.jaccard_components(df).count()
    (small, few), (large, more) = rows
    assert few <= small and more <= large and more <= 3 * max(few, 1000)


def test_equal_ids_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    near = a + " more"
    rows = [(5, a), (5, b), (2, near), (5, b), (5, ""), (5, None), (None, "only here now"), (None, "only  here now"), (None, a), (7, "")]
    kept = jaccard.one_per_component(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(5, b), (2, near), (5, ""), (5, None), (None, "only  here now"), (7, "")], key=repr)
