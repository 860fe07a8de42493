"""Rows without an id link like others."""

from millrace.llm import jaccard


def test_rows_without_ids_link(spark):
    words = [f"w{i}" for i in range(100)]

    def edited(*places):
        return " ".join(f"x{i}" if i in places else w for i, w in enumerate(words))

    # 1 and 2 link only through the two equal rows without an id
    rows = [(1, edited()), (None, edited(20, 40)), (None, edited(20, 40)), (2, edited(20, 40, 60, 80)), (None, "only one a b c d"), (3, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()), key=repr)
    assert got == sorted([(1, 96, 1), (None, 96, 1), (None, 96, 1), (2, 96, 1), (None, 2, None), (3, 0, 3), (None, 0, None)], key=repr)
