"""Test items of few characters: exact, as whole words."""

from millrace.llm import decontaminate


def test_short_items_are_found_as_whole_words(spark):
    item = "The quick brown fox jumps over the lazy dog near the river bank today"
    bench = spark.createDataFrame([(1, "Who wrote  Faust?"), (2, "cat"), (3, "東京"), (4, ""), (5, None), (6, " \n"), (7, item), (8, "fox jumps")], "item_id long, text string")
    texts = ["so: who wrote\nFAUST? Goethe", "who wrote fausts", "concatenate cats", "a cat, asleep", "私は東京に住む", f"see {item}", "cat", "cát cat́", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.find_items(docs, bench).collect())
    assert got == [(0, 1, 0), (3, 2, 0), (4, 3, 0), (5, 7, 0), (5, 8, 0), (6, 2, 0)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [1, 2, 7, 8, 9]
    # one edit is within the budget of a tenth, but not of a short item
    assert decontaminate.ItemIndex([(1, "who wrote faust")], 0.1, 24).search("who wrote fauzt") == []
