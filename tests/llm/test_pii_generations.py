"""Patterns that only discovered identifiers admit."""

from millrace.llm import pii


def test_discovered_strings_admit_patterns(spark):
    found = [f"h{i}#x" for i in range(6)]
    texts = [f"please reach me u{i}@ex.com now" for i in range(30)]
    texts += [f"please reach me {t} now" for t in found]
    texts += [f"the badge code {t} here" for t in found] + ["the badge code k9 here", "the room number 12 here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digest(pii.find_pii(df)).collect()}
    assert [got[i] for i in range(30, 36)] == ["email:16:20"] * 6
    # no seed stands behind "badge code": its six discovered strings admit it, and it finds one more
    assert [got[i] for i in range(36, 43)] == ["email:15:19"] * 6 + ["email:15:17"]
    assert got[43] == ""
