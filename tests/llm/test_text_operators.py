"""Decontamination, Jaccard join, token files, BPE, personal data, URLs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, graphs, jaccard, pii, queries, sql, token_files, urls

from ..oracle import connect, same
from . import brute

ALPHABET = "ab 'sté\n\t |>\x1c\x85日本語🙂é<|endoftext|> <|endoftext|>,a <|startoftext|>123.,!́ǅ²½İΣς\x0b\x0c\xa0"


def odd_texts(n=400, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)]
    out += ["".join(chr(rng.randrange(0x2FFF)) for _ in range(40)) for _ in range(40)]
    return [*out, "", " ", "<|endoftext|>", "A<|ENDOFTEXT|>b", "Haat, haat.", "x" * 30_000, "word " * 50_000]


def frame(spark, texts):
    """Texts with ids, a null text, a repeated row and clashing columns."""
    rows = [*enumerate(texts), (len(texts), None)]
    return spark.createDataFrame([*rows, rows[0]], "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn("key", F.lit(1)).repartition(4)


# -- 3 ------------------------------------------------------------------------------------------------


def test_myers_matches_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 40)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(60)))
        bits = {}
        for i, c in enumerate(p):
            bits[c] = bits.get(c, 0) | 1 << i
        assert decontaminate.myers_search(bits, len(p), t, 99) == brute.edit_search(p, t)


def test_item_search_matches_brute_force():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcde ") for _ in range(n))
    for _ in range(200):
        items = [(i, decontaminate.normal_text(word(rng.randrange(24, 60)))) for i in range(3)]
        edited = list(rng.choice(items)[1])
        for _ in range(rng.randrange(9)):
            at = rng.randrange(len(edited))
            edited[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        text = decontaminate.normal_text(word(60) + "".join(edited) + word(60))
        want = {i: d for i, t in items if (d := brute.edit_search(t, text)) <= int(0.15 * len(t))}
        assert dict(decontaminate.ItemIndex(items, 0.15).search(text)) == want


def test_find_items(spark, sf):
    item = "The quick brown fox jumps over the lazy dog near the river bank today"
    edited = item.replace("quick", "quiet").replace("lazy ", "lazzy ")
    docs = frame(spark, ["nothing here", f"before {item.upper()}\n after", f"before  {edited} after", "", item[:40]])
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "short"), (11, "")], "item_id long, text string").withColumn("distance", F.lit("x"))
    got = sorted(tuple(r) for r in decontaminate.find_items(docs, bench).collect())
    assert got == [(1, 7, 0), (1, 8, 0), (2, 7, 3), (2, 8, 3)]
    # several blocks give the same rows
    assert sorted(tuple(r) for r in decontaminate.find_items(docs, bench, block_chars=70).collect()) == got
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [0, 0, 3, 4, 5]
    assert decontaminate.find_items(docs, bench.limit(0)).count() == 0 and decontaminate.find_items(docs.limit(0), bench).count() == 0


# -- 5 ------------------------------------------------------------------------------------------------


def test_jaccard_oracle(spark, sf):
    same(queries.op5_jaccard_join(spark, sf), connect(sf), sql.op5_jaccard_join())


def near_texts(seed, groups, size, words, edits):
    rng = random.Random(seed)
    pick = lambda: f"w{rng.randrange(5000)}"
    common = [pick() for _ in range(40)]
    out = []
    for _ in range(groups):
        base = [pick() for _ in range(words)]
        for _ in range(rng.randrange(1, size)):
            text = list(base)
            for _ in range(rng.randrange(edits)):
                text[rng.randrange(len(text))] = pick()
            if rng.random() < 0.3:
                text += common
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("seed, groups, size, words, edits, cap", [(1, 60, 6, 60, 4, 256), (2, 4, 60, 80, 5, 8), (3, 150, 3, 8, 2, 256)])
def test_jaccard_matches_brute_force(spark, monkeypatch, seed, groups, size, words, edits, cap):
    monkeypatch.setattr(jaccard, "GROUP_CLASSES", cap)
    monkeypatch.setattr(jaccard, "BLOCK_QUERIES", 4)
    texts = near_texts(seed, groups, size, words, edits)
    texts += [texts[0].upper(), texts[1], "", "a b", "A  b", "a b c d e", "a b c d e f", " x y", " \t "]
    rows = list(enumerate(texts))
    want = brute.components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x")).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert got == want


def test_jaccard_edge_cases(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "a b c"), (None, "q")], "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.jaccard_components(df).where("doc_id is not null").collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 0, 2), (3, 0, 3)]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = jaccard.one_per_component(df.withColumn("key", F.lit(0)))
    assert kept.columns == ["doc_id", "text", "key"] and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3]


def test_fewest_shared_prefix_tokens(spark):
    """The bound never asks for more prefix tokens than linked sets share."""
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 60)
        a = set(rng.sample(range(200), n))
        b = set(a)
        for _ in range(rng.randrange(1 + n // 5)):
            b.discard(rng.choice(sorted(b)))
            b.add(rng.randrange(200))
        b = b or {1}
        shared = len(a & b)
        if shared and 100 * shared >= 80 * (len(a) + len(b) - shared):
            prefix = lambda s: set(sorted(s)[: len(s) - jaccard.needed(len(s)) + 1])
            least = -(-80 * (len(a) + len(b)) // 180) - -(-max(len(a), len(b)) * 80 // 100) + 1
            assert len(prefix(a) & prefix(b)) >= max(1, least)


def test_components_match_brute_force(spark):
    rng = random.Random(6)
    for n in (0, 3, 30):
        edges = [(rng.randrange(25), rng.randrange(25)) for _ in range(n)] + ([(i, i + 1) for i in range(30, 44)] if n else [])
        parent = {i: i for i in range(50)}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        got = {tuple(r) for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {(i, find(i)) for i in range(50) if find(i) != i}


# -- 6 and 8 --------------------------------------------------------------------------------------------


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "doc_id long, text string").withColumn("part", F.lit("x")).repartition(3)
    want, start = {}, 0
    for i, t in [*enumerate(texts), (len(texts), "")]:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.tokenize_to_orc(docs, path).collect()}
    assert got == want
    place = str(tmp_path / "tokens")
    token_files.write_tokens(docs, place, path, files=4)
    back = token_files.read_tokens(spark, place).where("doc_id = 5")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in back._jdf.queryExecution().executedPlan().toString()
    assert back.first().ids == [*library.encode(texts[5], add_special_tokens=False).ids, 1]


def test_token_files_edge_cases(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    df = spark.createDataFrame([(2, "a"), (2, "a"), (2, None), (None, "b")], "doc_id long, text string")
    got = [tuple(r) for r in token_files.tokenize_to_orc(df, path).select("doc_id", "start", "n_tokens").orderBy("start").collect()]
    assert got == [(None, 0, 2), (2, 2, 1), (2, 3, 2), (2, 5, 2)]
    assert token_files.tokenize_to_orc(df.limit(0), path).count() == 0


def test_bpe_matches_the_library(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = odd_texts(seed=3)
    got = {r.doc_id: r for r in bpe.encode_decode(frame(spark, texts), path, keep_ids=True).collect()}
    for i, t in [*enumerate(texts), (len(texts), "")]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(got[i].decoded.encode()).hexdigest()


def test_bpe_small_caches(monkeypatch):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    own = bpe.coder(path)
    want = own.encode_batch(odd_texts(seed=5))
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 3)
    monkeypatch.setattr(bpe, "CHUNK_PIECES", 5)
    own.forget()
    assert [own.encode(t) for t in odd_texts(seed=5)] == want


def test_traversal_equals_merging():
    own = bpe.coder(queries.tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(8)
    words = {bytes(rng.choice(b"aeinst ") for _ in range(rng.randrange(1, 15))) for _ in range(3000)}
    assert own.traverse(words) == {w: np.array(own.merge(w), "<u4").tobytes() for w in words}


# -- 9 ------------------------------------------------------------------------------------------------


def digest(spans):
    return ",".join(f"{brute.FOUND[k]}:{a}:{b}" for k, a, b in spans)


def check_pii(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(0)).repartition(3)
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(df)).collect()}
    for i, spans in enumerate(brute.all_spans(texts)):
        base = sorted((list(brute.PII).index(k), a, b) for k, a, b in brute.base_spans(texts[i]))
        assert got[i].spans == digest(spans), texts[i]
        assert got[i].base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in brute.PII] == [sum(b[0] == n for b in base) for n in range(4)]
    return got


def test_pii_base_matches_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab@@..--++ 0123456789()é🙂\n_%") for _ in range(rng.randrange(80))) for _ in range(600)]
    texts += ["a@b.c" * 3, "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111 and 4111-1111-1111-1111", "é🙂 a@b.co, 1.2.3.004 300.1.1.1", "0.0.0.0", None, "", "x@y", "x" * 50_000 + "@a.b", "1 " * 3_000]
    check_pii(spark, texts)


def test_pii_bootstraps_contexts(spark):
    texts = [f"please reach me u{i}@ex.com now" for i in range(6)]
    texts += ["so reach me user9#home now", "we reach me  u1@ex.com now", "other text 77 here", "reach me"]
    texts += [f"call my line +1 (555) 555-01{i:02d} soon" for i in range(5)] + ["call my line 5550100 soon", "so line 12"]
    got = check_pii(spark, texts)
    assert got[6].spans == "email:12:22" and got[6].n_email == 0
    masks = [r.text for r in pii.mask(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert masks == [brute.masked(t, s) for t, s in zip(texts, brute.all_spans(texts))]


def test_pii_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute.all_spans([r.text for r in docs])
    got = {r.doc_id: r.spans for r in queries.op9_pii(spark, sf).collect()}
    assert got == {r.doc_id: digest(s) for r, s in zip(docs, want)}


def test_pii_discovers_secrets(spark):
    """Contexts of seed credentials find others; a table's spans are more than its base spans."""
    texts = [f'set token = "{n:040x}" now' for n in range(10**30, 10**30 + 3)] + ['set token = "hunter2x9" now', "see commit " + "1a" * 20 + " there"]
    texts += [f"password={n:018x} ok" for n in range(10**20, 10**20 + 4)] + ["password=s3same ok"] + [f"my AKIAX{n:015d} key" for n in range(3)] + ["so AKIAB0B0B0B0B0B0, key"]
    got = check_pii(spark, texts)
    assert got[3].spans == "secret:12:23" and got[4].spans == "" and got[9].spans == "secret:0:15" and got[13].spans == "secret:3:20"
    rows = queries.op9_pii(spark, "/root/testdata/sf0.01").select(F.sum("n_spans"), F.sum(sum(F.col(f"n_{k}") for k in brute.PII))).first()
    assert rows[0] > rows[1]


def test_pii_edge_cases(spark):
    df = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co"), (2, None)], "doc_id long, text string")
    assert sorted(r.n_email for r in pii.pii_digest(pii.find_pii(df)).collect()) == [0, 1, 1, 1]
    assert pii.find_pii(df.limit(0)).count() == 0
    assert sorted(str(r.text) for r in pii.mask(df.withColumn("_x", F.lit(1))).collect()) == ["<email>", "<email>", "<email>", "None"]


def test_pii_is_native(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (pii.base_spans(docs), pii.find_pii(docs), pii.mask(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# -- 10 -----------------------------------------------------------------------------------------------


def test_url_oracle(spark, sf):
    same(queries.op10_url_filter(spark, sf), connect(sf), sql.op10_url_filter())


def test_urls(spark):
    cases = [
        ("HTTP://WWW.Example.COM/en/7x?q=1#f", "www.example.com", "/en/7x", "example.com/en/7", "allow"),
        ("https://a.com/en/", "a.com", "/en/", "com/en/", "block"),
        ("https://example.net/de/81", "example.net", "/de/81", "example.net/de/8", "block"),
        ("https://example.net/de/71", "example.net", "/de/71", "net/de/", "allow"),
        ("https://net/de/", "net", "/de/", "net/de/", "allow"),
        ("https://xnet/de/", "xnet", "/de/", None, "allow"),
        ("https://x.org/casino", "x.org", "/casino", None, "block"),
        ("https://x.org/casinos", "x.org", "/casinos", None, "allow"),
        ("https://x.org/free", "x.org", "/free", None, "allow"),
        ("https://x.org/free-free", "x.org", "/free-free", None, "allow"),
        ("https://x.org/free-bonus", "x.org", "/free-bonus", None, "block"),
        ("https://x.org?casino", "x.org", "", None, "block"),
        ("casino", "", "", None, "block"),
        ("a/free#x://", "", "", None, "allow"),
        ("https://x.org/?a=free#Bonus", "x.org", "/", None, "block"),
        (None, "", "", None, "allow"),
        ("://", "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "page_id long, url string").withColumn("host", F.lit(1))
    got = urls.filter_urls(df).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [c[1:] for c in cases]
    assert urls.filter_urls(df.limit(0)).count() == 0
    assert urls.filter_urls(df.unionByName(df)).count() == 2 * len(cases)
