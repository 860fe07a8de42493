"""The quality classifier against a plain version: features from words, gradient descent over dense matrices."""

import collections

import numpy as np

from millrace.llm import quality

MASK = (1 << 64) - 1
BUCKETS = 512


def bucket(h):
    h = (h ^ h >> 32) * 0xFF51AFD7ED558CCD & MASK
    return (h ^ h >> 29) % BUCKETS


def times(a, b, plus=0):
    return (a * b + plus) & MASK


def plain_features(text):
    """Counts of the buckets of words, of their n-grams of three to five bytes, and of consecutive words."""
    prime, counts, hashes = 0x9E3779B97F4A7C15, collections.Counter(), []
    for word in (text or "").encode().split():
        codes = [c + 1 for c in b"<%b>" % word]
        power, whole = 1, 0
        for c in codes:
            power = times(power, 0x100000001B3)
            whole = (whole + times(c, power)) & MASK
        hashes.append(whole)
        counts[bucket(times(whole, prime))] += 1
        for n in (3, 4, 5):
            for i in range(len(codes) - n + 1):
                h = codes[i]
                for c in codes[i + 1 : i + n]:
                    h = times(h, prime, c)
                counts[bucket((h + n) & MASK)] += 1
    for a, b in zip(hashes, hashes[1:]):
        counts[bucket(1 if a == b else (times(a, prime, b) + 7) & MASK)] += 1
    return counts


def plain_train(rows, dimensions, epochs, rate, batch, seed):
    """The same descent with one dense mean matrix: weights of the buckets and the bias."""
    labels = np.array([y for y, _ in rows])
    share = labels.mean()
    means = np.zeros((len(rows), BUCKETS))
    for i, (_, counts) in enumerate(rows):
        for k, n in counts.items():
            means[i, k] = n / sum(counts.values())
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dimensions, 1 / dimensions, (BUCKETS, dimensions))
    layer, bias = np.zeros((dimensions, 2)), np.log([1 - share, share])
    steps, total = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = [i for i in order[at : at + batch] if rows[i][1]]
            if not pick:
                continue
            pace = rate * (1 - steps / total)
            steps += 1
            x = means[pick]
            logits = x @ table @ layer + bias
            p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            back = p @ layer.T
            layer = layer - pace * (x @ table).T @ p
            table = table - pace * x.T @ back
            bias = bias - pace / len(pick) * p.sum(0)
    return table @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]


def test_training_and_scores_match_a_plain_version(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) between 20 and 1500").orderBy("doc_id").limit(40).collect()]
    texts += [None, "", " \n ", "one", "a a a a", "word " * 300, "äöü ∑ 你好 x"]
    for t in texts:
        codes, counts = quality.document_features(t, BUCKETS)
        assert dict(zip(codes.tolist(), counts.tolist())) == dict(plain_features(t))
    rows = [(i % 3 == 0, plain_features(t)) for i, t in enumerate(texts)]
    rows = [(int(y), c) for y, c in rows]
    held = [(y, *quality.document_features(t, BUCKETS)) for (y, _), t in zip(rows, texts)]
    model = quality.train(held, BUCKETS, dimensions=4, epochs=3, rate=0.5, batch=8, seed=3)
    weights, bias = plain_train(rows, 4, 3, 0.5, 8, 3)
    assert np.allclose(model.weights, weights, atol=1e-3) and abs(model.bias - bias) < 1e-3
    assert np.ptp(weights) > 0.01  # it has learned something to compare

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    for i, t in enumerate(texts):
        counts = plain_features(t)
        logit = model.bias + (sum(model.weights[k] * n for k, n in counts.items()) / sum(counts.values()) if counts else 0)
        assert abs(got[i] - 1 / (1 + np.exp(-logit))) < 1e-6
