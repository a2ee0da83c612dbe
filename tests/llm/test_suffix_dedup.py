import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.llm import suffix_dedup as d


def brute_force(texts):
    n, seen = d.LENGTH, {}
    raws = [(t or "").encode() for t in texts]
    for i, raw in enumerate(raws):
        for k in range(len(raw) - n + 1):
            seen[raw[k:k + n]] = seen.get(raw[k:k + n], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - n + 1):
            if seen[raw[k:k + n]] > 1:
                gone[k:k + n] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdefghij klmno é") for _ in range(k))
    passages = [noise(k) for k in (150, 199, 200, 201, 260, 700, 1500)]
    texts = [None, "", "short", noise(200), "ha" * 400, "a" * 650, "\0" * 450, passages[5] + passages[5]]
    while len(texts) < n:
        parts = [noise(rng.choice([0, 3, 40, 300, 900]))]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            parts += [rng.choice(passages), noise(rng.choice([0, 1, 5, 60, 400]))]
        texts.append("".join(parts))
        if rng.random() < .3:  # exact and near copies
            t = list(texts[-1])
            for _ in range(rng.choice([0, 1, 3])):
                if t:
                    t[rng.randrange(len(t))] = "#"
            texts.append("".join(t))
    return texts


@pytest.mark.parametrize("seed, hot", [(1, 2000), (2, 2000), (3, 4)])
def test_matches_counting_every_string(spark, monkeypatch, seed, hot):
    """hot=4 makes most shared anchors hot, so that they are dealt anew."""
    monkeypatch.setattr(d, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(d, "HOT_ANCHORS", 10**9)
    monkeypatch.setattr(d, "SLICE", 5000)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, anchor int").repartition(4)
    got = {r.doc_id: r for r in d.dedup(docs).collect()}
    want = brute_force(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w, (i, texts[i])
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_index_matches_counting():
    """The transform's interval expansion alone, over unrelated alphabets."""
    for seed in range(20):
        rng = random.Random(seed)
        base = bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh\0\xff") for _ in range(600))
        texts = [base[rng.randrange(300):][:rng.randint(200, 500)] + bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 90))) for _ in range(12)]
        texts = [t + b"z" * max(0, 200 - len(t)) for t in texts]
        copies = np.array([rng.choice([1, 1, 1, 2]) for _ in texts])
        seen = {}
        for t, c in zip(texts, copies):
            for k in range(len(t) - 199):
                seen[t[k:k + 200]] = seen.get(t[k:k + 200], 0) + c
        got = d.repeated_places(texts, copies)
        assert [g.tolist() for g in got] == [[k for k in range(len(t) - 199) if seen[t[k:k + 200]] > 1] for t in texts]


def test_odd_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(211)) + "q"
    docs = spark.createDataFrame([(1, text), (1, text), (None, "x" + text[5:]), (2, "unlike"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in d.dedup(docs).collect())
    assert got == [(0, 208, 207), (1, 212, 212), (1, 212, 212), (2, 0, 0), (2, 6, 0)]
    assert d.dedup(docs.filter("doc_id > 9")).count() == 0


def test_texts_of_one_id_keep_their_own_names(spark):
    """60 texts without an id and as many with one id, in pairs that a 32-bit hash of the text names alike."""
    frame = spark.range(400_000).selectExpr("concat('t', id, repeat('-', 40)) AS t").selectExpr("t", "hash(t) AS h")
    twins = frame.groupBy("h").agg(F.collect_list("t").alias("t")).filter("size(t) > 1").limit(30).collect()
    texts = [t for r in twins for t in r.t[:2]]
    docs = spark.createDataFrame([(k, t) for k in (None, 7) for t in texts], "doc_id long, text string")
    assert len(texts) > 10 and d.keyed(docs).select("k1", "k2").distinct().count() == 2 * len(texts)
