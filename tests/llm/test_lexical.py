import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barsmith.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=10):
    """{item_id: [(score, doc_id)]}, by scoring every document for every item."""
    counted = [(i, Counter(ts), len(ts)) for i, ts in ((i, terms(t)) for i, t in docs) if ts]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, ts in asked.items():
        scored = []
        for doc, c, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out[i] = [(-s, None if void else d) for s, void, d in sorted(scored)[:k]]
    return {i: v for i, v in out.items() if v}


def searched(spark, docs, items, k=10, parts=4):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, terms string").repartition(parts)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    got = lexical.search_documents(df, asked, k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.item_id, r["rank"])):
        out.setdefault(r.item_id, []).append((r.score, r.doc_id))
        assert r["rank"] == len(out[r.item_id])
    return out


def corpus(rng, n, vocabulary=400):
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "naïve", "日本", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    seps = [" ", ", ", "\n", "\x7f", "-", "[", "`", "@", "\x00", "  "]
    return [(i, "".join(w.upper() + rng.choice(seps) if rng.random() < .1 else w + rng.choice(seps)
                        for w in rng.choices(words, weights, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    docs = corpus(rng, 500)
    docs += [(1000 + i, docs[i % 7 + 1][1]) for i in range(60)]  # copies: ties
    docs += [(None, docs[3][1])] * 3 + [(5, docs[4][1]), (2000, None), (2001, ""), (2002, "-- ` @"), (2003, "w1 " * 70000 + "only once"), (2004, "w2 " * 300)]
    items = [(i, t) for i, t in corpus(rng, 40)] + [(3, "w1 w2 naïve"), (None, "w1"), (90, None), (91, "?!"), (92, "absent words"), (93, docs[3][1]),
                                                    (94, "ONLY once w1"), (95, "w2")]
    assert searched(spark, docs, items) == brute_force(docs, items)


def test_blocks_waves_and_long_items(spark, monkeypatch):
    rng = random.Random(4)
    docs = corpus(rng, 300)
    items = corpus(rng, 30) + [(500, " ".join(t for _, t in docs))]
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "PIECE", 50)
    assert searched(spark, docs, items, k=3) == brute_force(docs, items, k=3)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == {} and searched(spark, [(1, "a b")], []) == {} and searched(spark, [(1, "?")], [(1, "?")]) == {}


def test_sketch_bounds_hold_and_prune():
    rng = random.Random(6)
    docs = corpus(rng, 300)
    batches = list(lexical._index([__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})]))
    vocabulary = np.unique(lexical.slice_terms(np.frombuffer(b"w1 w5 w60 naive", np.uint8), np.array([0, 15]))[0])
    block = lexical.Block(vocabulary, np.array([5, 7, 900, 3000]), np.array([0, 0, 1, 1]), np.array([0, 1, 2, 3]), 2)
    best = lexical.Best(2, 5)
    for b in batches:
        m = 10 + b.column(1).to_numpy()
        bound = block.bounds(lexical._flat(b.column(4), np.uint8)[0].reshape(-1, lexical.WIDTH), m)
        doc, item = np.divmod(np.arange(len(b) * 2), 2)
        keys, tfs = best._frequencies(block, b, np.arange(len(b)))
        assert (block.score(doc, item, keys, tfs, m) <= bound.ravel()).all()
        best.feed(block, b, m)
    assert best.scored < 2 * 300 / 2


def test_terms_of_all_classes():
    every = "".join(map(chr, range(0x250))) + "日本 \U0001F600x y"
    data = np.frombuffer(every.encode(), np.uint8)
    hashes, first = lexical.slice_terms(data, np.array([0, len(data)]))
    assert len(hashes) == len(terms(every)) == first[-1]
