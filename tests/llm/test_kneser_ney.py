import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import kneser_ney
from barsmith.llm.arrays import text_slices

TEXTS = ["The cat sat on the mat", "the cat ran\ton the  mat .", "a cat sat", "the dog sat on a log", "the cat sat on the mat", "",
         None, "Dog dog dog dog", "on the mat the cat sat on the log a dog ran", "É é ÉTÉ the", "cat the cat the cat the cat"] * 2


def tokens(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lower), "</s>"]


def brute_force(train, order):
    """Textbook interpolated modified Kneser-Ney with continuation counts below the highest order."""
    levels = {order: Counter()}
    raw = Counter()
    for t in train:
        ws = tokens(t)
        raw.update(ws)
        padded = ["<s>"] * (order - 1) + ws
        levels[order].update(tuple(padded[i:i + order]) for i in range(len(ws)))
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    stats = {}
    for n, grams in levels.items():
        cc = Counter(grams.values())
        by = defaultdict(Counter)
        for g, c in grams.items():
            by[g[:-1]]["total"] += c
            by[g[:-1]][min(c, 3)] += 1
        if all(cc[k] for k in (1, 2, 3, 4)):
            y = cc[1] / (cc[1] + 2 * cc[2])
            d = [0, 1 - 2 * y * cc[2] / cc[1], 2 - 3 * y * cc[3] / cc[2], 3 - 4 * y * cc[4] / cc[3]]
            d = [min(max(x, 0), k) for k, x in enumerate(d)]
        else:
            d = [0, .5, 1.0, 1.5]
        stats[n] = (grams, by, d)

    def p(gram):
        if not gram:
            return 1 / (len(raw) + 1)
        grams, by, d = stats[len(gram)]
        s = by.get(gram[:-1])
        if not s:
            return p(gram[1:])
        c = grams[gram]
        return (max(c - d[min(c, 3)], 0) + sum(d[k] * s[k] for k in (1, 2, 3)) * p(gram[1:])) / s["total"]
    return raw, p


@pytest.mark.parametrize("order", [2, 3])
def test_scores_match_a_textbook_model(spark, order):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in kneser_ney.score_documents(docs, order=order).collect()}
    train = [t for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10]
    raw, p = brute_force(train, order)
    n, v = sum(raw.values()), len(raw)
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ws, r = tokens(t), got[i]
        padded = ["<s>"] * (order - 1) + ws
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(raw[w] > 0 for w in ws), n)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(sum(math.log10((raw[w] + .1) / (n + .1 * (v + 1))) for w in ws))
        assert r.score == pytest.approx(sum(math.log10(p(tuple(padded[k:k + order]))) for k in range(len(ws))))


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    train = [t for i, t in enumerate(TEXTS) if zlib.crc32(str(i).encode()) % 10]
    raw, _ = brute_force(train, 2)
    meta = kneser_ney.train(docs.filter(~kneser_ney.held_out(10)).select("text"))
    model = kneser_ney.Model(meta)
    for _, _, data, offsets in text_slices(pa.array([w for w in sorted(raw) if w != "</s>"])):
        seq, begin = kneser_ney.sequences(data, offsets, 2)
        ids = [int(seq[b]) for b in begin]
    every = np.array([*ids, kneser_ney.END, (1 << 40) - 5], np.uint64)  # all words, the end, an unknown word
    for context in (ids[0], ids[-1], kneser_ney.START):
        assert model.probabilities([np.full(len(every), context, np.uint64), every]).sum() == pytest.approx(1)


def test_words_alone_are_told_apart_by_64_bits(monkeypatch):
    """Two words whose hashes agree in their first 40 bits, a third that hashes to the mark of starts, and an end."""
    hashes = np.array([(7 << 24) + 1, (7 << 24) + 2, 0, 5], np.uint64)
    monkeypatch.setattr(kneser_ney, "words", lambda data, offsets: (hashes.copy(), np.array([0, 3, 4])))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c", "d"])], names=["text"])
    seq, begin, single = kneser_ney.with_words(None, None, 3)
    assert seq.tolist() == [0, 0, 7, 7, 2, 1, 0, 0, 2, 1] and begin.tolist() == [2, 8]
    assert single.tolist() == [(7 << 24) + 1, (7 << 24) + 2, 2, 1, 5, 1]
    assert len(single) == len(kneser_ney.grams(seq, begin, 3)[0][0])
    found = {}
    for b in kneser_ney.count_batches([batch], 2, 1):
        for level, block in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            columns, counts = kneser_ney.unpack(block, level)
            found.setdefault(level, Counter()).update({tuple(int(c[i]) for c in columns): int(n) for i, n in enumerate(counts)})
    assert found[kneser_ney.RAW] == {((7 << 24) + 1,): 1, ((7 << 24) + 2,): 1, (2,): 1, (1,): 2, (5,): 1}
    assert found[2][(7, 7)] == 1 and sum(found[2].values()) == 6


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert kneser_ney.score_documents(docs).count() == 0
    alone = spark.createDataFrame([(None, "a b")], "doc_id long, text string")  # crc32('') is 0: held out
    r = kneser_ney.score_documents(alone).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) == (True, 3, 0, 0, 0.0)


def compare(scored, texts):
    raw, p = brute_force([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10], kneser_ney.ORDER)
    n, v, seen = sum(raw.values()), len(raw), {}
    assert {r.doc_id for r in scored} == texts.keys() and len(scored) == len(texts)
    for r in scored:
        ws = tokens(texts[r.doc_id])
        pairs = list(zip(["<s>", *ws], ws))
        seen.update({pair: math.log10(p(pair)) for pair in pairs if pair not in seen})
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(raw[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((raw[w] + .1) / (n + .1 * (v + 1))) for w in ws))
        assert r.score == pytest.approx(sum(seen[pair] for pair in pairs))


def test_the_query_matches_a_textbook_model(spark):
    from barsmith.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    compare(QUERIES["op4_kneser_ney"](spark, sf).collect(), texts)


def test_a_very_long_text(spark):
    texts = {1: " ".join(f"w{i * i % 7919}" for i in range(400_000)), 2: "w1 w4 w9", 3: "x" * 2_000_000, 5: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    compare(kneser_ney.score_documents(docs).collect(), texts)
