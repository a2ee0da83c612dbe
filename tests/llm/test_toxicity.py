import itertools
import math
import random
import zlib

import numpy as np
import pytest

from barsmith.llm import toxicity as t

INSULTS = ["blorkhead", "snurfle", "gronkwit", "vexmuppet"]


def plain_kernel(a, b):
    """Gap-weighted subsequences of order three, counted one by one and normalised."""
    def expand(w):
        w = bytes([2]) + w + bytes([3])
        out = {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i <= t.SPAN:
                key = (w[i], w[j], w[k])
                out[key] = out.get(key, 0) + t.DECAY ** (k - i)
        return out
    x, y = expand(a), expand(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))


def test_kernel_matches_counting():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcd\xc3\xa9") for _ in range(rng.randint(1, 24))) for _ in range(30)]
    word, code, value = t.subsequences(words)
    maps = [dict(zip(code[word == i].tolist(), value[word == i].tolist())) for i in range(len(words))]
    for i, j in itertools.combinations_with_replacement(range(len(words)), 2):
        assert sum(v * maps[j].get(k, 0) for k, v in maps[i].items()) == pytest.approx(plain_kernel(words[i], words[j]))


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice(["ta", "ro", "min", "el", "su", "ka", "or"]) for _ in range(rng.randint(1, 4))) for _ in range(500)]
    texts, labels = [], []
    for i in range(n):
        ws = [rng.choice(base) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < .25
        for _ in range(rng.randint(2, 4) if toxic else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(INSULTS) + rng.choice(["", "", ".", "!!", ","]))
        texts.append(" ".join(ws).capitalize() + ".")
        labels.append(int(toxic if rng.random() > .03 else not toxic))
    return texts, labels


@pytest.fixture(scope="module")
def trained(spark):
    texts, labels = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, x) for i, x in enumerate(labels)], "doc_id long, quality int, toxic int")
    return docs, marks, labels


def test_held_out_accuracy(trained):
    docs, marks, labels = trained
    got = t.score_documents(docs, marks).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(labels)))
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > .93


def test_gaps_and_inserted_characters(trained, spark):
    docs, marks, _ = trained
    odd = ["karo elmin blork-head taro", "karo elmin s*n*u*r*f*l*e taro", "karo elmin g r o n k w i t taro", "karo elmin vexxmuppet taro",
           "karo elmin taro", "", None, "!!! ... 123", "karo " * 4000 + "elmin " + "x" * 3000]
    more = spark.createDataFrame([(10_000 + i, x) for i, x in enumerate(odd)], "doc_id long, text string")
    got = {r.doc_id - 10_000: r for r in t.score_documents(docs.unionAll(more), marks).filter("doc_id >= 10000").collect()}
    assert [got[i].toxic_words > 0 for i in range(len(odd))] == [True] * 4 + [False] * 5
    assert all(got[i].predicted == 0 for i in range(4, 9))
    assert got[0].score > got[4].score and got[5].score == got[6].score


def test_held_out_labels_do_not_matter(trained, spark):
    docs, marks, labels = trained
    flipped = spark.createDataFrame([(i, 1, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, x in enumerate(labels)],
                                    "doc_id long, quality int, toxic int")
    a, b = ({r.doc_id: r.score for r in t.score_documents(docs, m).collect()} for m in (marks, flipped))
    assert a == b


def test_few_labels_still_rank(spark):
    """A dozen toxic texts, each with insults of its own that hardly repeat: no word is common among them."""
    texts, labels = corpus()
    bad, good = ([x for x, y in zip(texts, labels) if y == k] for k in (1, 0))
    few = bad[:12] + good[:60]
    docs = spark.createDataFrame(list(enumerate(few)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i < 12)) for i in range(72)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in t.score_documents(docs, marks).collect()}
    assert len(set(got.values())) > 1
    assert np.mean([got[i] for i in range(12)]) > np.mean([got[i] for i in range(12, 72)]) + .1
    wordless = spark.createDataFrame([(i, "!!" if i < 6 else "a quiet text") for i in range(40)], "doc_id long, text string")
    flat = t.score_documents(wordless, spark.createDataFrame([(i, 1, int(i < 6)) for i in range(40)], "doc_id long, quality int, toxic int"))
    assert all(0 < r.score < .5 for r in flat.collect())


def test_repeated_rows_and_clashing_columns(trained, spark):
    docs, marks, _ = trained
    once = {r.doc_id: r.score for r in t.score_documents(docs, marks).collect()}
    again = t.score_documents(docs.unionAll(docs.filter("doc_id % 5 = 0")).withColumn("score", t.F.lit("x")).withColumn("toxic", t.F.lit(1)), marks)
    assert len(set(once)) == docs.count() and again.count() == docs.count() + docs.filter("doc_id % 5 = 0").count()


def test_training_text_is_bounded(trained, spark, monkeypatch):
    docs, marks, labels = trained
    monkeypatch.setattr(t, "TRAIN_BYTES", 4000)
    monkeypatch.setattr(t, "MIN_TEXTS", 1)
    got = t.score_documents(docs, marks).collect()
    assert len(got) == len(labels) and len({r.score for r in got}) > 1


def test_nothing_to_learn(trained):
    docs, marks, _ = trained
    got = t.score_documents(docs, marks.filter("toxic = 0")).agg({"score": "max", "doc_id": "count"}).first()
    assert sorted(got) == [0.0, 700]
    assert t.score_documents(docs.filter("doc_id < 0"), marks).count() == 0
