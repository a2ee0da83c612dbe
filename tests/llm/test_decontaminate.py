import random

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import decontaminate as d


def norm(text):
    raw = (text or "").encode()
    return d.normalise(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tobytes().strip()


def plain_distance(item, text):
    """Least edit distance of the item to a substring, by the textbook table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        k = rng.randrange(len(s))
        rng.choice([lambda: s.insert(k, rng.choice("aeiou ")), lambda: s.pop(k), lambda: s.__setitem__(k, rng.choice("aeiou"))])()
    return "".join(s)


def test_distance_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(1, 70))).encode() for _ in range(2))
        assert d.best_match(a, b)[0] == plain_distance(a, b)


def test_normalise():
    texts = ["  Ab,,c!\n", "", None, "é-É 9", "..."]
    raw = pa.array(texts)
    from barsmith.llm.arrays import text_slices
    for _, _, data, offsets in text_slices(raw):
        out, begin = d.normalise(data, offsets)
        assert [out[begin[i]:begin[i + 1]].tobytes() for i in range(5)] == [b"ab c  ", b" ", b" ", "é É 9 ".encode(), b" "]


@pytest.mark.parametrize("rate", [0, .05, .1])
def test_recall_on_edited_passages(rate):
    rng = random.Random(7)
    items = [(i, sentence(rng, rng.randint(12, 60))) for i in range(60)]
    index, rows, want = d.Index(items), [], set()
    for k in range(240):
        i, text = items[k % 60]
        passage = edited(rng, text, int(rate * len(text)))
        whole = f"{sentence(rng, rng.randint(0, 80))} {passage} {sentence(rng, rng.randint(0, 80))}"
        rows.append(whole)
        if plain_distance(norm(text), norm(whole)) <= int(d.MAX_RATE * len(norm(text))):
            want.add((k, i))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(240)), "text": rows})
    got = [r for b in d.search([batch], index) for r in b.to_pylist()]
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found & want) >= .95 * len(want)
    for r in got:  # whatever is reported holds the item within the limit
        text = norm(items[r["item_id"]][1])
        assert plain_distance(text, norm(rows[r["doc_id"]])) <= r["distance"] <= int(d.MAX_RATE * len(text))
    assert len(got) == len(found)


def test_documents(spark):
    rng = random.Random(2)
    a, b = sentence(rng, 30), sentence(rng, 25)
    docs = spark.createDataFrame(
        [(1, f"x {a} y", 1), (1, f"x {a} y", 1), (2, "", 2), (3, None, 3), (4, sentence(rng, 20000) + " " + b, 4), (None, a.upper(), 5),
         (6, sentence(rng, 300), 6), (7, a[:len(a) // 2], 7), (8, f"{b}. {a}", 8)], "doc_id long, text string, item_id long")
    items = spark.createDataFrame([(10, a), (11, b), (12, a + "!"), (13, "too short"), (14, None)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.distance) for r in d.contaminated(docs, items).collect())
    assert got == [(0, 10, 0), (0, 12, 0), (1, 10, 0), (1, 10, 0), (1, 12, 0), (1, 12, 0), (4, 11, 0),
                   (8, 10, 0), (8, 11, 0), (8, 12, 0)]
    assert d.contaminated(docs, items.filter("item_id > 99")).count() == 0
    assert d.contaminated(docs.filter("doc_id > 99"), items).count() == 0


def found_in(rows, index):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(rows))), "text": rows})
    return {(r["doc_id"], r["item_id"]) for b in d.search([batch], index) for r in b.to_pylist()}


@pytest.mark.parametrize("n", [9, 20, 60])
def test_copies_in_text_without_spaces(n):
    rng = random.Random(n)

    def run(k, letters=[chr(c) for c in (*range(0x4E00, 0x4E80), *range(0x3042, 0x3080), *range(0xE01, 0xE2F))]):
        return "".join(rng.choice(letters) for _ in range(k))
    items = [(i, run(n)) for i in range(40)] + [(40 + i, run(3 * n, "abcdefgh")) for i in range(40)]
    rows = [(run if i < 40 else lambda k: run(k, "abcdefgh"))(rng.randint(1, 50)) + text + run(rng.randint(0, 50)) for i, text in items]
    assert found_in(rows, d.Index(items)) == {(i, i) for i, _ in items}


@pytest.mark.parametrize("rate", [0, .05, .1])
def test_short_items_are_all_found(rate):
    rng = random.Random(3)
    items = [(i, text) for i in range(400) if 24 <= len(text := sentence(rng, rng.randint(4, 16))) <= d.SHORT]
    items += [(1000 + i, sentence(rng, 20)[:rng.randint(24, 40)]) for i in range(100)]
    rows, want = [], set()
    for k, (i, text) in enumerate(items):
        rows.append(f"{sentence(rng, rng.randint(0, 9))}x{edited(rng, text, int(rate * len(text)))}y {sentence(rng, rng.randint(0, 9))}")
        if len(norm(text)) >= d.MIN_ITEM and plain_distance(norm(text), norm(rows[-1])) <= int(d.MAX_RATE * len(norm(text))):
            want.add((k, i))
    assert len(want) > 200 and want <= found_in(rows, d.Index(items))


def test_a_place_is_probed_whatever_stands_before_it():
    rng = random.Random(4)
    items = [(i, "".join(rng.choice("abcdefgh") for _ in range(75)) + " " + sentence(rng, 2)) for i in range(30)]
    rows = [x for i, text in items for x in (sentence(rng, i % 7), text)]
    found = found_in(rows, d.Index(items))
    assert found >= {(2 * i + 1, i) for i, _ in items}
    assert found_in(["a", *rows], d.Index(items)) == {(k + 1, i) for k, i in found}


def test_blocks_one_at_a_time(spark, monkeypatch):
    """Many small blocks find what one block finds."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(repr, d.contaminated(docs, items).collect()))
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(d, "BLOCK_BYTES", 700)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: sent.append(send(self, x)) or sent[-1])
    assert whole and sorted(map(repr, d.contaminated(docs, items).collect())) == whole
    assert len(sent) > 3
    for s in sent:  # each has been given up
        with pytest.raises(Exception):
            s.destroy()
            s.unpersist()
