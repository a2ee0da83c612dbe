import random
import re
from collections import Counter

import numpy as np
import pytest

from barsmith.llm import graph, ngram_join
from barsmith.llm.graph import components


def shingle_set(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute_force(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((root(a), root(b)))
                top[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, n=140):
    """Families of texts that drift word by word, so that chains of links reach further than 0.75; common lines."""
    rng = random.Random(seed)
    line = " ".join(rng.choice("abcdefgh") for _ in range(9))
    texts = []
    while len(texts) < n:
        size = rng.choice([1, 3, 4, 5, 6, 8, 10, 12, 15, 20, 30, 45, 60, 90, 150, 260])
        ws = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(rng.choice([1, 2, 3, 6])):
            texts.append(" ".join(ws))
            ws = list(ws)
            for _ in range(rng.choice([0, 1, 1, 2, max(1, size // 60)])):
                k = rng.randrange(len(ws)) if ws else 0
                rng.choice([lambda: ws.insert(k, "new"), lambda: ws.pop(k) if len(ws) > 1 else 0,
                            lambda: ws.append(f"x{rng.randrange(99)}"), lambda: ws.pop()if len(ws) > 1 else 0])()
        if rng.random() < .3:
            texts.append(line + " " + texts[-1])
        if rng.random() < .2:
            texts.append(line)
    texts += ["", None, " \t ", texts[0].upper(), texts[1].replace(" ", "\n "), "a b c", "A  b c", "a b", "a b c d e f"]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(docs).collect()}
    assert got == brute_force(rows)


def test_similar_sets_share_a_strong_signature():
    """The guarantee of the method, set by set: without the leader step, at exactly the allowed difference."""
    rng = np.random.default_rng(5)
    ends = ngram_join.bands(3000)
    for n in [*range(1, 60), 100, 333, 1000, 2500]:
        for m in {n, (n + n * 4 // 3) // 2, n * 4 // 3}:
            both = -(-3 * (n + m) // 7)
            if both > n:
                continue
            h = rng.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
            a, b = h[:n], np.concatenate([h[:both], h[n:]])
            common = rng.random(len(h)) < .1
            found = []
            for s, c in ((a, common[:n]), (b, np.concatenate([common[:both], common[n:]]))):
                band = np.searchsorted(ends, len(s), "right") - 1
                signs = set()
                for inst in (ngram_join.Instance(k, ends) for k in range(max(band - 1, 0), band + 1)):
                    for _, x, slot, _, sent in inst.signatures(s, np.array([0, len(s)]), ~c):
                        signs |= {(inst.b, slot, int(inst.need(np.array([len(s)]), sent)[0]), int(v)) for v in x}
                found.append(signs)
            shared = [Counter((b, slot) for b, slot, _, v in own if v in {x[3] for x in other})
                      for own, other in (found, found[::-1])]
            needs = [{(b, slot): need for b, slot, need, _ in own} for own in found]
            assert any(shared[0][k] >= needs[0][k] and shared[1][k] >= needs[1][k] for k in needs[0].keys() & needs[1].keys()), (n, m)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (7, None, "z")],
                                 "doc_id long, text string, sign string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.join_documents(docs).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (7, 0, 7)]
    assert ngram_join.join_documents(docs.filter("doc_id = 99")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}


def test_rows_link_by_their_own_text(spark):
    """Rows without a doc_id close a chain; two texts under one doc_id link each on its own."""
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[:100]), " ".join(words[10:110]), " ".join(words[20:120])]
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(5, chain[0]), (None, chain[1]), (9, chain[2]), (7, other), (7, "x y z"), (8, other + " end"), (3, "x y z"),
            (None, "alone"), (None, "alone"), (None, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n long").repartition(3)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_join.join_documents(docs).collect())
    assert got == sorted([(5, 96, 5), (0, 96, 5), (9, 96, 5), (7, 56, 7), (7, 1, 3), (8, 57, 7), (3, 1, 3), (0, 1, 0), (0, 1, 0), (0, 0, 0)])


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_shuffles_go_when_their_result_is_written(spark):
    """Beside the input, disk holds one step's shuffle, not those of all steps until the driver collects its garbage."""
    docs = spark.createDataFrame(corpus(4, 60), "doc_id long, text string").coalesce(1)
    blocks = ngram_join.signature_blocks(docs, ngram_join.bands(300), np.array([], np.uint64), 1)
    before = shuffle_bytes(spark)
    shared = ngram_join.stage_freed(ngram_join.shared_signatures(blocks, 1), "signatures")
    assert shuffle_bytes(spark) <= before
    assert shared.groupBy("sign").count().count() == shared.select("sign").distinct().count() > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert not hasattr(ngram_join, "stage") and not hasattr(graph, "stage")  # all steps do so


def test_shared_signatures_are_numbered(spark):
    """The numbers name the same groups of documents as the hashes, and keep the slot."""
    docs = spark.createDataFrame([r for r in corpus(5) if r[1]], "doc_id long, text string").coalesce(1)
    blocks = ngram_join.signature_blocks(docs, ngram_join.bands(300), np.array([], np.uint64), 2)
    want = {}
    for r in blocks.collect():
        if r.shard < 4:
            half = len(r.block) // 2
            for sign, doc in zip(ngram_join.from_delta_planes(bytes(r.block[:half])), ngram_join.from_planes(bytes(r.block[half:]))):
                want.setdefault((r.shard, int(sign)), []).append(int(doc))
    got = {}
    for r in ngram_join.shared_signatures(blocks, 2).filter("need IS NULL").collect():
        got.setdefault(r.sign, []).append(r.doc_id)
    assert Counter((sign & 15, *sorted(d)) for sign, d in got.items()) == Counter(
        (sign & 15, *sorted(d)) for (_, sign), d in want.items() if len(d) > 1)
    assert got and {s >> 44 for s in got} <= set(range(4))
    for shard in range(4):
        numbers = sorted(s >> 4 & (1 << 36) - 1 for s in got if s >> 44 == shard)
        assert numbers == [*range(1, len(numbers) + 1)]
