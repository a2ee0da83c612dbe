import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barsmith.llm import merkle

UPPER = {c: c + 32 for c in range(65, 91)}


def h(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def expected(rows):
    """Rows of (doc_id, leaf, subroot, root, proof, folded root, verified), by the contract, without kept states."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}

    def build(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    levels = {s: build([leaf_of(r) for r in of[s]]) for s in sources}
    top = build([levels[s][-1][0] for s in sources])
    result = []
    for k, s in enumerate(sources):
        for pos, r in enumerate(of[s]):
            path = [(level, pos // 16 ** i) for i, level in enumerate(levels[s][:-1])] + [(level, k // 16 ** i) for i, level in enumerate(top[:-1])]
            tamper = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            node, proof = leaf_of((*r[:4], r[4].translate(UPPER)) if tamper else r), ""
            for level, at in path:
                first = at // 16 * 16
                before, behind = "".join(level[first:at]), "".join(level[at + 1:first + 16])
                proof, node = proof + before + behind, h(before + node + behind)
            result.append((r[0], leaf_of(r), levels[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(result, key=repr)


def found(spark, rows, parts=6, **options):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int")
    df = df.repartition(parts)
    return sorted((tuple(r) for r in merkle.manifest(df, merkle.tampered(df), **options).collect()), key=repr)


def corpus(rng, n, sources):
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "Abc É", "abc", f"Text {i}"])) for i in range(n)]


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_against_plain_trees(spark, depth):
    rng = random.Random(depth)
    rows = corpus(rng, 700, ["hot"] * 40 + [None, "", "é", "Z", "a", "\U0001F600", "￿"] + [f"s{i}" for i in range(30)])
    rows += [(5, "hot", "en", 1, "Other"), (6, "hot", "en", 1, "Same")] + [(6, "hot", "en", 1, "Same")] * 40
    rows += [(None, None, None, None, None), (None, "hot", "de", 3, "No id"), (-7, "hot", "en", 2, "x" * 300000 + "É")]
    assert found(spark, rows, depth=depth) == expected(rows)


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (256,), (257, 16, 1), (1,) * 17])
def test_sizes_at_the_edges(spark, sizes):
    rows = [(1000 * s + i, f"s{s:02}", "en", i, f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    assert found(spark, rows) == expected(rows)


def test_more_than_one_group(spark):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(4098)] + [(-1, "b", None, 0, "B")]
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_untouched_rows(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(i, "a", "en", 1, "T") for i in range(40)], "doc_id long, source string, lang string, n_chars long, text string")
    assert all(r.verified and r.folded_root == r.root for r in merkle.manifest(df).collect())
    changed = merkle.manifest(df, F.when(F.col("doc_id") == 3, F.lit("other"))).collect()
    assert [r.doc_id for r in changed if not r.verified] == [3]


def test_kept_states_equal_hashing_anew():
    rng = random.Random(1)
    for n in (1, 2, 15, 16):
        run = rng.randbytes(32 * n)
        p = merkle.Parent(run)
        assert p.digest == merkle.parent(run) and len(p.before) == n
        for slot in range(n):
            new = rng.randbytes(32)
            assert p.replaced(slot, new) == merkle.parent(run[:32 * slot] + new + run[32 * slot + 32:])
