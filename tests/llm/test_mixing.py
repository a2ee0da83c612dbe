import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barsmith.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string"


def filled(sizes, weights, budget, epochs):
    """Clamp and share again until nothing is above its cap."""
    target, free, rest = dict.fromkeys(sizes, 0.0), {s for s in sizes if sizes[s] > 0 and weights.get(s, 0) > 0}, budget
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * rest / total > epochs * sizes[s]}
        if not over:
            return target | {s: weights[s] * rest / total for s in free}
        for s in over:
            target[s] = epochs * sizes[s]
            rest -= target[s]
        free -= over
    return target


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, "clash") for i, s, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fill_against_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": rng.choice([0, 1, 7, 50, 1000, 10**6]) for i in range(25)}
    weights = {s: rng.choice([0.0, 1.0, 2.0, 5.0]) for s in sizes if rng.random() < .9}
    for epochs in (0.5, 2, 40):
        budget = 1.5 * sum(sizes.values())
        df = spark.createDataFrame([(s, n, weights.get(s)) for s, n in sizes.items()], "source string, source_size long, weight double")
        got = {r.source: r.target for r in mixing.fill(df, budget, epochs).collect()}
        assert got == pytest.approx(filled(sizes, weights, budget, epochs))
        assert all(t <= epochs * sizes[s] for s, t in got.items())


def test_targets_are_met_and_documents_are_whole_but_one(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 50 == 0 else rng.choice(["a"] * 9 + ["b", "", "é", "z"]), "w " * rng.randint(0, 40)) for i in range(900)]
    rows += [(1000, "long", "x " * 60000), (1001, "long", "y"), (1002, "lone", "one two three"), (1003, "blank", " \t\n"), (1004, "blank", None)]
    df = frame(spark, rows)
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    sums, odd, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sums[r.source] += r.taken
        target[r.source], whole = r.target, int(r.target // r.source_size) if r.source_size else 0
        odd[r.source] += r.taken not in (whole * r.size, (whole + 1) * r.size)
    assert {s: int(t) for s, t in target.items()} == dict(sums) and max(odd.values()) <= 1
    named = sorted((s for s in target if s is not None)) + [None]
    size = {r.source: r.source_size for r in got}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(named)}
    want = filled(size, weight, 1.5 * sum(size.values()), 2)
    assert target == pytest.approx(want)
    assert [r.taken for r in got if r.source == "blank"] == [0, 0]


def test_repeated_rows_share_the_edge(spark):
    rows = [(None, "a", "one two three four")] * 1000 + [(7, "b", "x " * 100000)]
    weights = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("absent", 5.0)], "source string, weight double")
    got = mixing.mix(frame(spark, rows), weights, share=1.0, epochs=3).collect()
    taken = {r.taken for r in got if r.source == "a"}
    assert len(taken) == 1 and 10396 - 1000 < 1000 * taken.pop() <= 10400
    assert [r.taken for r in got if r.source == "b"] == [93600]


def test_weights_missing_zero_and_empty_tables(spark):
    df = frame(spark, [(1, "a", "x y"), (2, "b", "x y"), (3, "c", "x y")])
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "source string, weight double")
    assert {r.source: r.taken for r in mixing.mix(df, weights).collect()} == {"a": 4, "b": 0, "c": 0}
    empty = mixing.mix(df.where("doc_id < 0"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert mixing.sample(df.where("doc_id < 0")).count() == 0


def test_sample_gives_the_taken_words(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("aaab"), " ".join(str(rng.randint(0, 9)) for _ in range(rng.randint(0, 30))) + rng.choice(["", " \n"])) for i in range(200)]
    df = frame(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken}
    out = mixing.sample(df).collect()
    words = defaultdict(int)
    texts = {i: t for i, _, t in rows}
    for r in out:
        words[r.doc_id] += r["size"]
        assert len(r.text.split()) == r["size"] and texts[r.doc_id].startswith(r.text)
    assert words == taken
    assert sorted(r.repetition for r in out if r.doc_id == out[0].doc_id)[0] == 1


def test_first_words_keep_blanks(spark):
    got = spark.range(1).select(*[mixing.first_words(F.lit("  a\n\nb\tc  "), F.lit(n)).alias(f"n{n}") for n in (1, 2, 3)]).first()
    assert tuple(got) == ("  a", "  a\n\nb", "  a\n\nb\tc")


def test_cyclic_weights_by_code_point(spark):
    names = [None, "", "A", "a", "Z", "é", "\U0001F600", "￿"]
    df = spark.createDataFrame([(n,) for n in names * 3], "source string").repartition(7)
    got = {r.source: r.weight for r in mixing.cyclic_weights(df).collect()}
    ordered = sorted((n for n in names if n is not None), key=lambda s: s.encode()) + [None]
    assert got == {n: (5.0, 2.0, 1.0)[i % 3] for i, n in enumerate(ordered)}
