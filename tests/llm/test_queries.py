"""The registered training-data queries: with SQL against it, the others against a brute-force version of the contract."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from barsmith.llm.queries import ORACLES, QUERIES
from compare import TABLES, rows
from tests.llm.test_ngram_join import brute_force
from tests.llm.test_suffix_dedup import brute_force as cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(sql):
    return dict(sql.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sql, name):
    got, want = QUERIES[name](spark, SF), sql.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_odd_urls(spark, sql):
    from barsmith.llm import url_rules
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "x://example.com/en/", "x://example.com/en", "x://example.com",
            "x://a.net/es/?q#f", "x://a.net?/es/", "x://net/fr/", "x://evilnet/fr/", "x://É.com/", "x://a.com:80/", "x://a.net/es/://b.com/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 3)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.filter_urls(pages).collect()}
    assert got[0] == ("", "", None, "allow") and got[3][:3] == ("", "", None)
    assert got[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[5] == ("example.com", "/en/", "example.com/en/", "block") and got[6] == ("example.com", "/en", "com/", "allow")
    assert got[7][2] is None and got[8] == ("a.net", "/es/", "net/es/", "block") and got[9][:3] == ("a.net", "", None)
    assert got[10][2] == "net/fr/" and got[11][2] is None and got[12][:3] == ("É.com", "/", "com/") and got[13][2] is None
    assert len(got) == len(urls) * 3
    assert url_rules.filter_urls(pages.filter("page_id < 0")).count() == 0


def test_rules_on_any_label_and_segment(spark):
    from barsmith.llm import url_rules
    curated = (("bad.org", "/", "block"), ("good.org", "/", "allow"))
    urls = [f"http://a{i}.b.c.bad.org/x{i}/casino/win/y/z.html" for i in range(20)] + [f"http://a{i}.b.d.good.org/x{i}/news/y/z.html" for i in range(20)]
    new = ["http://q.r.s.t.info/u/v/w/casino/k", "http://q.r.s.t.info/u/news/w/v/k", "http://c.q.info/", "http://d.q.info/", "http://q.info/" + "casinos/" * 9]
    pages = spark.createDataFrame(list(enumerate(urls + new)), "page_id long, url string")
    judged = url_rules.judged_pages(pages, curated)
    sets = url_rules.token_sets(judged)
    kinds = {r.tokens: r.items for r in sets.filter("array_contains(tokens, 'label=q')").selectExpr("array_join(tokens, ' ') tokens", "items").collect()}
    assert all("label=t" in t for t in kinds if "label=s" in t) and len(kinds) == 5
    # Tokens of the very same pages are one item, so a long shared path does not multiply the itemsets.
    assert {i for r in sets.collect() for i in r["items"] if i.endswith(("bad", "casino", "win"))} == {"label=bad"}
    rules = {tuple(r.antecedent): (r.verdict, r.confidence) for r in url_rules.mine_rules(judged, sets).collect()}
    assert rules[("label=bad",)] == ("block", 1.0) and rules[("label=d",)] == ("allow", 1.0) and ("last=z.html",) not in rules
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(pages, curated).collect()}
    assert [got[40 + i] for i in range(5)] == ["block", "allow", "block", "allow", "allow"]
    again = {r.page_id: r.verdict for r in url_rules.filter_urls(pages.unionByName(pages.limit(0)), curated, min_support=1.0).collect()}
    assert set(again[40 + i] for i in range(5)) == {"allow"}


def test_chats_by_hand(spark):
    from barsmith.llm.chat import format_chats
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
             (3, 2, "user", "c"), (4, 0, "user", "a"), (4, 1, "assistant", "b"), (4, 2, "user", "c"), (5, 0, None, "<|x"), (5, 0, None, "<|x"),
             (None, 0, "user", None), *[(6, i, "user", str(i)) for i in range(600)]]
    got = format_chats(spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, part int")).collect()
    assert sorted((r.conv_id or 0, r.n_turns, r.copies) for r in got if r.conv_id != 6) == [(0, 1, 1), (3, 3, 2), (5, 1, 1)]
    assert {r.conv_id: r.text for r in got}[5] == "<|im_start|>user\n< |x<|im_end|>\n"
    long = sorted((r.part, r.text) for r in got if r.conv_id == 6)
    assert [p for p, _ in long] == [0, 1, 2]
    assert re.findall(r"user\n(\d+)<", "".join(t for _, t in long)) == [str(i) for i in range(600)]
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_top_k_by_brute_force(spark):
    from pyspark.sql import functions as F

    from barsmith.llm import topk
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.integers(-4, 4, 8) / 7).tolist()) for i in range(900)]
    vectors += [(40, None), (900, [None] + [.5] * 7), (920, [float("nan")] * 8), (940, [float("inf")] * 8), (960, [.1, .2]), (961, [.3, .4]),
                (980, []), (None, [.1] * 8), (981, [1e12] * 8), (1000, [-1e12] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(7)
    got = topk.top_k(df.select("vec_id", topk.quantised(F.col("embedding")).alias("v")), F.col("vec_id") % 20 == 0).collect()
    ints = {i: [int(np.floor(64 * x)) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in ints if i % 20 == 0):
        want = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q])))[:20]
        assert sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)], q
    assert topk.top_k(df.filter("vec_id < 0").select("vec_id", F.array(F.lit(1).cast("long")).alias("v")), F.col("vec_id") % 20 == 0).count() == 0


def test_contracts_of_text_queries(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_ngram_join"](spark, SF).collect()}
    assert got == brute_force(list(texts.items()))
    want = dict(zip(texts, cut(texts.values())))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    assert got == want
    for r in QUERIES["op6_byte_bpe"](spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    scored = {r.doc_id: r for r in QUERIES["op4_kneser_ney"](spark, SF).collect()}
    assert scored.keys() == texts.keys()
    held = [r for r in scored.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert {r.doc_id for r in QUERIES["op2_toxicity"](spark, SF).collect()} == texts.keys()
    assert QUERIES["op10_html_text"](spark, SF).filter("text = ''").count() == 0


def test_pipeline_stages_take_effect(spark, sql):
    """Each stage against a plain version of its decision, on the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = list(corpus_pipeline.COLUMNS), []
    for name, apply in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = corpus_pipeline.stage(apply(spark, docs, SF), name)
        kept = {r.doc_id: r for r in after.collect()}
        seen.append(name)
        if name == "toxicity":
            bad = {r.doc_id for r in QUERIES["op2_toxicity"](spark, SF).filter("predicted = 1").collect()}
            assert bad and set(kept) == set(before) - bad
        elif name == "ngram_join":
            assert set(kept) == {i for i, (_, top) in brute_force(list(before.items())).items() if top == i}
        elif name == "suffix_dedup":
            want = cut(before.values())
            assert set(kept) == set(before)
            assert all(len(kept[i].text.encode()) <= n - gone for i, (n, gone, _, _) in zip(before, want))
            assert all((kept[i].text == before[i]) == (gone == 0) and kept[i].n_chars == len(kept[i].text) for i, (_, gone, _, _) in zip(before, want))
        elif name == "decontaminate":
            plain = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()))
            items = [plain(t) for _, t in sql.sql("SELECT * FROM benchmark").fetchall()]
            exact = {i for i, t in before.items() if any(x in plain(t) for x in items)}
            assert not exact & set(kept) and len(kept) >= len(before) - len(exact) - 2
        else:
            assert set(kept) == set(before) and all(len(r.ids) == 4 * r.n_tokens for r in kept.values())
        if name != "byte_bpe":
            assert after.columns == columns
        docs = after
    assert seen == ["toxicity", "ngram_join", "suffix_dedup", "decontaminate", "byte_bpe"]
    final = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.ids_sha256) for r in final.collect()} == {(r.doc_id, r.ids_sha256) for r in docs.collect()}


def test_pipeline_on_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (None, None, None, None, None), (2, "", "en", "s", 0),
                                  (3, "a b c d e f", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [(0, 0), (1, 6), (2, 0)]


def test_pipeline_judges_rows_by_their_own_text(spark, tmp_path):
    item = " ".join(f"secret{i}" for i in range(15))
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(1, "a clean text of its own"), (1, f"{item} then eight more words follow up to here"), (None, f"again {item}"), (None, "kept without an id"), (2, near),
            (None, near + " end"), (3, "one text"), (3, "quite another"), (3, "one text"), (None, "same"), (None, "same"), (4, "")]
    spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = corpus_pipeline.stage(corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)), "near")
    assert left.columns == list(corpus_pipeline.COLUMNS)
    got = sorted((r.doc_id or 0, r.text) for r in left.collect())
    assert got == sorted({(i or 0, t) for i, t in rows} - {(0, near + " end")})
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert sorted((r.doc_id or 0, r.text) for r in clean.collect()) == sorted((i or 0, t) for i, t in rows if item not in t)
