"""Corpus cleaning: toxicity, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs. All but the
last return the columns of `documents`. Decisions are on rows, named by doc_id and a hash of the text or by the latter alone: rows
without a doc_id, and rows that share one, are each judged by their own text.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm import bpe, decontaminate, ngram_join, suffix_dedup, toxicity
from barsmith.llm.arrays import tuned
from barsmith.session import configure, ship, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BROADCAST_ROWS = 1_000_000  # of row keys: 16 MB
#: SQL does not express these stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def without(docs: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key, nulls included, is not in `gone`, which is broadcast up to BROADCAST_ROWS and else shuffled."""
    gone = stage(gone.select(*key).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    rows = docs.select(*COLUMNS, ngram_join.text_hash())
    return rows.alias("d").join(gone.alias("g"), [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in key], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The classifier learns from `labels` and the documents at hand."""
    tuned(ship(configure(spark)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.with_scores(docs.select(*COLUMNS), labels).filter("score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the least doc_id stays, of several the one of least text hash, of rows equal in both
    one; so do all rows without words, but for repeated ones with a doc_id."""
    tuned(ship(configure(spark)))
    found = stage(ngram_join.row_components(docs), "components")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    linked = found.filter("n > 0").select("doc_id", "text_hash", "component", order.alias("at"))
    groups = linked.groupBy("component").agg(F.min("at").alias("first"), F.max("at").alias("end")).filter("first != end")
    left = without(docs, linked.join(groups, "component").filter("at != first"), ["doc_id", "text_hash"])
    twice = stage(found.filter("doc_id IS NOT NULL OR n > 0").groupBy("doc_id", "text_hash").count().filter("count > 1"), "twice")
    if twice.isEmpty():
        return left.select(*COLUMNS)
    once = without(left, twice, ["doc_id", "text_hash"])
    again = left.alias("d").join(twice.alias("g"), [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in ("doc_id", "text_hash")], "left_semi")
    again = again.groupBy("doc_id", "text_hash").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return once.select(*COLUMNS).unionByName(again).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice go from the texts; a character cut in two goes with them. All rows stay."""
    tuned(ship(configure(spark)))
    done = suffix_dedup.dedup(docs, carry=("lang", "source"))
    return done.select("doc_id", F.col("kept_text").alias("text"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
                       F.length("kept_text").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    tuned(ship(configure(spark)))
    texts = docs.select(ngram_join.text_hash().alias("doc_id"), "text")
    found = decontaminate.contaminated(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.select(F.col("doc_id").alias("text_hash")), ["text_hash"]).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and the ids as little-endian unsigned 32-bit integers."""
    tuned(ship(configure(spark)))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("suffix_dedup", cut_repeats),
          ("decontaminate", drop_contaminated), ("byte_bpe", tokenise)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
