"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

Filling: a budget of words is shared by weight. Sources whose share exceeds `epochs` times their own words are clamped there, and
the excess goes to the others by weight, round after round, until no share is above its cap. Each round is one row of sums. With each
round the part of the budget that is still unplaced, or the weight still free, at least halves, so rounds stay logarithmic in both.

Sampling: a target of e epochs takes each of the source's documents floor(e) times; the fraction left over is filled, in the order of a
seeded 60-bit hash, with one more repetition of documents up to a hash, the edge. The edge is found by narrowing: words per source and
leading 12 bits, then the next 12 bits within the one cell where the fraction ends, then single hashes. So no document is sorted or
shuffled, however large its source, and only sums travel. The document at the edge is taken in part (its first words),
so that a source gives its target rounded down to a word.

Defined cases: sizes are words [^\\x20\\x09-\\x0D]+, 0 for a null or empty text, and documents of size 0 take nothing; a null source is a
source of its own, for `cyclic_weights` the last; rows that share doc_id, text and source share one hash, and at the edge they share
what is left by size, each rounded down; a source without weight, or of weight 0 or less, has target 0; a source without words has target 0; if all caps
together are below the budget, all sources are at their caps; empty tables give an empty result; extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.session import stage

WORD = r"[^\x20\x09-\x0D]+"
CYCLE, SHARE, EPOCHS, SEED = (5, 2, 1), 1.5, 2, "mix"
BITS, LEVELS = 60, (12, 12, 36)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(seed: str, doc_id: Column, text: Column) -> Column:
    """60 bits of MD5 over seed, doc_id and text: the order in which a source's documents are repeated."""
    named = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """source, doc_id, size and the order hash of every row."""
    return docs.select("source", "doc_id", n_words(F.col("text")).alias("size"),
                       order_hash(seed, F.col("doc_id"), F.col("text")).alias("hash"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The rows staged with `position`, from 0 on, in this order: a range-partitioned sort, and one row of counts per partition."""
    at = F.monotonically_increasing_id()
    parts = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "numbered")
    part, before = F.shiftright("_at", 33), Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return parts.join(starts, part == F.col("_part")).withColumn(
        "position", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")


def cyclic_weights(sources: DataFrame, cycle=CYCLE) -> DataFrame:
    """source, weight: the weights in turn, over the sources by code point, null last."""
    listed = numbered(sources.select("source").distinct(), F.col("source").isNull(), F.col("source"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("position") % len(cycle) + 1).cast("int"))
    return listed.select("source", turn.alias("weight"))


def joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined on source, null equal to null. `right` has a row per source and no hint: AQE broadcasts it by its size at run time, and
    splits hot sources of a sort-merge join beyond that."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def fill(sources: DataFrame, budget: float, epochs: float = EPOCHS) -> DataFrame:
    """Capped water-filling. sources: (source, source_size, weight); adds `target`, in words."""
    able = F.coalesce((F.col("weight") > 0) & (F.col("source_size") > 0), F.lit(False))
    cap = F.col("source_size") * F.lit(float(epochs))

    def sums(level):
        """Words placed at caps and the weight still free, where a source is clamped if `level` words per weight exceed its cap."""
        full = cap < F.col("weight") * F.lit(level)
        return sources.where(able).agg(F.sum(F.when(full, cap)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()

    level, clamped = 0.0, None
    while True:  # the level only rises, so each round clamps another source or is the last
        placed, free = sums(level)
        rising = (budget - (placed or 0.0)) / free if free else float("inf")
        if (placed, free) == clamped:
            break
        level, clamped = rising, (placed, free)
    full = cap < F.col("weight") * F.lit(level)
    rest = F.lit(budget - (placed or 0.0))
    share = F.least(cap, F.col("weight") * rest / F.lit(free)) if free else cap
    return sources.withColumn("target", F.when(able, F.when(full, cap).otherwise(share)).otherwise(0.0))


def edges(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Where each source's fraction ends. sizes: (source, size, hash); wanted: (source, extra), the words of the fractional repetition,
    less than the source's.

    Returns source, edge (documents of a lesser hash are repeated), left (words to take at the edge itself) and edge_size, its words.
    """
    state = wanted.where("extra > 0").select("source", F.lit(0).cast("long").alias("edge"), F.col("extra").alias("left"))
    below = BITS
    for bits in LEVELS:
        above, below = below, below - bits
        prefix = F.shiftright("hash", above)
        inside = joined(sizes, state).where((F.col("size") > 0) & (prefix == F.col("edge")))
        cells = inside.groupBy("source", F.shiftright("hash", below).alias("cell")).agg(
            F.sum("size").alias("words"), F.first("left").alias("left"))
        running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        here = cells.where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
        state = stage(here.select("source", F.col("cell").alias("edge"), (F.col("left") - F.col("before")).alias("left"),
                                  F.col("words").alias("edge_size")), "edges")
    return state


def plan(docs: DataFrame, weights=None, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED):
    """(sizes, sources): every row's source, doc_id, size and hash; per source its words, weight, target, whole repetitions and edge.

    weights: (source, weight), by default CYCLE over the sources; the budget is `share` times all words.
    """
    sizes = stage(sized(docs, seed), "sizes")
    totals = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    weights = cyclic_weights(totals) if weights is None else weights
    sources = stage(joined(totals, weights.select("source", "weight"), "left"), "weighted")
    budget = share * (totals.agg(F.sum("source_size")).first()[0] or 0)
    filled = fill(sources, budget, epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    filled = stage(filled.withColumn("extra", F.floor("target").cast("long") - F.col("whole") * F.col("source_size")), "filled")
    return sizes, joined(filled, edges(sizes, filled.select("source", "extra")), "left")


def _extra(size: Column, hash_: Column) -> Column:
    """Words of the fractional repetition that a document gives."""
    at_edge = F.floor(F.col("left") * size / F.col("edge_size")).cast("long")
    return F.when(hash_ < F.col("edge"), size).when(hash_ == F.col("edge"), at_edge).otherwise(F.lit(0).cast("long"))


def mix(docs: DataFrame, weights=None, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words the mix takes of each document, repetitions counted."""
    sizes, sources = plan(docs, weights, share, epochs, seed)
    taken = F.col("whole") * F.col("size") + _extra(F.col("size"), F.col("hash"))
    return joined(sizes, sources).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each piece: blanks, then a word (the last: perhaps blanks)
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def sample(docs: DataFrame, weights=None, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: doc_id, source, repetition (from 1), text, size; a document once per repetition, the one at the edge cut."""
    _, sources = plan(docs, weights, share, epochs, seed)
    rows = docs.select("doc_id", "source", "text", n_words(F.col("text")).alias("size"),
                       order_hash(seed, F.col("doc_id"), F.col("text")).alias("hash")).where("size > 0")
    rows = joined(rows, sources).withColumn("more", _extra(F.col("size"), F.col("hash")))
    times = F.array_repeat(F.col("size"), F.col("whole").cast("int"))
    sizes = F.when(F.col("more") > 0, F.array_append(times, F.col("more"))).otherwise(times)
    out = rows.select("doc_id", "source", "text", "size", F.posexplode(sizes).alias("at", "part"))
    text = F.when(F.col("part") < F.col("size"), first_words(F.col("text"), F.col("part"))).otherwise(F.col("text"))
    return out.select("doc_id", "source", (F.col("at") + 1).alias("repetition"), text.alias("text"), F.col("part").alias("size"))
