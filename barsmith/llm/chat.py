"""Chat formatting: collapse cumulative snapshots to maximal conversations, then render them.

A log often holds a conversation once per turn, each row set a prefix of the next. Every turn hashes to 128 bits with its
position; the running XOR of a conversation's turn hashes identifies each of its prefixes. A conversation whose
whole hash is a proper prefix of another one goes (anti join); of equal conversations the smallest conv_id stays.

Positions and running hashes come in two levels: within spans of SPAN turn numbers, and over the spans' totals. So
one conversation that holds a third of all turns still spreads over tasks. Rendering returns one row per span.

Defined cases: turns are ordered by (turn, role, text), nulls first, and repeated rows count once; a null role renders
as `user`, a null text as empty; a null conv_id is a conversation of its own; an empty table gives an empty result;
extra columns are ignored. Markers inside a text are defused by a space (`<|` becomes `< |`).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPAN = 256


def _same(a: str, b: str, *names: str):
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return cond


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, span, turn, role, text, pos (from 1) and p1, p2, the hash of the first `pos` turns."""
    base = turns.select("conv_id", "turn", "role", "text").distinct().withColumn(
        "span", F.floor(F.coalesce(F.col("turn"), F.lit(0)) / SPAN))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    local = base.withColumn("at", F.row_number().over(Window.partitionBy("conv_id", "span").orderBy(*order)))
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("conv_id", "span").agg(F.count("*").alias("n")).select(
        "conv_id", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    placed = (local.alias("l").join(sizes.alias("s"), _same("l", "s", "conv_id", "span"))
              .select("l.*", (F.col("s.skip") + F.col("l.at")).alias("pos"))
              .withColumn("h1", F.xxhash64(F.lit(1), "pos", "role", "text", F.col("role").isNull(), F.col("text").isNull()))
              .withColumn("h2", F.xxhash64(F.lit(2), "text", "role", "pos", F.col("text").isNull(), F.col("role").isNull())))
    inside = Window.partitionBy("conv_id", "span").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = placed.groupBy("conv_id", "span").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")).select(
        "conv_id", "span", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("b2"))
    running = placed.withColumn("r1", F.bit_xor("h1").over(inside)).withColumn("r2", F.bit_xor("h2").over(inside))
    return running.alias("r").join(spans.alias("s"), _same("r", "s", "conv_id", "span")).select(
        "r.conv_id", "r.span", "r.turn", "r.role", "r.text", "r.pos", F.col("r.r1").bitwiseXOR(F.col("s.b1")).alias("p1"),
        F.col("r.r2").bitwiseXOR(F.col("s.b2")).alias("p2"))


def maximal(hashes: DataFrame) -> DataFrame:
    """conv_id and n of the conversations that are no proper prefix of another one, the smallest id of equal ones."""
    ends = hashes.groupBy("conv_id").agg(F.max(F.struct("pos", "p1", "p2")).alias("e")).select(
        "conv_id", F.col("e.pos").alias("n"), F.col("e.p1").alias("p1"), F.col("e.p2").alias("p2"))
    whole = ends.groupBy("n", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = (hashes.alias("h").join(ends.alias("e"), _same("h", "e", "conv_id")).filter("h.pos < e.n")
             .select(F.col("h.pos").alias("n"), "h.p1", "h.p2").distinct())
    return whole.join(inner, ["n", "p1", "p2"], "left_anti").select("conv_id", "n", "copies")


def render(role, text):
    """One turn in ChatML."""
    safe = [F.replace(F.coalesce(c, F.lit(d)), F.lit("<|"), F.lit("< |")) for c, d in ((role, "user"), (text, ""))]
    return F.concat(F.lit("<|im_start|>"), safe[0], F.lit("\n"), safe[1], F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, part (turn number / SPAN), n_turns of the conversation, copies logged and the part's rendered text."""
    hashes = prefix_hashes(turns)
    keep = maximal(hashes)
    kept = hashes.alias("h").join(keep.alias("k"), _same("h", "k", "conv_id")).select(
        "h.conv_id", "h.span", "h.pos", render(F.col("h.role"), F.col("h.text")).alias("line"), "k.n", "k.copies")
    return kept.groupBy("conv_id", F.col("span").alias("part")).agg(
        F.max("n").alias("n_turns"), F.max("copies").alias("copies"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "").alias("text"))
