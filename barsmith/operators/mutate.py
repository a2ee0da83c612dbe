"""New table states as pure functions of the old state; `tables` writes them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barsmith import fixed
from barsmith.operators.dedup import keep_first
from barsmith.operators.joins import not_stored, without

BAR_VALUES = (*fixed.PRICES, "volume")


def value_range(df: DataFrame, column: str) -> tuple:
    """(min, max) of one column, as two values."""
    return tuple(df.agg(F.min(column), F.max(column)).first())


def append_new(new: DataFrame, stored: DataFrame, keys: Sequence[str], range_column: str) -> DataFrame:
    """Rows of `new` that `stored` lacks. Duplicates inside `new` stay.

    The batch's range goes to the stored scan as two literals, so it prunes partitions.
    """
    low, high = value_range(new, range_column)
    return not_stored(new, stored.where(F.col(range_column).between(F.lit(low), F.lit(high))), keys)


def first_per_row_id(source: DataFrame, order: Sequence) -> DataFrame:
    """The first source row of each row_id, as one target row may take one source row only."""
    return keep_first(source, ["row_id"], order)


def upsert(target: DataFrame, source: DataFrame, key: str = "row_id",
           values: Sequence[str] = BAR_VALUES, large: bool = False) -> DataFrame:
    """Target with matched rows' values replaced (by NULL too) and new rows added.

    Matched rows keep every other column of the target. `source` holds each key once. A small source is broadcast to the target, whose
    rows then stay where they are; a `large` one, of about the target's size, meets it in one full outer join that reads both once.
    """
    t, s = target.alias("t"), source.withColumn("_in", F.lit(True)).alias("s")
    new = F.col("s._in").isNotNull()
    if large:
        t = target.withColumn("_old", F.lit(True)).alias("t")
        pick = [F.when(new if c in values else F.col("t._old").isNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                for c in target.columns]
        return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full").select(*pick)
    kept = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "left").select(*[
        (F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
        for c in target.columns])
    known = target.select(key).join(source.select(key), key, "left_semi")
    return kept.unionByName(source.join(known, key, "left_anti").select(*target.columns))


def last_entries(changes: DataFrame, sequence: str) -> DataFrame:
    """Of each row id's entries the one of the highest sequence number."""
    columns = [c for c in changes.columns if c != sequence]
    last = changes.groupBy("row_id").agg(F.max_by(F.struct(*columns), sequence).alias("e"))
    return last.select(*[f"e.{c}" for c in columns])


def resolve(stored: DataFrame, last: DataFrame) -> DataFrame:
    """Stored rows with one entry per row id applied: a tombstone (`gone`) removes its row, any other entry upserts."""
    dead, alive = last.where("gone").select("row_id"), last.where("NOT gone")
    return upsert(stored.join(dead, "row_id", "left_anti").select(*stored.columns), alive.select(*stored.columns))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; rows where it is NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def in_range(start, end, column: str = "trade_date") -> Column:
    return F.col(column).between(F.lit(start), F.lit(end))


def is_temp() -> Column:
    return F.col("exchange") == fixed.TEMP_EXCHANGE


def delete_scrips(df: DataFrame, scrips: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows of the listed scrips removed; with `condition`, only those for which it is true."""
    if condition is None:
        return without(df, scrips)
    hit = scrips.select("scrip").distinct().withColumn("_hit", F.lit(True))
    return delete_where(df.join(hit, "scrip", "left"),
                        F.col("_hit") & condition).select(*df.columns)


def range_reload(stored: DataFrame, clean: DataFrame, lifetime: DataFrame, flagged: DataFrame,
                 start, end, clear_temp: bool = True) -> DataFrame:
    """State after a range reload: no TEMP rows, nothing old in the range or of flagged scrips,
    then the clean range rows and the flagged scrips' whole history.

    All rows the two uploads could match are gone by then, so a union serves and the stored
    table is not shuffled.
    """
    kept = delete_where(stored, in_range(start, end))
    if clear_temp:
        kept = delete_where(kept, is_temp())
    return (delete_scrips(kept, flagged).unionByName(clean.select(*stored.columns))
            .unionByName(lifetime.select(*stored.columns)))
