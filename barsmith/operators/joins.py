"""Membership joins, safe for NULL keys and for sides that grow.

Lists carry no hint and are not counted: at run time AQE knows a list's size and broadcasts it below
spark.sql.autoBroadcastJoinThreshold; a longer one is shuffled, and AQE splits the hot keys of the other side.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def names(spark, values: Sequence[str], column: str = "scrip") -> DataFrame:
    """A caller's list as a one-column DataFrame."""
    return spark.createDataFrame([(v,) for v in values], f"{column} STRING")


def only(df: DataFrame, listed: DataFrame, on: str = "scrip") -> DataFrame:
    """Rows whose `on` is in the list."""
    return df.join(listed.select(on).distinct(), on, "left_semi")


def without(df: DataFrame, listed: DataFrame, on: str = "scrip") -> DataFrame:
    """Rows whose `on` is not in the list. A NULL in the list removes nothing."""
    return df.join(listed.select(on).distinct(), on, "left_anti")


def subset(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def not_stored(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose keys `stored` lacks; NULL keys match NULL keys.

    One struct key serves the de-duplication of `stored` and the join, so both share a shuffle;
    structs compare NULL fields as equal.
    """
    key = F.struct(*[F.col(k) for k in keys])
    return (new.withColumn("_key", key)
            .join(stored.select(key.alias("_key")).distinct(), "_key", "left_anti")
            .drop("_key"))
