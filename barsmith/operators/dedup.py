"""Keep-first de-duplication and preferred-source choice."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key group in `order`; NULL keys form a group.

    `row_number = 1` lets Spark limit every group before the shuffle, so a hot key sends one row
    per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def prefer_source(rows: DataFrame, cell: Sequence[str], flag: str, preferred) -> DataFrame:
    """Rows of the preferred flag; a cell without any takes the other flag's rows. NULLs form cells like values.

    Each cell's best priority is pre-aggregated to one row, so the join back splits hot cells.
    """
    ranked = rows.withColumn("_p", F.when(F.col(flag) == preferred, 0).otherwise(1))
    # One struct key: structs compare NULL fields as equal.
    keyed = ranked.withColumn("_cell", F.struct(*[F.col(c) for c in cell]))
    best = keyed.groupBy("_cell").agg(F.min("_p").alias("_p"))
    return keyed.join(best, ["_cell", "_p"], "left_semi").drop("_p", "_cell")
