"""Whole-table replacement by swapping snapshots.

A table with snapshots is a view over the table that holds its rows, `<table>__s<n>`. A replacement writes a new such table and then
points the view at it, which is one change in the catalog: a reader sees the old rows or the new ones, and one that began before the
swap ends on the old files. A write that fails half-way leaves the view alone. Old snapshots stay until they are released; until then
the view can be pointed back. One writer at a time, as for any table.
"""

from pyspark.sql import DataFrame, SparkSession

from barsmith import tables

MARK = "__s"


def _table(name: str, number: int) -> str:
    return f"{name}{MARK}{number}"


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def current(spark: SparkSession, name: str) -> int:
    """The number of the snapshot the view shows."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
    return int(about["data_type"].rsplit(MARK, 1)[1])


def stored(spark: SparkSession, name: str) -> str:
    """The table that holds the rows: the current snapshot of a view, else the table itself."""
    return _table(name, current(spark, name)) if is_view(spark, name) else name


def numbers(spark: SparkSession, name: str) -> list[int]:
    """All snapshots that have not been released, unfinished ones too, from the catalog alone."""
    database, _, bare = name.rpartition(".")
    listed = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{bare}{MARK}*'").collect()
    ends = (r["tableName"][len(bare + MARK):] for r in listed if r["tableName"].startswith((bare + MARK).lower()))
    return sorted(int(e) for e in ends if e.isdigit())


def _shown(spark: SparkSession, name: str, number: int) -> str:
    return f"SELECT {', '.join(tables.read(spark, _table(name, number)).columns)} FROM {_table(name, number)}"


def ensure(spark: SparkSession, name: str, schema: str, **layout) -> None:
    """Create the view over an empty first snapshot if there is nothing of that name; layout: as `tables.ensure_table` takes it."""
    if not spark.catalog.tableExists(name):
        number = max(numbers(spark, name), default=0) + 1
        tables.ensure_table(spark, _table(name, number), schema, **layout)
        spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {_shown(spark, name, number)}")


def point(spark: SparkSession, name: str, number: int) -> None:
    """Let the view show another snapshot: one change in the catalog."""
    spark.sql(f"ALTER VIEW {name} AS {_shown(spark, name, number)}")


def swap(df: DataFrame, name: str) -> int:
    """Write the rows as a new snapshot of the view's layout, then show it; its number."""
    spark = df.sparkSession
    number = numbers(spark, name)[-1] + 1
    old = stored(spark, name)
    layout = tables.layout_of(spark, old)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.read(spark, old).schema)
    tables.ensure_table(spark, _table(name, number), schema, partition=layout.dated, buckets=layout.buckets, by_month=layout.by_month,
                        by_load=tables.LOAD in layout.units, cluster=layout.cluster)
    tables.append(df, _table(name, number))
    point(spark, name, number)
    return number


def replace(df: DataFrame, name: str) -> None:
    """Replace all rows of a table: by a swap if it has snapshots, else by one overwrite."""
    if is_view(df.sparkSession, name):
        swap(df, name)
    else:
        tables.replace(df, name)


def release(spark: SparkSession, name: str, keep: int = 0) -> list[int]:
    """Drop the snapshots the view does not show, with their files, but for the last `keep` before it; the numbers dropped."""
    now = current(spark, name)
    older = [n for n in numbers(spark, name) if n < now]
    gone = [n for n in numbers(spark, name) if n != now and n not in older[len(older) - keep:]]
    for n in gone:
        spark.sql(f"DROP TABLE {_table(name, n)}")
    return gone
