"""Writing table states: create, append, replace, and mutation of Parquet tables by units.

Parquet tables take no MERGE or DELETE. A unit is one directory of a table: a date (or month) and, where the table has buckets, a hash
bucket of the scrip. A mutation computes the new rows of the units it touches and overwrites those in one job; units left empty are
dropped after. So a change to one scrip rewrites a 1/buckets part of the dates it traded. Temporary rows lie in a bucket of their own:
they go by dropping units, NULL dates included, without reading a file.
"""

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith.functions import columns as fn
from barsmith.operators import mutate
from barsmith.operators.joins import only

PARTITION, MONTH, BUCKET, LOAD = "trade_date", "month", "bucket", "load"
TEMP_BUCKET = -1
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
DROP_AT_ONCE = 500


@dataclass(frozen=True)
class Layout:
    """How a table's rows are dealt to directories. `units` are its partition columns, `dated` the column the first one is or comes from."""

    units: tuple[str, ...] = ()
    dated: str | None = None
    buckets: int = 0
    cluster: tuple[str, ...] = ()  # what rows are sorted by inside a unit, so that files' minima and maxima prune

    @property
    def by_month(self) -> bool:
        return MONTH in self.units

    @property
    def added(self) -> list[str]:
        """Partition columns that are no stored values."""
        return [c for c in self.units if c in (MONTH, BUCKET, LOAD)]

    def place(self, df: DataFrame) -> DataFrame:
        """The rows with their unit columns."""
        if self.by_month:
            df = df.withColumn(MONTH, F.date_format(self.dated, "yyyy-MM"))
        return df.withColumn(BUCKET, self.bucket()) if self.buckets else df

    def bucket(self) -> Column:
        hashed = F.pmod(F.xxhash64("scrip"), F.lit(self.buckets)).cast("int")
        return F.when(F.coalesce(mutate.is_temp(), F.lit(False)), TEMP_BUCKET).otherwise(hashed)

    def first_of(self, day: date):
        """The first unit column's value for a day."""
        return f"{day:%Y-%m}" if self.by_month else day


def ensure_table(spark: SparkSession, name: str, schema: str, partition: str | None = PARTITION, buckets: int = 0,
                 by_month: bool = False, by_load: bool = False, cluster: Sequence[str] = (), location: str | None = None) -> None:
    """Create the table if it is not there. An existing one keeps its own layout. `by_load` adds the load that wrote a row (`commits`)."""
    units = [MONTH if by_month else partition] if partition else []
    added = [f"{MONTH} STRING"] * by_month + [f"{BUCKET} INT"] * bool(buckets) + [f"{LOAD} STRING"] * by_load
    units += [BUCKET] * bool(buckets) + [LOAD] * by_load
    partitioned = f" PARTITIONED BY ({', '.join(units)})" if units else ""
    at = f" LOCATION '{location}'" if location else ""
    kept = f" TBLPROPERTIES ('barsmith.dated' = '{partition or ''}', 'barsmith.buckets' = '{buckets}', 'barsmith.cluster' = '{' '.join(cluster)}')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join([schema, *added])}) USING parquet{partitioned}{at}{kept}")


def layout_of(spark: SparkSession, name: str) -> Layout:
    """A table's layout, from the catalog; one made elsewhere is taken by its partition columns."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    units = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return Layout(units, kept.get("barsmith.dated") or (units[0] if units else None), int(kept.get("barsmith.buckets", 0)),
                  tuple(kept.get("barsmith.cluster", "").split()))


def read(spark: SparkSession, name: str) -> DataFrame:
    """The table's stored columns, without those its layout adds."""
    return spark.table(name).drop(*layout_of(spark, name).added)


def dated(spark: SparkSession, name: str, start, end) -> DataFrame:
    """The stored rows of the dates in [start, end], read from their directories only."""
    layout, (start, end) = layout_of(spark, name), (fn.to_date_arg(start), fn.to_date_arg(end))
    rows = spark.table(name).where(F.col(layout.dated).between(F.lit(start), F.lit(end)))
    if layout.by_month and start is not None and end is not None:
        rows = rows.where(F.col(MONTH).between(layout.first_of(start), layout.first_of(end)))
    return rows.drop(*layout.added)


# ---- writing

def _laid_out(df: DataFrame, name: str, layout: Layout, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows in the table's column order, gathered by unit and sorted by `cluster`.

    `rebalance` gathers small units into few files and splits a hot one over tasks.
    """
    df = layout.place(df).select(*df.sparkSession.table(name).columns)
    if not layout.units:
        return df
    df = df.hint("rebalance", *layout.units)
    cluster = cluster or layout.cluster
    order = [*layout.units, *([layout.dated] if layout.by_month else []), *cluster]
    return df.sortWithinPartitions(*order) if cluster or layout.by_month else df


def append(df: DataFrame, name: str, cluster: Sequence[str] = ()) -> None:
    _laid_out(df, name, layout_of(df.sparkSession, name), cluster).write.insertInto(name)


def replace(df: DataFrame, name: str) -> None:
    """Replace a whole table in one overwrite, whatever the session's overwrite mode."""
    with overwrite_mode(df.sparkSession, "static"):
        _laid_out(df, name, layout_of(df.sparkSession, name)).write.insertInto(name, overwrite=True)


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """Whether an overwrite replaces the partitions it writes ('dynamic') or the whole table ('static')."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


# ---- units

def column_values(df: DataFrame, column: str = PARTITION) -> list:
    """The sorted distinct values of a column that a table is dealt by: as many as it has or gets partitions. NULL is left out."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def units_in(df: DataFrame, layout: Layout) -> set[tuple]:
    """The distinct units the rows lie in, NULL dates too: as many as the table has or gets directories."""
    placed = df if set(layout.units) <= set(df.columns) else layout.place(df)
    return {tuple(r) for r in placed.select(*layout.units).distinct().collect()}


def units_of(spark: SparkSession, name: str, layout: Layout | None = None) -> set[tuple]:
    """The units of a table, from the catalog alone."""
    layout = layout or layout_of(spark, name)
    kind = {c.name: c.dataType for c in spark.catalog.listColumns(name)}

    def value(column: str, text: str):
        if text == NO_PARTITION:
            return None
        return {"date": date.fromisoformat, "int": int, "bigint": int}.get(kind[column], str)(unquote(text))

    found = (dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return {tuple(value(c, spec[c]) for c in layout.units) for spec in found}


def partition_dates(spark: SparkSession, name: str) -> list[date]:
    """The dates (or months) a table has directories for, from the catalog alone."""
    return sorted({u[0] for u in units_of(spark, name) if u[0] is not None})


def units_between(spark: SparkSession, name: str, start, end, layout: Layout | None = None) -> set[tuple]:
    """The table's units whose date, or month, meets [start, end]."""
    layout = layout or layout_of(spark, name)
    low, high = (layout.first_of(fn.to_date_arg(d)) for d in (start, end))
    return {u for u in units_of(spark, name, layout) if u[0] is not None and low <= u[0] <= high}


def _one_of(column: str, values: Iterable) -> Column:
    known = sorted(v for v in values if v is not None)
    listed = F.col(column).isin(known) if known else F.lit(False)
    return listed | F.col(column).isNull() if None in values else listed


def at(df: DataFrame, layout: Layout, units: Iterable[tuple]) -> DataFrame:
    """The rows of these units, by literals the scan prunes by: one pair of lists for all dates that share their buckets."""
    shared: dict[tuple, set] = {}
    for first in {u[0] for u in units}:
        rest = tuple(sorted(u[1:] for u in units if u[0] == first)) if len(layout.units) > 1 else ()
        shared.setdefault(rest, set()).add(first)
    keep = F.lit(False)
    for rest, firsts in shared.items():
        here = _one_of(layout.units[0], firsts)
        keep = keep | (here & _one_of(layout.units[1], {r[0] for r in rest}) if rest else here)
    return df.where(keep)


def overwrite_units(spark: SparkSession, name: str, rows: DataFrame, touched: Iterable[tuple],
                    kept: Iterable[tuple] | None = None) -> None:
    """Make `rows` the whole content of the `touched` units.

    `kept` are those that still have rows, by default found from the rows; the others are dropped. The rows may come from the table
    itself: Spark replaces the old files when the new ones are complete.
    """
    layout = layout_of(spark, name)
    kept = set(units_in(rows, layout) if kept is None else kept)
    if kept:
        with overwrite_mode(spark, "dynamic"):
            _laid_out(rows, name, layout).write.insertInto(name, overwrite=True)
    drop_units(spark, name, set(touched) - kept, layout)


def drop_units(spark: SparkSession, name: str, units: Iterable[tuple], layout: Layout | None = None) -> None:
    """Drop whole units through the catalog; no file is read.

    The catalog keeps the files of a table with a location of its own; they go too, or a later append to the unit would bring them back.
    """
    layout, units = layout or layout_of(spark, name), list(units)

    def literal(column: str, v) -> str:
        return f"{column} = NULL" if v is None else f"{column} = '{v}'"

    specs = [f"PARTITION ({', '.join(map(literal, layout.units, u))})" for u in sorted(units, key=repr)]
    for i in range(0, len(specs), DROP_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(specs[i:i + DROP_AT_ONCE])}")
    if units and spark.catalog.getTable(name).tableType == "EXTERNAL":
        _remove_folders(spark, name, ["/".join(f"{c}={NO_PARTITION if v is None else v}" for c, v in zip(layout.units, u)) for u in units])


def _remove_folders(spark: SparkSession, name: str, folders: Iterable[str]) -> None:
    """Remove folders of a table, in whatever file system it lies."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(about["data_type"]).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for folder in folders:
        files.delete(path(f"{about['data_type']}/{folder}"), True)


# ---- mutations

def upsert(spark: SparkSession, name: str, source: DataFrame, values: Sequence[str] = mutate.BAR_VALUES) -> int:
    """Merge a staged source, unique by row_id, into the table; the number of source rows.

    Date, scrip and exchange are part of the row id, so only the source's units are read. A row without id fails the write, as
    all such rows would be one.
    """
    source = source.withColumn("row_id", F.coalesce("row_id", F.raise_error(F.lit("a row to upsert has no row_id")).cast("string")))
    layout = layout_of(spark, name)
    source = layout.place(source)
    touched = units_in(source, layout)
    if touched:
        target = at(spark.table(name), layout, touched)
        overwrite_units(spark, name, mutate.upsert(target, source.select(*target.columns), values=values), touched, touched)
    return source.count()


def delete(spark: SparkSession, name: str, condition: Column) -> None:
    """Delete the rows for which the condition is true; only units that have some are rewritten."""
    layout, table = layout_of(spark, name), spark.table(name)
    touched = units_in(table.where(condition), layout)
    if touched:
        overwrite_units(spark, name, mutate.delete_where(at(table, layout, touched), condition), touched)


def delete_range(spark: SparkSession, name: str, start, end) -> None:
    """Delete the dates in [start, end]: whole units, so nothing is read or rewritten but a month that is cut."""
    layout, (start, end) = layout_of(spark, name), (fn.to_date_arg(start), fn.to_date_arg(end))
    gone = units_between(spark, name, start, end, layout)
    if layout.by_month:
        cut = {u for u in gone if u[0] in (layout.first_of(start), layout.first_of(end))}
        if cut:
            rows = mutate.delete_where(at(spark.table(name), layout, cut), mutate.in_range(start, end, layout.dated))
            overwrite_units(spark, name, rows, cut)
        gone -= cut
    drop_units(spark, name, gone, layout)


def temp_units(spark: SparkSession, name: str, before=None) -> set[tuple]:
    """The units of temporary rows, all of them or those of dates before `before`."""
    before = fn.to_date_arg(before)
    return {u for u in units_of(spark, name) if u[-1] == TEMP_BUCKET and (before is None or (u[0] is not None and u[0] < before))}


def delete_temp(spark: SparkSession, name: str, before=None) -> None:
    """Delete the temporary rows, all of them or those of dates before `before`. In a table with buckets no file is read or written."""
    if layout_of(spark, name).buckets:
        drop_units(spark, name, temp_units(spark, name, before))
    else:
        older = F.lit(True) if before is None else F.col(PARTITION) < F.lit(fn.to_date_arg(before))
        delete(spark, name, mutate.is_temp() & older)


def in_buckets(df: DataFrame, layout: Layout, scrips: DataFrame) -> DataFrame:
    """The table's rows in the listed scrips' buckets, and the temporary ones: at most `buckets` literals."""
    if not layout.buckets:
        return df
    found = scrips.select(F.lit("").alias("exchange"), "scrip").select(layout.bucket().alias("b")).distinct().collect()
    return df.where(F.col(BUCKET).isin([TEMP_BUCKET, *sorted(r.b for r in found)]))


def rows_of(spark: SparkSession, name: str, scrips: DataFrame) -> DataFrame:
    """The listed scrips' rows; only their buckets are read, and of sorted files the row groups that can hold them."""
    layout = layout_of(spark, name)
    return only(in_buckets(spark.table(name), layout, scrips), scrips).drop(*layout.added)


def units_with(spark: SparkSession, name: str, scrips: DataFrame, condition: Column | None = None) -> set[tuple]:
    """The units that hold rows of the listed scrips; only the scrips' buckets are read."""
    layout, table = layout_of(spark, name), spark.table(name)
    hit = in_buckets(table if condition is None else table.where(condition), layout, scrips)
    return units_in(only(hit, scrips), layout)


def delete_scrips(spark: SparkSession, name: str, scrips: DataFrame, condition: Column | None = None) -> None:
    """Delete the listed scrips' rows, or only those for which `condition` is true. Files of other buckets stay as they are."""
    touched = units_with(spark, name, scrips, condition)
    if touched:
        rows = at(spark.table(name), layout_of(spark, name), touched)
        overwrite_units(spark, name, mutate.delete_scrips(rows, scrips, condition), touched)


def write_flags_csv(flags: DataFrame, path: str) -> None:
    flags.write.mode("overwrite").option("header", True).csv(path)
