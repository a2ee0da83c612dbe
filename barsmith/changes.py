"""Merge on read: changes lie beside a table and are folded into it later.

A change is an entry: a row, or the tombstone of one, under a sequence number. Every upsert or delete writes its entries as one new
partition of the change table and leaves the table's own files alone. The view `<table>_now` resolves the last entry of each row id;
entries are few, so Spark broadcasts them and no row of the table moves. Compaction rewrites the units that have entries and
drops the folded partitions. A compaction that dies half-way is repeated: folding an entry twice gives the same rows.

As in an upsert, an entry replaces the prices and the volume of the row that bears its id, or is a new row. One writer at a time, as
for the table itself.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith import tables
from barsmith.operators import mutate
from barsmith.operators.mutate import BAR_VALUES

SEQ = "seq"


def change_table(name: str) -> str:
    return f"{name}_changes"


def view(name: str) -> str:
    return f"{name}_now"


def has_changes(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(change_table(name))


def start(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Give a stored table, keyed by row_id, its change table and its view."""
    stored = tables.read(spark, name)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema) + f", gone BOOLEAN, {SEQ} BIGINT"
    tables.ensure_table(spark, change_table(name), schema, partition=SEQ, location=location)
    dated = tables.layout_of(spark, name).dated
    entry = ", ".join(f"'{c}', {c}" for c in [*stored.columns, "gone"])
    last = f"(SELECT row_id, {dated}, max_by(named_struct({entry}), {SEQ}) AS e FROM {change_table(name)} GROUP BY row_id, {dated})"
    same = f"t.row_id = l.row_id AND t.{dated} = l.{dated}"  # the id holds the date: it prunes
    kept = ", ".join(f"CASE WHEN l.e IS NOT NULL THEN l.e.{c} ELSE t.{c} END AS {c}" if c in BAR_VALUES else f"t.{c}" for c in stored.columns)
    added = ", ".join(f"l.e.{c} AS {c}" if c not in ("row_id", dated) else f"l.{c}" for c in stored.columns)
    spark.sql(f"""CREATE OR REPLACE VIEW {view(name)} AS
        SELECT {kept} FROM {name} t LEFT JOIN {last} l ON {same} WHERE NOT coalesce(l.e.gone, false)
        UNION ALL
        SELECT {added} FROM {last} l LEFT ANTI JOIN (SELECT t.row_id, t.{dated} FROM {name} t LEFT SEMI JOIN {last} l ON {same}) t ON {same}
        WHERE NOT l.e.gone""")


def current(spark: SparkSession, name: str) -> DataFrame:
    """The stored rows with all changes: the view, or the table itself if it has no change table."""
    return spark.table(view(name)) if has_changes(spark, name) else tables.read(spark, name)


def sequences(spark: SparkSession, name: str) -> list[int]:
    """The sequence numbers that are not folded in yet, from the catalog alone."""
    return sorted(u[0] for u in tables.units_of(spark, change_table(name)))


def _write(spark: SparkSession, name: str, entries: DataFrame) -> None:
    number = max(sequences(spark, name), default=0) + 1
    tables.append(entries.withColumn(SEQ, F.lit(number).cast("bigint")), change_table(name))


def upsert(spark: SparkSession, name: str, source: DataFrame) -> int:
    """Record a staged source, unique by row_id; the number of its rows. Nothing stored is read or rewritten."""
    missing = F.raise_error(F.lit("a row to upsert has no row_id")).cast("string")
    rows = source.count()
    if rows:
        _write(spark, name, source.withColumn("row_id", F.coalesce("row_id", missing)).withColumn("gone", F.lit(False)))
    return rows


def delete(spark: SparkSession, name: str, condition: Column) -> None:
    """Record tombstones for the rows for which the condition is true now; rows without an id are none's, and stay."""
    dead = current(spark, name).where(condition).where("row_id IS NOT NULL").withColumn("gone", F.lit(True))
    if not dead.isEmpty():
        _write(spark, name, dead)


def delete_range(spark: SparkSession, name: str, start, end) -> None:
    delete(spark, name, mutate.in_range(start, end, tables.layout_of(spark, name).dated))


def compact(spark: SparkSession, name: str, upto: int | None = None) -> int:
    """Fold the entries, those up to a sequence number if named, into the table; the number of units rewritten.

    Entries beyond `upto` stay, and still win over what is folded.
    """
    folded = [s for s in sequences(spark, name) if upto is None or s <= upto]
    if not folded:
        return 0
    entries = spark.table(change_table(name)).where(F.col(SEQ).isin(folded))
    last = mutate.last_entries(entries, SEQ)
    layout = tables.layout_of(spark, name)
    touched = tables.units_in(last, layout)
    here = tables.at(spark.table(name), layout, touched).drop(*layout.added)
    tables.overwrite_units(spark, name, mutate.resolve(here, last), touched)
    tables.drop_units(spark, change_table(name), [(s,) for s in folded])
    return len(touched)


def fold_all(spark: SparkSession, name: str) -> None:
    """Fold whatever changes there are, for a job that rewrites the table."""
    if has_changes(spark, name):
        compact(spark, name)
