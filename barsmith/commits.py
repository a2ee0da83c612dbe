"""Chunk commits: rows of a load count once their chunk is listed.

A load writes its rows under a name of its own, then lists the chunks it has written in the table's manifest, with their numbers of rows.
Readers and later runs see the rows of listed chunks only. So a load that dies between the two leaves nothing behind that counts, and a
chunk whose write failed stays open while the others of its load are in.
"""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barsmith import tables

LOAD = tables.LOAD


def manifest(name: str) -> str:
    return f"{name}_chunks"


def start(spark: SparkSession, name: str, schema: str, chunk: Sequence[str], location: str | None = None) -> None:
    """Create the table, dealt by date and load, and its manifest of chunks, if they are not there."""
    tables.ensure_table(spark, name, schema, by_load=True, location=location)
    if LOAD in tables.layout_of(spark, name).units:
        kinds = {c.name: c.dataType for c in spark.catalog.listColumns(name)}
        keys = ", ".join(f"{c} {kinds[c]}" for c in chunk)
        beside = f"{location}_chunks" if location else None
        tables.ensure_table(spark, manifest(name), f"{keys}, {LOAD} STRING, rows BIGINT, committed TIMESTAMP", partition=None, location=beside)


def has_manifest(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(manifest(name))


def chunk_columns(spark: SparkSession, name: str) -> list[str]:
    return [c for c in spark.table(manifest(name)).columns if c not in (LOAD, "rows", "committed")]


def read(spark: SparkSession, name: str) -> DataFrame:
    """The stored rows of listed chunks; all rows of a table without manifest."""
    if not has_manifest(spark, name):
        return tables.read(spark, name)
    keys = [*chunk_columns(spark, name), LOAD]
    listed = spark.table(manifest(name)).select(*keys).distinct()
    return spark.table(name).join(listed, keys, "left_semi").drop(*tables.layout_of(spark, name).added)


class Load:
    """One run's writes into a table. A table made without loads takes the rows as they are."""

    def __init__(self, spark: SparkSession, name: str, chunk: Sequence[str], cluster: Sequence[str] = ()):
        self.spark, self.name, self.keys, self.cluster = spark, name, list(chunk), cluster
        self.listed, self.rows, self.rejected = has_manifest(spark, name), 0, 0

    def write(self, rows: DataFrame, chunks: DataFrame, required: str) -> None:
        """Write these chunks' rows in one job and list the chunks; rows without `required` are counted, not written.

        The numbers come from the write itself, those per chunk from the written files. Each attempt is a load of its own.
        """
        seen, load = Observation(), uuid.uuid4().hex
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(required).isNull()).alias("rejected"))
        tables.append(counted.where(F.col(required).isNotNull()).withColumn(LOAD, F.lit(load)), self.name, cluster=self.cluster)
        if self.listed:
            self._list(chunks, load)
        self.rows += seen.get["rows"] - seen.get["rejected"]
        self.rejected += seen.get["rejected"]

    def _list(self, chunks: DataFrame, load: str) -> None:
        written = tables.at(self.spark.table(self.name).where(F.col(LOAD) == load), tables.Layout(tuple(self.keys[:1])),
                            [(r[0],) for r in chunks.select(self.keys[0]).distinct().collect()])
        sizes = written.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"))
        listed = chunks.join(sizes, self.keys, "left").select(
            *self.keys, F.lit(load).alias(LOAD), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.current_timestamp().alias("committed"))
        tables.append(listed.coalesce(1), manifest(self.name))

    def write_each(self, rows_of: Callable[[DataFrame], DataFrame], chunks: DataFrame, required: str) -> list[dict]:
        """Write the chunks' rows, `rows_of(chunks)`, as `write` does; if that fails, halve the chunks and go on, down to single ones.

        Returns the chunks that failed, with the error: one bad chunk of n costs some 2 log2(n) writes.
        """
        try:
            self.write(rows_of(chunks), chunks, required)
            return []
        except Exception as error:
            held = sorted((tuple(r) for r in chunks.select(*self.keys).collect()), key=repr)  # a tranche's chunks
            if len(held) == 1:
                return [dict(zip(self.keys, held[0])) | {"error": _reason(error)}]
        failed, schema = [], chunks.select(*self.keys).schema
        for part in (held[:len(held) // 2], held[len(held) // 2:]):
            failed += self.write_each(rows_of, self.spark.createDataFrame(part, schema), required)
        return failed


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"[:500]


def clear_unlisted(spark: SparkSession, name: str) -> int:
    """Drop the directories of loads that no listed chunk names; how many. Not while a load is running."""
    layout, listed = tables.layout_of(spark, name), {r[0] for r in spark.table(manifest(name)).select(LOAD).distinct().collect()}
    at = layout.units.index(LOAD)
    gone = {u for u in tables.units_of(spark, name, layout) if u[at] not in listed}
    tables.drop_units(spark, name, gone, layout)
    return len(gone)
