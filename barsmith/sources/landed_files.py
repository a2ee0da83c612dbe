"""Exchange files, instrument master, scrip lists and expiry calendars."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barsmith import fixed, schemas
from barsmith.functions import columns as fn
from barsmith.operators.joins import without
from barsmith.session import stage


MOST_COLUMNS = 64  # that a line is cut into; the known ones must be among them
CELLS = ", ".join(f"c{i} STRING" for i in range(MOST_COLUMNS))
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every value text. The header's names are trimmed.

    All files under `path` must have the header of the first; another order or name fails the
    read instead of shifting columns.
    """
    options = {"header": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    header = spark.read.options(**options).csv(path).schema
    return spark.read.options(**options, enforceSchema=False).schema(header).csv(path)


def rename_known(df: DataFrame, names: dict[str, str], extra=()) -> DataFrame:
    """Keep the known columns under their stored names, in the stored order."""
    present = {c.strip(): c for c in df.columns}
    missing = [c for c in names if c not in present]
    if missing:
        raise ValueError(f"file lacks columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{present[raw]}`").alias(name) for raw, name in names.items()], *extra)


def file_date(rule: tuple[str, str], path: str = "_metadata.file_path") -> Column:
    """The date a file was requested for, from its name or its folder's `name=` form."""
    pattern, fmt = rule
    text = F.concat(F.regexp_extract(F.col(path), pattern, 1), F.regexp_extract(F.col(path), pattern, 2))
    return F.try_to_date(text, fmt)


def drop_stale_files(rows: DataFrame, row_date: str, file: str = "file",
                     requested: str = "requested_date") -> DataFrame:
    """Drop every file that holds a row of another date than the one it was requested for.

    A missing row date counts as another date. Only offending rows are grouped, so the list is
    as short as there are stale files.
    """
    stale = rows.where(~F.coalesce(F.col(row_date) == F.col(requested), F.lit(False))).select(file).distinct()
    return rows.join(stale, file, "left_anti")


def headers(spark: SparkSession, path: str, asked: Column) -> DataFrame:
    """(path, header): the cells of the first line of every file for which `asked` is true."""
    lines = spark.read.text(path).where(asked & (F.col("_metadata.file_block_start") == 0)).select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("value"))  # a file's lines are numbered in their order
    cells = F.from_csv("value", CELLS, CSV_OPTIONS)
    parsed = first.select("path", F.explode(F.array(cells)).alias("s"))
    return parsed.select("path", F.array(*[fn.strip(F.col(f"s.c{i}")) for i in range(MOST_COLUMNS)]).alias("header"))


def csv_files_by_name(spark: SparkSession, path: str, names: dict[str, str], asked: Column) -> DataFrame:
    """The known columns of the CSV files for which `asked` is true, each file mapped by its own header; `path` names the file.

    `asked` is on the files' metadata: it is applied to the listing, before any file is opened. A folder without files gives no rows; a
    file that lacks a column fails the read.
    """
    rows = spark.read.schema(CELLS).options(**CSV_OPTIONS).csv(path).where(asked).select(
        F.col("_metadata.file_path").alias("path"), F.array(*[f"c{i}" for i in range(MOST_COLUMNS)]).alias("cells"))
    found = rows.join(headers(spark, path, asked), "path")
    return named_cells(found.where(F.transform("cells", lambda c: fn.strip(c)) != F.col("header")), names)


def price_rows(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Typed rows of the daily price files requested for [start, end], with file and date asked for."""
    requested = file_date(fixed.PRICE_FILE_DATE)
    named = csv_files_by_name(spark, path, fixed.PRICE_COLUMNS, requested.between(F.lit(fn.to_date_arg(start)), F.lit(fn.to_date_arg(end))))
    return named.select(
        fn.strip("symbol").alias("symbol"), fn.strip("series").alias("series"),
        *[fn.coerce_double(c).alias(c) for c in schemas.PRICE_NUMBERS],
        fn.strict_date("date", fixed.PRICE_ROW_DATE).alias("date"), F.col("path").alias("file"),
        file_date(fixed.PRICE_FILE_DATE, "path").alias("requested_date"))


def genuine(rows: DataFrame, row_date: str) -> DataFrame:
    """Rows of the files that hold the date they were requested for.

    The rows are written once before: the check reads two columns of them, not the files again.
    """
    return drop_stale_files(stage(rows, "files"), row_date).drop("file", "requested_date")


def price_files(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Daily price rows requested for [start, end]; stale files are dropped whole."""
    return genuine(price_rows(spark, path, start, end), "date")


def archive_lines(files: DataFrame) -> DataFrame:
    """(path, entry, name, line, text) of every line of every entry of the archives in `files` (path, content).

    The worker code needs nothing but the standard library and pandas. What is no archive has no lines.
    """
    def unpack(batches):
        import io
        import zipfile

        import pandas

        names, held = ["path", "entry", "name", "line", "text"], []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                if not zipfile.is_zipfile(io.BytesIO(content)):
                    continue
                with zipfile.ZipFile(io.BytesIO(content)) as packed:
                    for number, entry in enumerate(packed.infolist()):
                        with packed.open(entry) as raw:
                            for i, text in enumerate(io.TextIOWrapper(raw, "utf-8-sig", errors="replace")):
                                held.append((path, number, entry.filename, i, text.rstrip("\r\n")))
                                if len(held) >= 20_000:
                                    yield pandas.DataFrame(held, columns=names)
                                    held = []
        if held:
            yield pandas.DataFrame(held, columns=names)

    return files.mapInPandas(unpack, "path STRING, entry INT, name STRING, line BIGINT, text STRING")


def first_entry(lines: DataFrame, prefix: str) -> DataFrame:
    """The lines of each archive's first entry whose lower-cased name starts with `prefix`."""
    named = lines.where(F.lower("name").startswith(prefix))
    first = named.groupBy("path").agg(F.min("entry").alias("entry"))
    return named.join(first, ["path", "entry"], "left_semi")


def csv_by_name(lines: DataFrame, names: dict[str, str]) -> DataFrame:
    """The known columns of CSV lines, each file mapped by its own first line; a file that lacks one fails the read."""
    cells = F.from_csv("text", CELLS, CSV_OPTIONS)
    # Behind a generator, or the optimizer would parse the line for each of its cells.
    parsed = lines.where("trim(text) != ''").select("path", "line", F.explode(F.array(cells)).alias("s"))
    split = parsed.select("path", "line", F.array(*[F.col(f"s.c{i}") for i in range(MOST_COLUMNS)]).alias("cells"))
    header = split.where("line = 0").select("path", F.transform("cells", lambda c: fn.strip(c)).alias("header"))
    return named_cells(split.where("line > 0").join(header, "path"), names)


def named_cells(found: DataFrame, names: dict[str, str]) -> DataFrame:
    """path and the known columns of rows (path, cells, header): each cell by its name's place in the header."""
    at = {raw: F.array_position(F.coalesce(F.filter("header", lambda c: c.isNotNull()), F.array()), raw).cast("int") for raw in names}
    return found.select("path", *[F.nullif(F.coalesce(F.element_at("cells", F.when(at[raw] > 0, at[raw]).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(f" lacks column {raw}"))).cast("int"))), F.lit("")), F.lit("")).alias(name)
        for raw, name in names.items()])


def market_cap_rows(spark: SparkSession, archives: str | DataFrame, start, end) -> DataFrame:
    """Typed rows of the market-cap archives requested for [start, end]; archives: a path, or a frame of (path, content)."""
    listed = isinstance(archives, DataFrame)
    files = archives if listed else spark.read.format("binaryFile").load(archives)
    requested = file_date(fixed.MCAP_FILE_DATE, "path" if listed else "_metadata.file_path")
    asked = requested.between(F.lit(fn.to_date_arg(start)), F.lit(fn.to_date_arg(end)))
    return typed_market_cap(files.where(asked).select("path", "content"))


def typed_market_cap(files: DataFrame) -> DataFrame:
    """Typed rows of market-cap archives (path, content), with file and the date asked for."""
    lines = stage(archive_lines(files), "archive_lines")  # unpacked once, read for the entry's number, its header and its rows
    rows = csv_by_name(first_entry(lines, "mcap"), fixed.MCAP_COLUMNS).withColumnRenamed("path", "file")
    return rows.select(
        *[fn.strip(c).alias(c) for c in ("symbol", "series", "security_name", "category")],
        fn.lenient_date("last_trade_date", fixed.MCAP_ROW_DATE).alias("last_trade_date"),
        *[fn.coerce_double(c).alias(c) for c in schemas.MCAP_NUMBERS],
        fn.strict_date("trade_date", fixed.MCAP_ROW_DATE).alias("trade_date"), "file",
        file_date(fixed.MCAP_FILE_DATE, "file").alias("requested_date"))


def market_cap_files(spark: SparkSession, archives: str | DataFrame, start, end) -> DataFrame:
    """Market-cap rows requested for [start, end]; stale archives are dropped whole."""
    return genuine(market_cap_rows(spark, archives, start, end), "trade_date")


def instrument_master(spark: SparkSession, path: str) -> DataFrame:
    """The full instrument list with its 21 kept columns typed."""
    raw = rename_known(read_text_csv(spark, path), {c: c for c in fixed.INSTRUMENT_COLUMNS})
    cast = {"string": F.col, "bigint": fn.coerce_long, "double": fn.coerce_double,
            "date": lambda c: fn.lenient_date(c, *fixed.INSTRUMENT_DATES)}
    return raw.select(*[cast[t](c).alias(c) for c, t in fixed.INSTRUMENT_COLUMNS.items()])


def traded(segments=fixed.SEGMENTS, instruments=fixed.INSTRUMENTS, types=fixed.INSTRUMENT_TYPES):
    """The instrument filter: segment, instrument and type all listed."""
    return (F.col("SEGMENT").isin(list(segments)) & F.col("INSTRUMENT").isin(list(instruments))
            & F.col("INSTRUMENT_TYPE").isin(list(types)))


def with_category_text(df: DataFrame) -> DataFrame:
    """A missing surveillance category is the text 'None'."""
    return df.withColumn("ASM_GSM_CATEGORY", F.coalesce("ASM_GSM_CATEGORY", F.lit("None")))


def scrip_list(spark: SparkSession, path: str) -> DataFrame:
    """A scrip list as it stands: first row names the columns, all values are text; files of other headers fail the read."""
    return read_text_csv(spark, path).fillna("")


def scrip_mapping(spark: SparkSession, list_path: str, negative_path: str | None = None) -> DataFrame:
    """The scrips to process: the list without the negative list."""
    listed = scrip_list(spark, list_path)
    return listed if negative_path is None else without(listed, scrip_list(spark, negative_path))


def expiry_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (trade_date, expiry_date) from an expiry list with day-first dates; a text that is no date fails the read."""
    raw = read_text_csv(spark, path)
    return raw.select(fn.known_date("Date", *fixed.EXPIRY_DATES).alias("trade_date"),
                      fn.known_date("Expiry", *fixed.EXPIRY_DATES).alias("expiry_date")).distinct()
