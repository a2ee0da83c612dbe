"""Landed candle responses (parallel arrays in JSON) to rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from barsmith import fixed, schemas
from barsmith.functions import columns as fn
from barsmith.operators import rollup
from barsmith.operators.calendars import with_expiry
from barsmith.operators.dedup import keep_first
from barsmith.operators.joins import not_stored

CANDLE_ARRAYS = ("timestamp", "open", "high", "low", "close", "volume")
NO_ROWS = "no rows"
UNEVEN = "arrays differ in length"
NEVER_LANDED = "never landed"
OPTION_ARRAYS = ("timestamp", "strike", "spot", "open", "high", "low", "close", "volume", "iv", "oi")


def read_responses(spark: SparkSession, path: str, schema: str = schemas.RESPONSE) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _arrays_type(arrays: Sequence[str]) -> str:
    # Text elements: one odd element must not void the whole array.
    return "STRUCT<" + ", ".join(f"{a}: ARRAY<STRING>" for a in arrays) + ">"


def _parsed(responses: DataFrame, schema: str) -> DataFrame:
    """Add the parsed body as `j`.

    The optimizer would parse the body anew for each field taken from `from_json`; behind a
    generator it is parsed once.
    """
    return responses.select("*", F.explode(F.array(F.from_json("body", schema))).alias("j"))


def with_data(responses: DataFrame) -> DataFrame:
    """Add `data` (the arrays, enveloped or not), `rows` (their length) and `error`.

    Arrays of unequal length would pair values of different candles, so that response fails.
    """
    data = F.struct(*[F.coalesce(f"j.data.{a}", f"j.{a}").alias(a) for a in CANDLE_ARRAYS])
    named = ", ".join(f"{a} ARRAY<STRING>" for a in CANDLE_ARRAYS)
    parsed = _parsed(responses, f"status STRING, remarks STRING, {named}, data {_arrays_type(CANDLE_ARRAYS)}") \
        .withColumn("data", data).withColumn("body_status", F.col("j.status"))
    return _sized(parsed, CANDLE_ARRAYS).drop("j")


def _sized(parsed: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Add `error` and `rows`: a missing array or an empty first one means no rows."""
    sizes = [F.coalesce(F.size(f"data.{a}"), F.lit(-1)) for a in arrays]
    counted = parsed.withColumns({"_first": sizes[0], "_least": F.least(*sizes), "_most": F.greatest(*sizes)})
    error = (F.when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
             .when((F.col("_least") < 0) | (F.col("_first") == 0), F.coalesce("j.remarks", F.lit(NO_ROWS)))
             .when(F.col("_least") != F.col("_most"), F.lit(UNEVEN)))
    return (counted.withColumn("error", error)
            .withColumn("rows", F.when(F.col("error").isNull(), F.col("_first")).otherwise(0))
            .drop("_first", "_least", "_most"))


def outcomes(responses: DataFrame) -> DataFrame:
    """Per response: ok (rows), none (status 200 without rows) or failed."""
    seen = with_data(responses)
    return seen.select(
        "seq", "scrip",
        _outcome().alias("outcome"),
        "rows", "error")


WINDOW = ["scrip", "from_date", "to_date", "interval_m"]


def window_outcomes(responses: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """scrip, from_date, to_date, interval_m, outcome and error of every landed window, or of every requested one.

    The best response of a window counts: ok before none before failed. A requested window for which nothing landed is `missing`.
    """
    ranks = F.create_map(*[F.lit(x) for x in ("ok", 0, "none", 1, "failed", 2)])
    seen = with_data(responses).withColumn("outcome", _outcome()).withColumn("rank", ranks[F.col("outcome")])
    best = seen.groupBy(*WINDOW).agg(F.min_by("outcome", "rank").alias("outcome"), F.min_by("error", "rank").alias("error"))
    if requests is None:
        return best
    # One struct key: structs compare NULL fields as equal.
    asked = requests.select(F.struct(*WINDOW).alias("key")).distinct()
    found = asked.join(best.select(F.struct(*WINDOW).alias("key"), "outcome", "error"), "key", "left")
    return found.select("key.*", F.coalesce("outcome", F.lit("missing")).alias("outcome"),
                        F.when(F.col("outcome").isNull(), NEVER_LANDED).otherwise(F.col("error")).alias("error"))


def _outcome():
    return (F.when(F.col("status") != 200, "failed").when(F.col("rows") > 0, "ok")
            .when(F.col("error") == UNEVEN, "failed").otherwise("none"))


def failed_scrips(responses: DataFrame) -> DataFrame:
    return outcomes(responses).where("outcome = 'failed'").select("scrip").distinct()


def _exploded(parsed: DataFrame, arrays: Sequence[str], tags: Sequence) -> DataFrame:
    """One row per array position, with the position; none for a response without rows."""
    zipped = F.arrays_zip(*[F.col(f"data.{a}").alias(a) for a in arrays])
    return (parsed.select(*tags, F.posexplode(F.when(F.col("rows") > 0, zipped)).alias("pos", "v"))
            .select("*", "v.*").drop("v"))


def _candles(parsed: DataFrame, tags: Sequence) -> DataFrame:
    """Coerced candle rows; a timestamp that is no integer is NULL, for the caller to reject."""
    rows = _exploded(parsed, CANDLE_ARRAYS, tags)
    return rows.withColumns({"timestamp": fn.coerce_long("timestamp"),
                             **{c: fn.coerce_double(c) for c in CANDLE_ARRAYS[1:]}})


def daily_candles(responses: DataFrame) -> DataFrame:
    """Daily candles with IST trade date and row id; (seq, pos) is the landing order.

    The id is made of the text security id, before it becomes a number. A candle without a
    readable timestamp has neither date nor id.
    """
    rows = _candles(with_data(responses), ["seq", "scrip", F.col("exc_seg").alias("exchange"), "security_id"])
    return rows.withColumn("trade_date", fn.ist_date("timestamp")).select(
        "scrip", "exchange", "security_id", *fixed.PRICES, "volume", fn.row_id().alias("row_id"),
        "trade_date", "seq", "pos")


def intraday_rows(responses: DataFrame) -> DataFrame:
    """Trimmed and coerced intraday candles, unreadable timestamps NULL, duplicates included."""
    rows = _candles(with_data(responses), ["seq", "scrip", F.col("exc_seg").alias("exchange"),
                                           "security_id", "interval_m"])
    return rows.withColumns({c: fn.strip(c) for c in ("scrip", "exchange", "security_id")})


def first_candles(rows: DataFrame, order: Sequence[str] = ("seq", "pos")) -> DataFrame:
    """The first of each (security_id, timestamp, interval_m), with its IST trade date."""
    first = keep_first(rows, ["security_id", "timestamp", "interval_m"], order)
    return first.withColumn("trade_date", fn.ist_date("timestamp")).select(*schemas.INTRADAY_COLUMNS)


def intraday_candles(responses: DataFrame) -> DataFrame:
    """Clean intraday candles; fails the job on an unreadable timestamp."""
    rows = intraday_rows(responses)
    return first_candles(rows.withColumn("timestamp", fn.strict_long("timestamp", "timestamp")))


def _hourly(responses: DataFrame) -> DataFrame:
    """Parsed responses with an integer security id, and whether they succeeded."""
    typed = with_data(responses.withColumn("security_id", fn.coerce_long("security_id")))
    return typed.withColumn("good", F.coalesce((F.col("body_status") == "success") & F.col("security_id").isNotNull()
                                               & (F.col("rows") > 0), F.lit(False)))


def hourly_rows(responses: DataFrame) -> DataFrame:
    """Candles of successful responses, tagged as temporary; an unreadable timestamp is NULL, for the caller to reject."""
    return _candles(_hourly(responses).where("good"), [
        "seq", "scrip", F.lit(fixed.TEMP_EXCHANGE).alias("exchange"), "security_id", "interval_m"])


def open_hours(rows: DataFrame, opens: str = fixed.MARKET_OPEN, closes: str = fixed.MARKET_CLOSE) -> DataFrame:
    """Market-hour candles, each once, as windows may overlap."""
    kept = rollup.market_hours(rows, opens=opens, closes=closes)
    return keep_first(kept, ["security_id", "timestamp", "interval_m"], ["seq", "pos"]).drop("seq", "pos")


def hourly_candles(responses: DataFrame, opens: str = fixed.MARKET_OPEN,
                   closes: str = fixed.MARKET_CLOSE) -> DataFrame:
    """Market-hour candles of successful responses. A response whose security id is no integer gives none."""
    return open_hours(hourly_rows(responses), opens, closes)


def failed_windows(responses: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """(scrip, from_date, to_date, error) of every hourly response that gives no candles, and of every requested window without any."""
    bad = _hourly(responses).where("NOT good").select("scrip", "from_date", "to_date", F.coalesce(
        "error", F.when(F.col("security_id").isNull(), "security id is no integer"), F.lit("not successful")).alias("error"))
    if requests is None:
        return bad
    keys = ["scrip", "from_date", "to_date"]
    return bad.unionByName(not_stored(requests.select(*keys).distinct(), responses, keys).withColumn("error", F.lit(NEVER_LANDED)))


def option_candles(responses: DataFrame, lookup: DataFrame | None = None,
                   preferred: str = "preferred_flag") -> DataFrame:
    """Option rows: per request the preferred flag's response, or the other flag's if it is empty.

    The choice is made among whole responses, before their arrays become rows. `trade_date` is
    the requested date, not the candle's.
    """
    full = _option_parsed(responses).drop("j", "body")
    wanted = with_expiry(full.withColumnRenamed("expiry_flag", "flag_used"), lookup) \
        .withColumnRenamed("expiry_flag", preferred)
    chosen = keep_first(
        wanted, ["trade_date", "expiry_code", "strike_offset", "option_type", "security_id", "interval"],
        [F.col("rows") == 0, F.col("flag_used") != F.col(preferred), "seq"])
    return prepare_options(_exploded(chosen, OPTION_ARRAYS, [
        "trade_date", "expiry_date", F.col("flag_used").alias("expiry_flag"), "expiry_code",
        "security_ticker", "security_id", "interval", "option_type",
        fn.offset_label("strike_offset").alias("strike_offset")]))


def _option_parsed(responses: DataFrame) -> DataFrame:
    side = _arrays_type(OPTION_ARRAYS)
    parsed = _parsed(responses, f"remarks STRING, data STRUCT<ce: {side}, pe: {side}>") \
        .withColumn("data", F.when(F.col("option_type") == "CE", F.col("j.data.ce")).otherwise(F.col("j.data.pe")))
    return _sized(parsed, OPTION_ARRAYS)


def option_outcomes(responses: DataFrame) -> DataFrame:
    """The responses with their outcome - ok, empty or failed - and its rank: rows of either flag serve a cell, and a failure
    outranks emptiness, as the failed flag may hold rows."""
    outcome = (F.when(F.col("rows") > 0, "ok").when((F.col("status") != 200) | (F.col("error") == UNEVEN), "failed")
               .otherwise("empty"))
    ranks = F.create_map(*[F.lit(x) for x in ("ok", 0, "failed", 1, "empty", 2)])
    return _option_parsed(responses).drop("j", "body").withColumn("outcome", outcome).withColumn("rank", ranks[F.col("outcome")])


def prepare_options(rows: DataFrame) -> DataFrame:
    """Coerce, round the strike, turn NaN and infinities to NULL and order the columns.

    A timestamp that is no integer is NULL, for the caller to reject.
    """
    numbers = ("strike", "spot", "open", "high", "low", "close", "iv")
    # Two steps, so that each text is parsed once.
    parsed = rows.withColumns({
        "timestamp": fn.coerce_long("timestamp"),
        "volume": fn.coerce_long("volume"), "oi": fn.coerce_long("oi"),
        **{c: fn.coerce_double(c) for c in numbers}})
    return parsed.withColumns({
        "strike_price": fn.strike_price("strike"), **{c: fn.scrub(c) for c in numbers[1:]},
    }).select(*schemas.OPTION_COLUMNS)
