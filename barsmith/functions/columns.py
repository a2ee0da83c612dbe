"""Cleaning, coercion, time and key functions. All are native column expressions."""

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from barsmith import fixed

# Everything str.strip() removes, not just the space that trim() removes.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# Numbers as pandas reads them: no type suffix, no hex, no digit grouping, no 'nan'.
NUMBER = r"^\s*+[+-]?+(?:(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+|(?i:inf|infinity))\s*+$"
INTEGER = r"^\s*+[+-]?+\d++\s*+$"


def strip(c) -> Column:
    """Remove white space of any kind at both ends."""
    return F.trim(F.col(c) if isinstance(c, str) else c, F.lit(WHITESPACE))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c) -> Column:
    """Text to DOUBLE; anything that is no number, and NaN, becomes NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def coerce_long(c) -> Column:
    """Text to BIGINT by way of DOUBLE ('12.0' is 12), exact for plain integers.

    Only integer texts are cast directly: a failed cast costs an exception.
    """
    text = _col(c).cast("string")
    return F.when(text.rlike(INTEGER), text.try_cast("bigint")) \
        .otherwise(scrub(coerce_double(c)).try_cast("bigint"))


def strict_long(c, name: str) -> Column:
    """coerce_long that fails the job on text that is no integer."""
    return F.coalesce(
        coerce_long(c),
        F.raise_error(F.concat(F.lit(f"{name} is not an integer: "),
                               F.coalesce(_col(c).cast("string"), F.lit("NULL")))).cast("bigint"),
    )


def split_rejects(df: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column present, the others)."""
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return df.where(whole), df.where(~whole)


def strict_date(c, fmt: str) -> Column:
    """Trimmed text to DATE; fails the job on other text, in ANSI mode or not."""
    text = strip(c)
    wrong = F.raise_error(F.concat(F.lit(f"not a date like {fmt}: "), text)).cast("date")
    return F.coalesce(F.try_to_date(text, fmt), F.when(text.isNotNull(), wrong))


def _shape(fmt: str) -> str:
    """A pattern for texts of a date format: one or two digits for a single letter."""
    def part(match):
        letters = match.group()
        if letters.startswith("MMM"):
            return "[A-Za-z]{3}"
        return r"\d{1,2}" if len(letters) == 1 else rf"\d{{{len(letters)}}}"

    return f"^{re.sub('y+|M+|d+|H+|m+|s+', part, fmt)}$"


def lenient_date(c, *formats: str) -> Column:
    """Trimmed text to DATE by the first format that fits, else NULL.

    A format is tried on texts of its shape only: a failed parse costs an exception.
    """
    text = strip(c)
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in formats])


def known_date(c, *formats: str) -> Column:
    """lenient_date that fails the job on text of no format; NULL and empty text are NULL."""
    text = strip(c)
    wrong = F.raise_error(F.concat(F.lit("not a known date form: "), text)).cast("date")
    return F.coalesce(lenient_date(c, *formats), F.when(F.coalesce(text, F.lit("")) != "", wrong))


def scrub(c) -> Column:
    """NaN and infinities to NULL (Spark orders NaN above infinity)."""
    c = _col(c)
    return F.when(F.abs(c) < float("inf"), c)


def nan_to_null(c) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def tick_round(c, decimals: int = 2) -> Column:
    """Round a DOUBLE to `decimals` places, half to even on its exact binary value.

    `c * 10^d` may round onto a half; the exact error of that product (Dekker's split) then
    tells on which side of the half the value lies. Cheaper than a decimal round, and exact.
    """
    c = _col(c).cast("double")
    factor = float(10 ** decimals)
    product = c * F.lit(factor)
    big = c * F.lit(134217729.0)
    high = big - (big - c)
    error = (high * F.lit(factor) - product) + (c - high) * F.lit(factor)
    whole = F.floor(product).cast("double")
    half = product - whole == 0.5
    return (F.when(half & (error > 0), whole + 1.0)
            .when(half & (error < 0), whole)
            .otherwise(F.rint(product))) / F.lit(factor)


def strike_price(c) -> Column:
    """Strike as DECIMAL(38,9), rounded to 2 places."""
    return (F.rint(scrub(c) * 100) / 100).cast("decimal(38,9)")


def row_id(scrip="scrip", exchange="exchange", security_id="security_id", trade_date="trade_date",
           separator: str = "") -> Column:
    """SHA-256 of the four key parts.

    Parts are joined without separator, as stored ids are; pass one for collision-free ids.
    A NULL part makes the id NULL.
    """
    parts = [_col(scrip), _col(exchange), _col(security_id).cast("string"),
             _col(trade_date).cast("date").cast("string")]
    joined = [parts[0]]
    for p in parts[1:]:
        joined += [F.lit(separator), p] if separator else [p]
    return F.sha2(F.concat(*joined), 256)


def ist_seconds(epoch) -> Column:
    """Epoch seconds moved to IST wall-clock seconds."""
    return _col(epoch) + F.lit(fixed.IST_OFFSET_SECONDS)


def ist_date(epoch) -> Column:
    """IST date of an epoch-second column; independent of the session time zone."""
    return F.date_from_unix_date(F.floor(ist_seconds(epoch) / 86400).cast("int"))


def ist_second_of_day(epoch) -> Column:
    return F.pmod(ist_seconds(epoch), F.lit(86400))


def second_of_day(clock: str) -> int:
    """'HH:MM[:SS]' as seconds after midnight."""
    h, m, s = (clock.split(":") + ["0"])[:3]
    return int(h) * 3600 + int(m) * 60 + int(s)


def in_market_hours(epoch, opens: str = fixed.MARKET_OPEN, closes: str = fixed.MARKET_CLOSE) -> Column:
    """Whether the IST time of day lies in [opens, closes], both ends included."""
    return ist_second_of_day(epoch).between(second_of_day(opens), second_of_day(closes))


def offset_label(n) -> Column:
    """0 -> ATM, 3 -> ATM+3, -3 -> ATM-3."""
    n = _col(n)
    text = n.cast("string")
    return (F.when(n == 0, F.lit("ATM"))
            .when(n > 0, F.concat(F.lit("ATM+"), text))
            .otherwise(F.concat(F.lit("ATM"), text)))


def sequence_key(major, minor) -> Column:
    """One DECIMAL that orders like (major, minor) for BIGINT major and BIGINT minor >= 0.

    min_by/max_by on a struct needs a sort aggregate; on this they stay hash aggregates.
    """
    return (_col(major).cast("decimal(18,0)") * F.expr("CAST('10000000000000000000' AS DECIMAL(20,0))")
            + _col(minor).cast("decimal(19,0)")).cast("decimal(38,0)")


def to_date_arg(value) -> date | None:
    """Accept a date, a datetime or 'YYYY-MM-DD' text."""
    if value is None or (isinstance(value, date) and not isinstance(value, datetime)):
        return value
    if isinstance(value, datetime):
        return value.date()
    return date.fromisoformat(value)
