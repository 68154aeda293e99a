"""Small helpers on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_known(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column and keep the rows where it is not null, computing it once per row.

    A filter on a computed column is moved below the computation by the optimizer, which then runs
    twice. An outer generator holds it back.
    """
    held = F.filter(F.array(value), lambda v: v.isNotNull())
    rows = df.select("*", F.posexplode_outer(held).alias("_known", name))
    return rows.filter(F.col("_known").isNotNull()).drop("_known")


def comma_list(text: Column | str) -> Column:
    """Comma list -> array of trimmed, non-blank items."""
    items = F.transform(F.split(text, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def split_names(text: str) -> list[str]:
    """The same for a configuration value known on the driver."""
    return [item.strip() for item in text.split(",") if item.strip()]


def strict_number(text: Column | str) -> Column:
    """Text -> double; a text that is no number fails the query."""
    column = F.col(text) if isinstance(text, str) else text
    number = column.try_cast("double")
    failure = F.raise_error(F.concat(F.lit("not a number: "), column.cast("string")))
    return F.when(column.isNotNull() & number.isNull(), failure.cast("double")).otherwise(number)


def line_protocol_name(name: Column | str) -> Column:
    """Process name made safe for the line format: blank -> underscore, comma escaped."""
    return F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit(","), F.lit("\\,"))


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round as the serving SQL does: scale, round halves away from zero, scale back.

    From 2**53 on a scaled double has no digits left to round, and ``floor`` would leave the range of its
    integer type; such values, infinities and NaN stay as they are.
    """
    column = F.col(value) if isinstance(value, str) else value
    factor = F.lit(10.0**digits)
    scaled = F.abs(column) * factor
    rounded = F.signum(column) * F.floor(scaled + 0.5) / factor
    return F.when(F.isnan(column) | (scaled >= F.lit(2.0**53)), column.cast("double")).otherwise(rounded)


def celsius(milli: Column | str) -> Column:
    """Thousandths of a degree -> degrees, two digits, halves up."""
    return F.round(F.col(milli) / 1000 if isinstance(milli, str) else milli / 1000, 2)


def whole_megabytes(size: Column | str) -> Column:
    column = F.col(size) if isinstance(size, str) else size
    return F.floor(column / (1024 * 1024))


def whole_kilobytes(size: Column | str) -> Column:
    column = F.col(size) if isinstance(size, str) else size
    return (column / 1024).cast("bigint")
