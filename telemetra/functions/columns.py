"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F
from pyspark.sql.window import WindowSpec

from telemetra.functions.fixed_values import Bands, Limits


def is_valid(value: str | Column) -> Column:
    """True for a number; false (never NULL) for NULL and NaN."""
    col = F.col(value) if isinstance(value, str) else value
    return col.isNotNull() & ~F.isnan(col)


def number(value: str) -> Column:
    """The value with NaN turned into NULL, so that aggregates skip it."""
    return F.when(~F.isnan(value), F.col(value))


def mean(value: str | Column, exact: bool = False, over: WindowSpec | None = None) -> Column:
    """Average; ``exact`` sums as DECIMAL(18,4), so the row order cannot show in the result.

    Where a value does not fit that type (1e14 and beyond, infinite ones) it is the plain average.
    """
    col = F.col(value) if isinstance(value, str) else value
    if not exact:
        return F.avg(col) if over is None else F.avg(col).over(over)
    decimal = col.try_cast("decimal(18,4)")
    parts = [F.sum(decimal), F.count(decimal), F.count(col), F.avg(col)]
    total, fitting, count, average = parts if over is None else [part.over(over) for part in parts]
    return F.when(fitting == count, total.cast("double") / F.nullif(count, F.lit(0))).otherwise(average)


#: The columns of a store that hold the day of a time, and are directories.
STORED_DAYS = {"event_time": "event_date", "processed_at": "processed_date"}
#: The sensor as a store's directory name.
STORED_SENSOR = "stored_sensor"


def stored_sensor(sensor: Column) -> Column:
    """Text that stays text in a path: numbers, empty names and NULL are told apart."""
    return F.coalesce(F.concat(F.lit("sensor-"), sensor), F.lit("none"))


def lookup(key: str | Column, table: Mapping[str, object], default: object = None) -> Column:
    """Value of a small literal table, ``default`` where the key is missing or NULL."""
    col = F.col(key) if isinstance(key, str) else key
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, col), F.lit(default))


def outside(limits: Mapping[str, Limits], sensor: str = "sensor_type", value: str = "value") -> Column:
    """Strictly outside the limits of its sensor; sensors without limits never are."""
    tests = []
    for name, bound in limits.items():
        crossed = []
        if bound.low is not None:
            crossed.append(F.col(value) < bound.low)
        if bound.high is not None:
            crossed.append(F.col(value) > bound.high)
        tests.append((F.col(sensor) == name) & reduce(or_, crossed))
    return reduce(or_, tests)


def severity(bands: Mapping[str, Bands], sensor: str = "sensor_type", value: str = "value") -> Column:
    """normal / warning / alert; NULL for sensors without bands and for missing values."""
    result = F.lit(None).cast("string")
    for name, band in bands.items():
        level = (
            F.when(F.col(value) > band.alert, "alert")
            .when(F.col(value) > band.warning, "warning")
            .otherwise("normal")
        )
        result = F.when((F.col(sensor) == name) & is_valid(value), level).otherwise(result)
    return result


def iso_time(time: str | Column, separator: str = "T") -> Column:
    """ISO-8601 text; the fraction is written only when there is one."""
    col = (F.col(time) if isinstance(time, str) else time).cast("timestamp")
    whole = F.date_format(col, f"yyyy-MM-dd'{separator}'HH:mm:ss")
    fraction = F.date_format(col, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def micros(time: str | Column) -> Column:
    col = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(col.cast("timestamp"))


def now(as_of: object = None) -> Column:
    """Processing time: the caller's instant, else the clock of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
