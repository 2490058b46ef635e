"""Column expressions shared by the jobs. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
PASSWORD_MASK = "******"
OPEN_END = "9999-12-31"
PLATFORMS = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}
OTHER_PLATFORM = "other"
# types that hold whatever a log can hold: sums of money, and rounded scores
MONEY_SUM = "decimal(38,4)"
SCORE = "decimal(22,1)"
# longs to be summed
WHOLE = "decimal(20,0)"
SCORE_EDGES = (0, 20, 40, 60, 80, 100)


def mask_name(c: Column) -> Column:
    """First character, then XX; null and empty names stay as they are."""
    return F.when(F.length(c) > 0, F.concat(F.substring(c, 1, 1), F.lit("XX"))).otherwise(c)


def mask_phone(c: Column, variant: str = "eleven") -> Column:
    """Hide the middle of a phone number.

    ``eleven`` keeps characters 1-3 and 8-11, ``tail`` keeps 1-3 and all from 9.
    """
    keep = {"eleven": (8, 4), "tail": (9, 2**31 - 1)}[variant]
    return F.concat(F.substring(c, 1, 3), F.lit("*****"), F.substring(c, *keep))


def label(c: Column, names: Mapping[str, str], default: str) -> Column:
    """Code to label; null and unknown codes get the default."""
    out = None
    for code, name in names.items():
        test = c == F.lit(code)
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(default) if out is None else out.otherwise(default)


def whole_number(name: str) -> Column:
    """A text column to long as a lenient log reader does.

    Fractions are cut; null and anything unreadable is 0. A number beyond the
    range of long is null, so that it is not taken for a missing one.
    """
    text = f"trim(`{name}`)"
    beyond = f"abs(try_cast({text} AS DOUBLE)) BETWEEN 9.223372036854775807E18D AND 1.7976931348623157E308D"
    return F.expr(
        f"coalesce(try_cast({text} AS BIGINT),"
        f" try_cast(try_cast({text} AS DECIMAL(38,18)) AS BIGINT),"
        f" if({beyond}, NULL, 0)) AS `{name}`"
    )


def round_score(c: Column) -> Column:
    """Text or number to one decimal place, half up; null when missing or unreadable."""
    return F.round(c.try_cast("decimal(38,18)"), 1).cast(SCORE)


def money(c: Column) -> Column:
    return c.try_cast("decimal(20,4)")


def rate(part: Column, whole: Column) -> Column:
    """part / whole with two decimal places; null when whole is 0."""
    return (part / F.nullif(whole, F.lit(0))).try_cast("decimal(4,2)")


def iso_date(c: Column) -> Column:
    """yyyyMMdd to yyyy-MM-dd."""
    return F.date_format(F.to_date(c, "yyyyMMdd"), "yyyy-MM-dd")


def band(c: Column, edges: Sequence[int] = SCORE_EDGES) -> Column:
    """Label of the band a value lies in; the first band is closed, the rest (lo, hi]."""
    out = F.when(c.between(edges[0], edges[1]), f"{edges[0]}-{edges[1]}")
    for lo, hi in zip(edges[1:], edges[2:]):
        out = out.when((c > lo) & (c <= hi), f"{lo}-{hi}")
    return out
