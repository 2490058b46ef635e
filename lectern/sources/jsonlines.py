"""JSON-lines logs to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (
    OTHER_PLATFORM,
    PASSWORD_MASK,
    PLATFORMS,
    label,
    mask_name,
    mask_phone,
    round_score,
    whole_number,
)
from .specs import Field, TableSpec

_OPTIONS = {"mode": "PERMISSIVE", "allowUnquotedFieldNames": "true"}
_END = "_end_of_line"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in the column ``value``."""
    return spark.read.text(path)


# why a line is no record: nothing in it; no JSON at its start; another JSON value than an object;
# an object with more after it
REASONS = ("blank", "malformed", "no object", "more than one")


def parsed_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Every line as ``value`` with its record ``o``, null unless the line is one whole object.

    The line is parsed as the only element of a list, followed by a second list with
    a hash of the line: text after the object, a second object or a bare array change
    the shape, and a line that closes the list itself cannot hold its own hash.
    """
    fields = ", ".join(f"`{k}` string" for k in (*keys, _END))
    mark = F.sha2(F.col("value"), 256)
    parsed = F.from_json(
        F.concat(F.lit("[["), F.col("value"), F.lit(f'],[{{"{_END}":"'), mark, F.lit('"}]]')),
        f"array<array<struct<{fields}>>>",
        _OPTIONS,
    )
    # a generator evaluates the parse once per line, however many keys are read
    rows = lines.select(
        "value", mark.alias("_mark"), F.inline(F.array(F.struct(parsed.alias("_lists"))))
    )
    lists = F.col("_lists")
    one = (
        (F.size(lists) == 2)
        & (F.size(F.get(lists, 0)) == 1)
        & (F.size(F.get(lists, 1)) == 1)
        & (F.get(F.get(lists, 1), 0)[_END] == F.col("_mark"))
    )
    return rows.select("value", F.when(one, F.get(F.get(lists, 0), 0)).alias("o"))


def _reason() -> Column:
    """Why a line is no record; null where it is one. Only lines that are none are parsed again."""
    value = F.col("value")
    first = F.try_parse_json(value)
    blank, malformed, other, more = REASONS
    return (
        F.when(F.col("o").isNotNull(), F.lit(None).cast("string"))
        .when(value.isNull() | ~value.rlike(r"\S"), blank)
        .when(first.isNull(), malformed)
        .when(F.schema_of_variant(first).startswith("OBJECT"), more)
        .otherwise(other)
    )


def json_objects(
    lines: DataFrame, keys: list[str], strict: bool = True, rejects: Observation | None = None
) -> DataFrame:
    """The given keys of every line, as text.

    ``strict`` drops each line that is not one whole JSON object; ``rejects`` counts
    those by reason in the same pass. Without ``strict`` such lines become rows of nulls.
    """
    rows = parsed_lines(lines, keys)
    if rejects is not None:
        counts = (F.count_if(F.col("reason") == r).alias(r) for r in REASONS)
        rows = rows.withColumn("reason", _reason()).observe(rejects, F.count(F.lit(1)).alias("lines"), *counts)
    if strict:
        rows = rows.where(F.col("o").isNotNull())
    return rows.selectExpr(*(f"o.`{k}`" for k in keys))


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that are no record, with the reason."""
    return parsed_lines(lines, []).where(F.col("o").isNull()).select("value", _reason().alias("reason"))


def _typed(field: Field, phone_variant: str) -> Column | str:
    kind = field.kind
    if kind == "s" and field.key == field.name:
        return f"`{field.key}`"
    c = F.col(f"`{field.key}`")
    if kind == "i":
        c = whole_number(field.key)
    elif kind == "d1":
        c = round_score(c)
    elif kind == "name":
        c = mask_name(c)
    elif kind == "phone":
        c = mask_phone(c, phone_variant)
    elif kind == "secret":
        c = F.lit(PASSWORD_MASK)
    elif kind == "platform":
        c = label(c, PLATFORMS, OTHER_PLATFORM)
    return c if kind == "i" and field.key == field.name else c.alias(field.name)


def typed(
    raw: DataFrame, spec: TableSpec, phone_variant: str = "eleven", ready: tuple[str, ...] = ()
) -> DataFrame:
    """Raw keys as text to the typed columns of a table.

    Fields of the kinds in ``ready`` are in ``raw`` already, under their names.
    """
    return raw.select(
        [f"`{f.name}`" if f.kind in ready else _typed(f, phone_variant) for f in spec.fields]
    )


def clean(lines: DataFrame, spec: TableSpec, rejects: Observation | None = None) -> DataFrame:
    """Lines of a raw log to the rows of its cleaned table. A map-only plan."""
    return typed(json_objects(lines, spec.raw_keys, rejects=rejects), spec)
