"""Rows brought to an entity's declared schema, with a quarantine for those that
do not fit.

Every declared field is converted once (dates in the accepted layouts, numbers
without currency signs and digit groups, as exact decimals); what a row fails is
collected in ``errors``, one text per field.  Rows without an error are typed rows
of the entity; the others keep their original values next to their errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, IntegerType, StructType, TimestampType

from ledgerlens.functions.columns import ws_trim
from ledgerlens.operators.cleaning import parse_date

_NAMES = {DateType: "date", TimestampType: "timestamp", DecimalType: "number", IntegerType: "whole number", BooleanType: "truth value"}


def to_decimal(c: Column, kind: DecimalType) -> Column:
    """Rupee signs, digit-group commas and outer blanks stripped; exact, null if it is no number."""
    return ws_trim(F.translate(c.cast("string"), "₹,", "")).try_cast(kind)


def typed(c: Column, have: DataType, want: DataType, day_first: bool = True) -> Column:
    """``c`` as the declared type, null where it cannot be read as one."""
    if have == want:
        return c
    if isinstance(want, DecimalType):
        return to_decimal(c, want)
    if isinstance(want, DateType):
        return c.try_cast(want) if isinstance(have, TimestampType) else parse_date(c.cast("string"), day_first)
    if isinstance(want, TimestampType):
        return F.try_to_timestamp(c.cast("string"))
    return c.try_cast(want)


def checked(df: DataFrame, schema: StructType, day_first: bool = True) -> DataFrame:
    """``row`` (struct of the typed fields), ``errors`` and the original columns as the struct ``source``.

    ``place`` is a fence: what reads it is not merged into the projection that
    converts, so errors and filters look at converted values instead of converting again."""
    fields = [typed(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType, day_first) if f.name in df.columns
              else F.lit(None).cast(f.dataType) for f in schema.fields]
    source = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("source")
    read = df.select(F.struct(*(v.alias(f.name) for v, f in zip(fields, schema.fields))).alias("row"), source,
                     F.monotonically_increasing_id().alias("place"))
    errors = []
    for f in schema.fields:
        given = F.col("source").getField(f.name) if f.name in df.columns else F.lit(None)
        if f.name in df.columns:
            unread = given.isNotNull() & F.col("row").getField(f.name).isNull()
            errors.append(F.when(unread, F.lit(f"{f.name}: not a {_NAMES.get(type(f.dataType), 'text')}")))
        if not f.nullable:
            errors.append(F.when(given.isNull(), F.lit(f"{f.name}: missing")))
    return read.select("row", F.array_compact(F.array(*errors)).alias("errors"), "source", "place")


def conformed(found: DataFrame) -> DataFrame:
    """The rows that fit, typed."""
    return found.where((F.size("errors") == 0) & (F.col("place") >= 0)).select("row.*")


def quarantine(found: DataFrame) -> DataFrame:
    """The rows that do not, as they came, with their ``errors``."""
    return found.where((F.size("errors") > 0) & (F.col("place") >= 0)).select("source.*", "errors")
