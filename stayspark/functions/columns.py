"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def once(c: Column) -> Column:
    """Evaluate a costly expression once per row, however often its fields are read afterwards.

    Adjacent projections are merged, which would repeat a JSON parse per field; a one-element
    generator keeps them apart.
    """
    return F.explode(F.array(c))


def has_text(c: Column) -> Column:
    """True for a non-null, non-blank string; never null."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def all_of(conditions: list[Column]) -> Column | None:
    """AND of the given predicates; None when there is none, so no filter node is planned."""
    return reduce(lambda a, b: a & b, conditions) if conditions else None


def csv_items(c: Column) -> Column:
    """Comma list -> array of trimmed, non-empty items, in order."""
    items = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def enum_or_null(c: Column, domain: tuple[str, ...]) -> Column:
    """Trimmed, upper-cased value when it belongs to the domain, else null."""
    value = F.upper(F.trim(c))
    return F.when(value.isin(*domain), value)


def iso_date_or_null(c: Column) -> Column:
    """Strict yyyy-MM-dd; anything else is null instead of an error."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def nights(check_in: Column, check_out: Column) -> Column:
    return F.datediff(check_out, check_in)


def stay_nights(check_in: Column, check_out: Column) -> Column:
    """Array of the nights in [check_in, check_out); empty when the stay is empty or inverted."""
    dates = F.sequence(check_in, F.date_sub(check_out, 1))
    return F.when(check_out > check_in, dates).otherwise(
        F.array().cast("array<date>")
    )


def stay_total(price_per_night: Column, check_in: Column, check_out: Column, rate_plan: Column):
    """price x nights x plan multiplier, two decimals, halves away from zero."""
    multiplier = F.when(rate_plan == "NON_REFUNDABLE", F.lit("0.85")).otherwise(F.lit("1.00"))
    exact = (
        price_per_night.cast("decimal(12,4)")
        * nights(check_in, check_out).cast("decimal(6,0)")
        * multiplier.cast("decimal(3,2)")
    )
    return F.round(exact, 2).cast("decimal(12,2)")


def clamp(c: Column, low, high) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def name_uuid(text: Column) -> Column:
    """Name-based UUID, version 3 (MD5), in native expressions."""
    h = F.md5(text.cast("binary"))
    variant_nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((variant_nibble.bitwiseAND(F.lit(3))).bitwiseOR(F.lit(8))))
    return F.concat(
        F.substring(h, 1, 8),
        F.lit("-"),
        F.substring(h, 9, 4),
        F.lit("-3"),
        F.substring(h, 14, 3),
        F.lit("-"),
        variant,
        F.substring(h, 18, 3),
        F.lit("-"),
        F.substring(h, 21, 12),
    )


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_micros(micros: Column, step_micros: int) -> Column:
    return micros - F.pmod(micros, F.lit(step_micros))


def ceil_micros(micros: Column, step_micros: int) -> Column:
    """Smallest multiple of the step at or after the instant."""
    return micros + F.pmod(-micros, F.lit(step_micros))
