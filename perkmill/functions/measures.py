"""Exact arithmetic and calendar functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

from perkmill.schemas import KILOMETRES

# Digits before the decimal point that the short way of ``exact_product`` takes on its left side.
_SHORT = 12


def metres_to_km(metres: Column) -> Column:
    return (metres / F.lit(Decimal("1000.0"))).cast(KILOMETRES)


def _power(exponent: int) -> Column:
    return F.lit(Decimal(10) ** exponent)


def _parts(number: Column, scale: int) -> tuple[Column, Column]:
    """Whole part, and decimals as a whole number, of a number that is not negative."""
    decimals = (number % F.lit(Decimal(1))) * _power(scale) if scale else F.lit(Decimal(0))
    return F.floor(number).cast("decimal(38,0)"), decimals.cast("decimal(20,0)")


def _carry(number: Column, scale: int) -> tuple[Column, Column]:
    """A whole number by 10 ** scale: quotient and rest. Exact, as the rest is taken off first."""
    if not scale:
        return number, F.lit(Decimal(0))
    rest = number % _power(scale)
    return F.try_divide(number - rest, _power(scale)).cast("decimal(38,0)"), rest


def exact_product(a: Column, a_type: T.DecimalType, b: Column, b_type: T.DecimalType, scale: int) -> Column:
    """``a * b`` with ``scale`` decimals, rounded once (half away from zero); NULL out of range.

    Spark cuts the decimals of a product to as few as six where 38 digits do not hold all of
    them, and a second rounding could then change the result. Most products have room for all
    decimals; others are made of whole parts and decimals apart, with the carry between them.
    """
    wide = T.DecimalType(38, scale).simpleString()
    decimals = a_type.scale + b_type.scale
    left, right = F.abs(a), F.abs(b)
    (a_whole, a_rest), (b_whole, b_rest) = _parts(left, a_type.scale), _parts(right, b_type.scale)
    outer, outer_rest = _carry(F.try_multiply(a_whole, b_rest), b_type.scale)
    inner, inner_rest = _carry(F.try_multiply(b_whole, a_rest), a_type.scale)
    whole = F.try_add(F.try_add(F.try_multiply(a_whole, b_whole), outer), inner)
    fraction = (outer_rest * _power(a_type.scale)).cast("decimal(37,0)") + (
        inner_rest * _power(b_type.scale)).cast("decimal(36,0)") + (a_rest * b_rest).cast("decimal(36,0)")
    if decimals > scale:
        half = F.lit(5 * Decimal(10) ** (decimals - scale - 1))
        fraction = _carry(fraction.cast("decimal(37,0)") + half, decimals - scale)[0]
    tail = fraction.cast(T.DecimalType(scale + 2, 0)) * F.lit(Decimal(1).scaleb(-scale)) if scale else fraction
    # One digit is left free: the sum of two numbers of 38 digits would lose a decimal.
    long_way = F.try_add(whole.try_cast(T.DecimalType(37, scale)), tail.cast(T.DecimalType(37, scale)))
    room = 37 - decimals - _SHORT
    if room > 0:
        short = F.round(left.cast(T.DecimalType(_SHORT + a_type.scale, a_type.scale))
                        * right.cast(T.DecimalType(room + b_type.scale, b_type.scale)), scale)
        size = F.when((left < _power(_SHORT)) & (right < _power(room)), short.try_cast(wide)).otherwise(long_way.cast(wide))
    else:
        size = long_way.cast(wide)
    return F.when((a < 0) != (b < 0), -size).otherwise(size).cast(wide)


def seconds_to_minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(Decimal("60.0")), 2).cast("decimal(18,2)")


def months_before(day: Column, months: int) -> Column:
    """Same day ``months`` earlier, or the last day of that month when it is shorter."""
    return F.add_months(day, -months)


def month_start(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def older_than(moment: Column, minutes: int, now: Column) -> Column:
    return moment < now - F.make_dt_interval(mins=F.lit(minutes))
