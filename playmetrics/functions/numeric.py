"""Exact sums and ratios. Rounding is half away from zero, as SQL ``ROUND`` does on numerics.

Spark's decimals have 38 digits. A sum of amounts has room for 26 digits before the point here, so beyond
``NARROW`` places neither it nor a product of it fits into one number. Such sums are kept in limbs,
whole numbers that add up apart: the part before the point, the first ``LIMB`` places, and the places
after those. A ratio is then a long division: the whole part first, and its remainder
goes on with the places. Nothing on the way has more than 38 digits, and nothing is rounded but the result.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT = "decimal(20,0)"
# Most places of an amount whose sums are plain decimals, and most places that limbs can hold.
NARROW, MOST = 12, 37
# Places in the middle limb; the last one has up to 23, which leaves room for sums.
LIMB = 14
_WHOLE = "decimal(38,0)"


def money(scale: int) -> str:
    """The type of a sum of amounts; one that has no room for it raises an error under ANSI."""
    return f"decimal({26 + scale},{scale})" if scale <= NARROW else f"decimal(38,{scale})"


def limbs(amount: Column, scale: int) -> dict[str, Column]:
    """A decimal as ``whole + high / 10^LIMB + low / 10^scale``, ``high`` and ``low`` not negative.

    Remainders keep all places, where a difference would lose the last ones to its type. Shifting the
    point is exact, as a limb has far fewer digits than its type.
    """
    fraction = F.pmod(amount, F.lit(Decimal(1)))
    high = F.floor(fraction, F.lit(LIMB))
    low = F.pmod(fraction, F.lit(Decimal(1).scaleb(-LIMB)))
    return {
        "whole": F.floor(amount).cast("decimal(28,0)"),
        "high": (high * F.lit(Decimal(10) ** LIMB)).cast(f"decimal({LIMB},0)"),
        "low": (low * F.lit(Decimal(10) ** max(scale, LIMB))).cast("decimal(23,0)"),
    }


def _sums(parts: dict[str, Column], times: Column | None) -> Column:
    return F.struct(*[
        F.sum(part if times is None else part * times.cast(COUNT)).cast(_WHOLE).alias(name)
        for name, part in parts.items()
    ])


def total(amount: Column, scale: int, times: Column | None = None) -> Column:
    """Aggregate: the exact sum of an amount with ``scale`` places, each ``times`` times.

    It is a decimal, or limbs that only ``add_up``, ``ratio`` and ``amount_of`` can read.
    """
    if scale <= NARROW:
        return F.sum(amount if times is None else amount * times)
    if scale > MOST:
        raise ValueError(f"amounts have {scale} decimal places, which is more than {MOST}")
    return _sums(limbs(amount, scale), times)


def add_up(sums: Column, scale: int, times: Column | None = None) -> Column:
    """Aggregate: the sum of results of ``total``."""
    if scale <= NARROW:
        return F.sum(sums if times is None else sums * times)
    return _sums({name: sums[name] for name in ("whole", "high", "low")}, times)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _exact(multiple: Column, by: Column) -> Column:
    """Quotient of a whole number and one that divides it."""
    return (multiple.cast(_WHOLE) / by).cast(_WHOLE)


def _limbs(whole: Column, high: Column, low: Column) -> Column:
    return F.struct(*[
        limb.cast(_WHOLE).alias(name) for name, limb in zip(("whole", "high", "low"), (whole, high, low))
    ])


def _carried(sums: Column, scale: int) -> Column:
    """Limbs with ``high`` and ``low`` below their bases; a negative number has a negative ``whole``."""
    upper, lower = F.lit(Decimal(10) ** LIMB), F.lit(Decimal(10) ** (max(scale, LIMB) - LIMB))
    rest = lambda value, base: F.pmod(value, base)
    first = lambda s: _limbs(
        s["whole"], s["high"] + _exact(s["low"] - rest(s["low"], lower), lower), rest(s["low"], lower)
    )
    second = lambda s: _limbs(
        s["whole"] + _exact(s["high"] - rest(s["high"], upper), upper), rest(s["high"], upper), s["low"]
    )
    return _let(_let(sums, first), second)


def _absolute(sums: Column, scale: int) -> Column:
    """The limbs of the absolute value of a sum, and whether it is negative."""
    def turned(s: Column) -> Column:
        positive = _carried(_limbs(-s["whole"], -s["high"], -s["low"]), scale)
        return F.struct(
            (s["whole"] < 0).alias("negative"), F.when(s["whole"] < 0, positive).otherwise(s).alias("limbs")
        )

    return _let(_carried(sums, scale), turned)


def amount_of(sums: Column, scale: int) -> Column:
    """A ``total`` as a decimal of type ``money(scale)``."""
    if scale <= NARROW:
        return sums.cast(money(scale))

    def written(s: Column) -> Column:
        text = lambda name: s["limbs"][name].cast("string")
        return F.concat(
            F.when(s["negative"], "-").otherwise(""), text("whole"), F.lit("."),
            F.lpad(text("high"), LIMB, "0"),
            F.lpad(text("low"), scale - LIMB, "0") if scale > LIMB else F.lit(""),
        )

    digits = _let(_absolute(sums, scale), written)
    # a scale below that of the limbs has zeros at the end, which the cast takes off
    return digits.cast(money(scale))


def ratio(numerator: Column, denominator: Column, places: int, scale: int = 2) -> Column:
    """``numerator / denominator`` rounded once, at ``places`` decimals.

    ``round(a / b)`` on decimals rounds twice: the division keeps a limited scale, which
    can lift a quotient just under a tie onto it. Dividing whole numbers avoids that:
    ``(2a + b) div 2b``. The numerator is a count, an amount with at most ``scale`` decimals or its
    ``total``, the denominator a count. A zero denominator raises under ANSI; a NULL numerator is NULL.
    """
    if scale > NARROW:
        return _long_division(numerator, denominator, places, scale)
    top = numerator.cast(money(scale))
    below = denominator.cast(COUNT)
    steps = F.call_function(
        "div", F.abs(top) * F.lit(2 * 10 ** places) + below, below * F.lit(2)
    )
    size = steps.cast(COUNT) * F.lit(Decimal(1).scaleb(-places))
    return F.when(top < 0, -size).otherwise(size).cast(f"decimal(22,{places})")


def _long_division(sums: Column, denominator: Column, places: int, scale: int) -> Column:
    """``ratio`` of a sum in limbs.

    The whole part leaves a remainder below the denominator. With the places up to the last one of
    the result it is a whole number ``a``; what follows counts as one more in ``2a + b`` if it is
    a half or more, and cannot matter otherwise.
    """
    below = denominator.cast(COUNT)
    steps = F.lit(Decimal(10) ** (LIMB - places))

    def divided(s: Column) -> Column:
        whole, high = s["limbs"]["whole"], s["limbs"]["high"]
        rest, behind = (whole % below).cast(COUNT), F.pmod(high, steps)
        a = rest * F.lit(Decimal(10) ** places) + _exact(high - behind, steps)
        half = (behind * F.lit(2) >= steps).cast("int").cast(COUNT)
        digits = F.call_function("div", a * F.lit(2) + below + half, below * F.lit(2)).cast(COUNT)
        size = _exact(whole - rest, below) * F.lit(Decimal(10) ** places) + digits
        size = (size.cast(_WHOLE) * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(38,{places})")
        return F.when(s["negative"], -size).otherwise(size)

    return _let(_absolute(sums, scale), divided)


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded ``numerator / denominator`` of whole numbers, to 18 decimals."""
    return numerator.cast(COUNT) / denominator.cast(COUNT)


# Places that a step of a long division of fractions yields.
_STEP = 18


def _step(rest: Column, denominator: Column) -> tuple[Column, Column]:
    """The next ``_STEP`` decimals of a fraction below one, as a whole number, and what is left."""
    shifted = rest.cast(COUNT) * F.lit(Decimal(10) ** _STEP)
    return F.call_function("div", shifted, denominator), (shifted % denominator).cast(COUNT)


def fractions(numerator: Column, denominator: Column) -> Column:
    """A fraction of whole numbers as whole part and two times ``_STEP`` decimals, cut off there."""
    below = denominator.cast(COUNT)
    above = numerator.cast(_WHOLE)
    rest = (above % below).cast(COUNT)
    first, left = _step(rest, below)
    second, _ = _step(left, below)
    return F.struct(
        _exact(above - rest, below).alias("whole"), first.alias("first"), second.alias("second")
    )


def add_fractions(parts: Column) -> Column:
    """Aggregate: the sum of ``fractions``, by parts, and how many were cut off."""
    return F.struct(
        *[F.sum(parts[name].cast(COUNT)).cast(_WHOLE).alias(name) for name in ("whole", "first", "second")],
        F.count(parts["whole"]).cast(_WHOLE).alias("terms"),
    )


def rounded_mean(sums: Column, weight: Column) -> Column:
    """A sum of fractions that are not negative, over a whole weight, as a whole number.

    What is cut off is less than one unit of the last of 36 decimals a fraction. The sum is lifted by
    that much, which settles an exact half; a sum would have to be so close below one, with far larger
    denominators than there are days, to be settled the same way.
    """
    base = F.lit(Decimal(10) ** _STEP)
    below = weight.cast(COUNT)

    def carried(s: Column) -> Column:
        second = s["second"] + s["terms"]
        first = s["first"] + _exact(second - F.pmod(second, base), base)
        return F.struct(
            (s["whole"] + _exact(first - F.pmod(first, base), base)).cast(_WHOLE).alias("whole"),
            F.pmod(first, base).alias("first"),
        )

    def divided(s: Column) -> Column:
        half = (s["first"] * F.lit(2) >= base).cast("int").cast(COUNT)
        return F.call_function("div", s["whole"] * F.lit(2) + below + half, below * F.lit(2)).cast(COUNT)

    return F.when(weight > 0, _let(_let(sums, carried), divided))
