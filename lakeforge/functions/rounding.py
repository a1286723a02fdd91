"""Rounding and averaging that two engines agree on bit for bit.

``round(avg(x), k)`` differs between engines: one rounds the decimal text of
the double, another the binary value, and float sums depend on input order.
Here a double is split by its exponent into whole numbers of fixed units (1,
2**-24, 2**-48, 2**-72), each unit is summed as BIGINT, and the exact mean is
rounded once, half away from zero.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions._col import as_col


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero to ``digits`` decimals; result DOUBLE.

    Works on the binary value (0.285 is 0.28499... and rounds to 0.28), the
    same in every engine that evaluates this expression."""
    x = as_col(c).cast("double")
    p = float(10 ** digits)
    # adding 0.0 turns a negative zero into zero
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p) + F.lit(0.0)


def exact_scaled(c: Column | str, scale: int) -> Column:
    """``c`` as a BIGINT count of ``10**-scale`` units (half away from zero)."""
    x = as_col(c).cast("double")
    p = float(10 ** scale)
    return (F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5))).cast("bigint")


def exact_sum(c: Column | str, scale: int) -> Column:
    """Aggregate: order-independent sum of ``c`` at ``scale`` decimals, as DOUBLE.

    Summing scaled BIGINTs keeps the hash aggregate on its fixed-width fast
    path and gives the same bits in any engine and any input order. Inputs
    must carry at most ``scale`` decimals (2 for money, 0 for counts); the
    total must stay below 9.2e18 units.
    """
    return F.sum(exact_scaled(c, scale)).cast("double") / F.lit(float(10 ** scale))


# Bits between neighbouring units of a split double, and units below 1.
UNIT_BITS, UNITS = 24, 3


def exact_units(c: Column | str) -> list[Column]:
    """``c`` as BIGINT counts of 1, 2**-24, 2**-48 and 2**-72, each with the sign
    of ``c``. Every step is exact: products with powers of two and remainders of
    1.0 lose no bits. Bits below 2**-72 are cut, the same for equal values;
    values from 2**-20 (about 1e-6) up have none. Sizes from 2**62 up are NULL."""
    x = as_col(c).cast("double")
    inside = F.abs(x) < F.lit(2.0 ** 62)
    out = [F.when(inside, x).cast("bigint")]
    for k in range(UNITS):
        rest = (x * F.lit(2.0 ** (UNIT_BITS * k))) % F.lit(1.0)
        out.append(F.when(inside, rest * F.lit(2.0 ** UNIT_BITS)).cast("bigint"))
    return out


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used: an
    expression is a tree, and one that repeats its parts grows beyond what is compiled."""
    return F.transform(F.array(value), then)[0]


def _decimal(number: int) -> Column:
    return F.lit(Decimal(number)).cast("decimal(38,0)")


def exact_avg(c: Column | str, digits: int, weight: Column | str | None = None) -> Column:
    """Aggregate: the exact mean of doubles, rounded once to ``digits`` (0 to 4)
    decimals, half away from zero; DOUBLE.

    The sums are BIGINTs, so a partial aggregate keeps the fixed-width fast path
    and the result has the same bits in any input order and partitioning. NULLs
    are ignored; no value, NaN or a size of 2**62 or more among the values give
    NULL. A group may have up to 2**39 rows, its total must stay below 9.2e18.
    ``weight``: how many rows (BIGINT, 1 or more) each value stands for.
    """
    x = as_col(c).cast("double")
    times = (lambda u: u) if weight is None else (lambda u: u * as_col(weight))
    n = F.count(x) if weight is None else F.sum(F.when(x.isNotNull(), as_col(weight)))
    whole = lambda c: c.cast("decimal(38,0)")
    named = lambda **columns: F.struct(*[c.alias(k) for k, c in columns.items()])
    power, one, unit, zero = _decimal(10 ** digits), _decimal(1 << (UNIT_BITS * UNITS)), _decimal(1 << UNIT_BITS), _decimal(0)
    top, *lower = [whole(F.sum(times(u))) for u in exact_units(x)]
    below = lower[0]
    for s in lower[1:]:
        below = whole(whole(below * unit) + s)
    # total * 10**digits = top + below / 2**72; then below from 0 on
    start = named(n=whole(n), most=F.max(F.abs(x)), top=whole(top * power), below=whole(below * power))
    carry = lambda v: named(n=v["n"], most=v["most"], top=v["top"], below=v["below"], rest=whole(F.pmod(v["below"], one)))
    signed = lambda v: named(n=v["n"], most=v["most"], top=whole(v["top"] + whole((v["below"] - v["rest"]) / one)), below=v["rest"])
    size = lambda v: named(
        n=v["n"], most=v["most"], negative=v["top"] < zero, part=F.when((v["top"] < zero) & (v["below"] > zero), one - v["below"]).otherwise(v["below"]),
        size=whole(F.when(v["top"] >= zero, v["top"]).when(v["below"] > zero, -v["top"] - _decimal(1)).otherwise(-v["top"])))
    divide = lambda v: named(n=v["n"], most=v["most"], negative=v["negative"], part=v["part"], size=v["size"], rest=whole(F.pmod(v["size"], v["n"])))
    # half of the divisor or more is left: away from zero
    up = lambda v: (v["rest"] * _decimal(2) >= v["n"]) | ((v["rest"] * _decimal(2) + _decimal(1) == v["n"]) & (v["part"] * _decimal(2) >= one))
    rounded = lambda v: named(most=v["most"], negative=v["negative"], mean=whole((v["size"] - v["rest"]) / v["n"]) + F.when(up(v), _decimal(1)).otherwise(zero))
    result = lambda v: F.when(v["most"] < F.lit(2.0 ** 62), F.when(v["negative"], F.lit(-1.0)).otherwise(F.lit(1.0)) * (v["mean"] / power).cast("double") + F.lit(0.0))
    out = F.when(n > 0, start)
    for step in (carry, signed, size, divide, rounded, result):
        out = _let(out, step)
    return out


def stable_avg(c: Column | str, digits: int, whole: bool = False, weight: Column | str | None = None) -> Column:
    """Aggregate: ``round(avg(c), digits)`` over an exact sum.

    NULLs are ignored; an all-NULL group gives NULL. ``whole``: the values are
    whole numbers, so that one sum is enough. ``weight``: see :func:`exact_avg`.
    """
    if not whole or weight is not None:
        return exact_avg(c, digits, weight)
    n = F.count(as_col(c))
    return round_half_up(exact_sum(c, 0) / F.nullif(n, F.lit(0)), digits)


def pct_of(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """``round(100 * numerator / denominator, digits)`` as DOUBLE; NULL when
    the denominator is 0 (no division-by-zero error under ANSI)."""
    ratio = F.lit(100.0) * numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
    return round_half_up(ratio, digits)


def growth_pct(current: Column, previous: Column, digits: int = 1) -> Column:
    """Period-over-period change in percent; NULL when there is no previous
    value or it is 0."""
    return pct_of(current - previous, previous, digits)
