"""Money is summed as whole paise, so that sums do not depend on the plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

PAISE = 100
LAKH = 100_000


def to_paise(price: Column, qty: Column) -> Column:
    return F.round(price * PAISE).cast("bigint") * qty.cast("bigint")


def rupees(paise: Column) -> Column:
    return paise / F.lit(PAISE)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it.

    Spelled out, a rounding repeats its steps 6 to 20 times, and a few of them make generated code that the JVM
    will not compile.
    """
    return F.transform(F.array(value), f)[0]


def _scaled(x: Column, digits: int, ties_up: bool) -> Column:
    """x * 10^digits as a whole number, rounded by the exact binary value of x (from 2^-8 to below 2^45).

    x is n / 2^k with whole n and k, so its digits follow from whole-number arithmetic.
    """

    def rounded(k: Column, tens: Column, whole: Column) -> Column:
        rest = tens - F.call_function("shiftleft", whole, k)
        half = F.call_function("shiftleft", F.lit(1).cast("bigint"), k - 1)
        up = rest >= half if ties_up else (rest > half) | ((rest == half) & (whole % 2 == 1))
        return whole + up.cast("bigint")

    def places(k: Column) -> Column:
        tens = (x * F.pow(F.lit(2.0), k)).cast("bigint") * F.lit(10**digits)
        return _let(tens, lambda t: _let(F.call_function("shiftright", t, k), lambda whole: rounded(k, t, whole)))

    return _let((F.lit(53) - F.floor(F.log2(x))).cast("int"), places)


def scaled(x: Column, digits: int, ties_up: bool = False) -> Column:
    """|x| * 10^digits as a whole number: half-even on the binary value of x, or half-up."""

    def of(size: Column) -> Column:
        return (
            F.when(size < 2.0**-8, F.lit(0).cast("bigint"))
            .when(size < 2.0**45, _scaled(size, digits, ties_up))
            .otherwise(F.round(size * 10**digits).cast("bigint"))
        )

    return _let(F.abs(x), of)


def half_even(x: Column, digits: int) -> Column:
    """x rounded to so many decimals, half-even on its binary value: 2.675 gives 2.67, 0.25 gives 0.2."""
    return F.signum(x) * (scaled(x, digits) / F.lit(10**digits))


def fixed_text(x: Column, digits: int, ties_up: bool = False) -> Column:
    """x with so many decimals (0 or 1); the sign stays where the digits are all 0."""
    units = scaled(x, digits, ties_up)
    sign = F.when(x < 0, "-").otherwise("")
    if digits == 0:
        return F.concat(sign, units.cast("string"))
    return F.concat(sign, F.call_function("div", units, F.lit(10)).cast("string"), F.lit("."), (units % 10).cast("string"))


def lakh_text(paise: Column, ties_up: bool = True) -> Column:
    """`1.2L`; ties go up, or to even."""
    return F.concat(fixed_text(paise / F.lit(PAISE) / F.lit(LAKH), 1, ties_up), F.lit("L"))
