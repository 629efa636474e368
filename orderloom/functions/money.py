"""Order-independent sums and means of money and measures.

A sum of doubles depends on the order in which partitions are merged, and a mean
that falls on half a cent may then round either way. Here values are added as
decimals with ten places, so a sum has the same digits under any partitioning, and
the result is rounded half up once. A sum holds 27 digits before the point.

Decimals of that size are objects, and adding them is slow. A value that is a number of
whole cents is added as a long (``cents``), and only what is not goes by ``rest`` as a
decimal: both sums together are exact, and mostly the second one is empty.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

#: Of one value: up to 18 digits before the point.
TERM = "DECIMAL(28, 10)"
#: Values of fewer cents are summed as longs; no long overflows by 2^32 of them.
MOST_CENTS = 1 << 31
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


def units(name: str) -> Column:
    """A column as an exact term; null stays null; NaN and infinite values become null.

    A number that is too large for a term raises an error instead of leaving a sum silently.
    """
    value = F.col(_quoted(name)).cast("double")
    term = value.try_cast(TERM)
    lost = term.isNull() & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    refused = F.raise_error(F.concat(F.lit(f"{name} is too large to be summed: "), value.cast("string"))).cast(TERM)
    return F.when(lost, refused).otherwise(term)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cents(name: str) -> Column:
    """A column as a long number of cents; null where it is not exactly that, ``rest`` has it then."""
    value = F.col(_quoted(name)).cast("double")
    whole = F.rint(value * 100.0)
    return F.when((F.abs(whole) < MOST_CENTS) & (whole / 100.0 == value), whole.cast("bigint"))


def rest(name: str) -> Column:
    """A column as an exact term where it is not a whole number of cents; null elsewhere."""
    return F.when(cents(name).isNull(), units(name))


def sum_rest(name: str) -> Column:
    """The sum of a column of ``rest``, null if there was none.

    Rows without one are filtered out, so that they do not touch the decimal, an object, at all.
    """
    return F.expr(f"sum({_quoted(name)}) FILTER (WHERE {_quoted(name)} IS NOT NULL)")


def _both(whole: Column, others: Column) -> Column:
    """A sum of cents and a sum of other terms, each null if there were none, as one exact sum."""
    exact = (whole.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(37,10)")
    return F.when(others.isNull(), exact).when(whole.isNull(), others).otherwise(exact + others.cast("decimal(37,10)"))


def _only(whole: str, others: str) -> Column:
    """Whether cents alone were summed, to a number that is exact as a double."""
    return F.col(_quoted(others)).isNull() & (F.abs(F.col(_quoted(whole))) < EXACT)


def sum_to_cents(whole: str, others: str) -> Column:
    """The sums of ``cents`` and of ``rest``, rounded to cents, as a double."""
    both = _both(F.col(_quoted(whole)), F.col(_quoted(others)))
    return F.when(_only(whole, others), F.col(_quoted(whole)) / 100.0).otherwise(F.round(both, 2).cast("double"))


def sum_mean_to_cents(whole: str, others: str, count: str) -> Column:
    """The sums of ``cents`` and of ``rest`` over a count, rounded to cents; null where nothing was counted.

    What cents alone do not decide goes through a lambda, which is not part of the
    generated code: several such means in one method would be too long to be compiled.
    """
    c, n = _quoted(whole), _quoted(count)
    quick = F.signum(F.col(c)) * F.expr(f"(2 * abs({c}) + {n}) div (2 * {n})") / 100.0
    sums = F.struct(F.col(c).alias("c"), F.col(_quoted(others)).alias("r"), F.col(n).alias("n"))
    exact = F.transform(F.array(sums), lambda s: _mean(_both(s["c"], s["r"]), s["n"]))[0]
    return F.when(_only(whole, others) & F.col(n).between(1, EXACT), quick).otherwise(exact)


def sum_unrounded(whole: str, others: str) -> Column:
    """The sums of ``cents`` and of ``rest`` as a double."""
    both = _both(F.col(_quoted(whole)), F.col(_quoted(others)))
    return F.when(_only(whole, others), F.col(_quoted(whole)) / 100.0).otherwise(both.cast("double"))


def to_cents(total: str) -> Column:
    """A sum of terms, rounded to cents, as a double."""
    return F.round(F.col(_quoted(total)), 2).cast("double")


def mean_to_cents(total: str, count: str) -> Column:
    """A sum of terms over a count, rounded to cents; null where nothing was counted.

    Whole numbers are divided, so that no rounding comes before the last.
    """
    return _mean(F.col(_quoted(total)), F.col(_quoted(count)))


def _mean(total: Column, count: Column) -> Column:
    whole = total.cast("decimal(38,10)") * F.lit("10000000000").cast("decimal(11,0)")
    size = F.abs(whole).cast("decimal(38,0)")
    unit = (F.lit(100_000_000) * F.when(count > 0, count)).cast("decimal(28,0)")
    rounded = F.floor((size - size % unit) / unit) + F.when(2 * (size % unit) >= unit, 1).otherwise(0)
    return (F.signum(total) * rounded).cast("double") / 100.0


def unrounded(total: str) -> Column:
    """A sum of terms as a double."""
    return F.col(_quoted(total)).cast("double")
