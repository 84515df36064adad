"""Scalar functions used by the mart, as compositions of Spark built-ins."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact money arithmetic: amounts are summed as decimals and turned into
# double only at the end, so sums do not depend on the order rows arrive in.
MONEY = "decimal(38,4)"


def iff(cond: Column, if_true, if_false) -> Column:
    """``IFF(c, a, b)``: a NULL condition takes the false branch."""
    return F.when(cond, if_true).otherwise(if_false)


def nvl(c: Column, default) -> Column:
    """``NVL(x, d)``."""
    return F.coalesce(c, F.lit(default))


def zero_if_null(c: Column | str) -> Column:
    """``COALESCE(x, 0)``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0))


def repeated(c: Column | str, times: Column | str) -> Column:
    """The sum of ``times`` rows that hold the same value ``c``; a NULL count is one row."""
    c, n = (F.col(x) if isinstance(x, str) else x for x in (c, times))
    return F.when(F.coalesce(n, F.lit(1)) == 1, c).otherwise(c * n)


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(conds: Iterable[Column]) -> Column:
    """OR of predicates with SQL three-valued logic kept (NULL OR FALSE = NULL)."""
    return reduce(lambda a, b: a | b, conds)


def ratio6(num: Column, den: Column) -> Column:
    """``num / den`` as ``decimal(38,6)``, rounded half up. Callers filter out
    zero denominators first (ANSI mode raises on division by zero)."""
    return (num.cast("decimal(38,0)") / den.cast("decimal(38,0)")).cast("decimal(38,6)")


def days_since_epoch(c: Column | str) -> Column:
    """A date/timestamp as a day surrogate key (days since 1970-01-01)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_date(F.to_date(c)).cast("bigint")


def week_start_sk(day_sk: Column | str) -> Column:
    """Day key of the Sunday on or before a day key (1970-01-01 was a Thursday)."""
    d = F.col(day_sk) if isinstance(day_sk, str) else day_sk
    return d - F.pmod(d + F.lit(4), F.lit(7))
