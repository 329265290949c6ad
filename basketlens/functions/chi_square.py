"""Tail probability of the chi-square distribution, from built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of terms after which both expansions of erfc below are exact in doubles.
TERMS = 80
# Where the series for small arguments hands over to the continued fraction.
SWITCH = 2.5


def log_tail(statistic: Column, dof: Column) -> Column:
    """Natural log of P(X >= statistic) for whole degrees of freedom.

    A finite sum kept in logs, so it does not underflow: terms
    ``h^p e^-h / Gamma(p+1)`` with ``h`` half the statistic and ``p`` running over
    0, 1, ... for even ``dof``; over 1/2, 3/2, ... plus erfc(sqrt(h)) for odd ``dof``.
    """
    h = statistic.cast("double") / 2
    shift = (dof % 2) / 2.0
    count = F.floor(dof / 2).cast("int")
    first = F.when(shift > 0, F.log(h) / 2 - h - math.lgamma(1.5)).otherwise(-h)
    steps = F.when(count > 1, F.sequence(F.lit(1), count - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def add_term(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log(h) - F.log(i + shift)
        return F.struct(term.alias("term"), _log_add(acc["total"], term).alias("total"))

    sums = F.aggregate(
        steps,
        F.struct(first.alias("term"), first.alias("total")),
        add_term,
        lambda acc: acc["total"],
    )
    tail = (
        F.when(shift == 0, sums)
        .when(count == 0, _log_erfc(F.sqrt(h)))
        .otherwise(_log_add(sums, _log_erfc(F.sqrt(h))))
    )
    return F.when((dof > 0) & (statistic > 0), F.least(tail, F.lit(0.0))).otherwise(0.0)


def _log_add(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _log_erfc(z: Column) -> Column:
    ks = F.sequence(F.lit(1), F.lit(TERMS))
    series = F.aggregate(
        ks,
        F.struct(z.alias("term"), z.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * 2 * z * z / (2 * k + 1)).alias("term"),
            (acc["total"] + acc["term"] * 2 * z * z / (2 * k + 1)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    small = F.log(1 - 2 / math.sqrt(math.pi) * F.exp(-z * z) * series)
    fraction = F.aggregate(F.reverse(ks), z, lambda acc, k: z + k / 2.0 / acc)
    large = -z * z - math.log(math.pi) / 2 - F.log(fraction)
    return F.when(z < SWITCH, small).otherwise(large)
