"""Raw bureau values to bin weights in [0, 1]."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import parse

_COMPARE = {
    "<=": lambda v, cut: v <= cut,
    ">=": lambda v, cut: v >= cut,
    "==": lambda v, cut: v == cut,
    "<": lambda v, cut: v < cut,
    ">": lambda v, cut: v > cut,
}


def case(pairs, otherwise=None) -> Column:
    """``CASE WHEN`` from (condition, value) pairs; the first condition that holds wins."""
    pairs = [(c, v if isinstance(v, Column) else F.lit(v)) for c, v in pairs]
    (condition, value), *rest = pairs
    chain = reduce(lambda acc, p: acc.when(p[0], p[1]), rest, F.when(condition, value))
    if otherwise is None:
        return chain
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def bin_value(feature: str, value: Column) -> Column:
    """Bin weight of ``value`` for ``feature``; a null value is binned as 0."""
    ladder = catalog.LADDERS[feature]
    value = parse.whole(value) if ladder.whole else F.coalesce(value, F.lit(0.0))
    return case([(_COMPARE[op](value, cut), float(w)) for op, cut, w in ladder.steps], float(ladder.otherwise))


def _binner(feature: str):
    def bin_feature(value: Column) -> Column:
        return bin_value(feature, value)

    bin_feature.__name__ = f"bin_{feature}"
    bin_feature.__doc__ = f"Bin weight of a raw ``{feature}`` value."
    return bin_feature


# One function per binned feature: bin_utilisation_ratio(col), bin_num_dependants(col), ...
BINNERS = {f"bin_{feature}": _binner(feature) for feature in catalog.LADDERS}


def employer_weight(has_employer: Column) -> Column:
    return F.when(has_employer, F.lit(1.0)).otherwise(0.6)


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit(1.0)).otherwise(0.0)


def no_yes(flag: Column) -> Column:
    """1 when the flag is clear."""
    return F.when(flag, F.lit(0.0)).otherwise(1.0)
