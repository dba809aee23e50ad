"""Aggregate expressions over account, payment, enquiry and address rows of one applicant.

Each function returns one aggregate ``Column``, so a caller puts as many as needed into a single
``groupBy(applicant).agg(...)``.  All of them combine map-side with bounded state, which is what keeps
an applicant with a very large share of the rows harmless.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import parse


def status(code: Column) -> Column:
    return F.upper(F.trim(F.coalesce(code, F.lit(""))))


def any_of(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def utilisation(current: Column, opening: Column, when: Column | None = None) -> Column:
    """Mean of current/opening over accounts with an opening balance, clamped to [0, 1.2]."""
    usable = opening > 0 if when is None else (opening > 0) & when
    return F.least(F.greatest(F.coalesce(F.avg(F.when(usable, current / opening)), F.lit(0.0)), F.lit(0.0)), F.lit(1.2))


def oldest(opened: Column, when: Column | None = None) -> Column:
    return F.min(opened if when is None else F.when(when, opened))


def credit_age(oldest_opened: Column, as_of) -> Column:
    """Months since the oldest account was opened; 0 without one."""
    months = parse.months_between_calendar(as_of, oldest_opened)
    return F.coalesce(F.greatest(F.lit(0), months), F.lit(0))


def closed_good(code: Column, closed: Column, when: Column | None = None) -> Column:
    good = parse.filled(closed) & ~status(code).isin(catalog.NOT_GOOD_STATUS)
    return F.count_if(good if when is None else good & when)


def normal_text(*candidates: Column) -> Column:
    """Trimmed lower-case text of the first filled candidate, null when none is filled."""
    text = F.lower(F.trim(F.coalesce(*[F.when(c != "", c) for c in candidates])))
    return F.when(text != "", text)


def has_status(code: Column, wanted: str, when: Column | None = None) -> Column:
    hit = status(code) == wanted
    return any_of(hit if when is None else hit & when)


def default_signals(code: Column, arrears: Column, position: Column) -> dict[str, Column]:
    """Partial signals for the default flag; :func:`default_flag` turns them into the label.

    The first excluded account is kept as one lowest position per excluding status.  Numbers and flags are
    fixed-width states, which lets the whole aggregation run hash-based instead of sorting.
    """
    code, arrears = status(code), parse.whole(arrears)
    defaulted = code.isin(catalog.ADVERSE_STATUS) | ((code == "A") & (arrears >= 3))
    undecided = (code == "") | ((code == "A") & arrears.isin(1, 2))
    return {
        "n_accounts": F.count(F.lit(1)),
        **{f"first_{s}": F.min(F.when(code == s, position)) for s in catalog.EXCLUDED_STATUS},
        "saw_default": any_of(defaulted),
        "saw_decided": any_of(~undecided),
    }


SIGNALS = ["n_accounts", *[f"first_{s}" for s in catalog.EXCLUDED_STATUS], "saw_default", "saw_decided"]


def first_excluded() -> Column:
    """Excluding status with the lowest position among the signal columns, or null."""
    firsts = [F.when(F.col(f"first_{s}").isNotNull(), F.struct(F.col(f"first_{s}").alias("p"), F.lit(s).alias("code")))
              for s in catalog.EXCLUDED_STATUS]
    return F.array_min(F.array_compact(F.array(*firsts)))["code"]


def default_flag() -> Column:
    """1 defaulted, 0 not, null when excluded or undecided; over columns named as in :data:`SIGNALS`."""
    excluded = F.coalesce(*[F.col(f"first_{s}") for s in catalog.EXCLUDED_STATUS]).isNotNull()
    keep = (F.coalesce("n_accounts", F.lit(0)) > 0) & ~excluded
    return F.when(keep & F.col("saw_default"), F.lit(1)).when(keep & F.col("saw_decided"), F.lit(0))


def default_exclusion() -> Column:
    """Why there is no default flag, or null; over columns named as in :data:`SIGNALS`."""
    return (
        F.when(F.coalesce("n_accounts", F.lit(0)) == 0, F.lit("NO_ACCOUNTS"))
        .when(first_excluded().isNotNull(), F.concat(F.lit("EXCLUDED_STATUS_"), first_excluded()))
        .when(~F.col("saw_default") & ~F.col("saw_decided"), F.lit("AMBIGUOUS_ACTIVE_1_2_ARREARS"))
    )


def max_repaid_loan(code: Column, opening: Column) -> Column:
    return F.max(F.when(status(code).isin(catalog.REPAID_STATUS) & (opening > 0), opening))


def enquiries_within(asked: Column, as_of, days: int) -> Column:
    return F.count_if(F.date_diff(F.lit(as_of), asked) <= days)


def enquiry_key(enquiry_id: Column, asked_text: Column, subscriber: Column) -> Column:
    """Identity of an enquiry: its id, else date token and subscriber."""
    trimmed = F.trim(F.coalesce(enquiry_id.cast("string"), F.lit("")))
    fallback = F.concat_ws(
        "|", F.lit("fb"), F.coalesce(parse.first_token(asked_text), F.lit("")),
        F.lower(F.trim(F.coalesce(subscriber, F.lit("")))),
    )
    return F.when(trimmed != "", F.concat(F.lit("id|"), trimmed)).otherwise(fallback)


# --- payment strings: 24 month codes of one history, newest first ---------------------------------------


def months_on_time(codes: Column) -> Column:
    return F.size(F.filter(codes, lambda c: F.trim(c) == "0"))


def leading_on_time(codes: Column) -> Column:
    """Months on time before the first other code."""
    first_break = F.array_position(F.transform(codes, lambda c: F.trim(c) == "0"), F.lit(False))
    return F.when(first_break == 0, F.size(codes)).otherwise(first_break.cast("int") - 1)


def worst_month(codes: Column) -> Column:
    """Largest arrears number among the codes, at least 0."""
    numbers = F.transform(codes, lambda c: F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("int")))
    return F.greatest(F.coalesce(F.array_max(numbers), F.lit(0)), F.lit(0))


def streak_over_histories(position: Column, lead: Column, length: Column) -> dict[str, Column]:
    """Partial aggregates for a streak that runs over histories at dense positions 1..n and never reopens.

    All histories before the first broken one count in full, so the broken one with the lowest position
    is all that is needed besides the total length.  Position and lead share one number, a fixed-width state.
    """
    return {
        "first_broken": F.min(F.when(lead < length, position.cast("long") * 1000 + lead)),
        "total_months": F.sum(length),
        "months_per_history": F.max(length),
    }


def streak(first_broken: Column, total_months: Column, months_per_history: Column) -> Column:
    position, lead = F.floor(first_broken / 1000), first_broken % 1000
    return F.when(first_broken.isNull(), F.coalesce(total_months, F.lit(0))).otherwise(
        (position - 1) * months_per_history + lead)
