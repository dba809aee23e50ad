"""Text to number and date conversions that never fail a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number_or_null(text: Column) -> Column:
    """Money text such as ``'1,250.50'`` to double, null when it is not a number."""
    cleaned = F.trim(F.regexp_replace(text.cast("string"), ",", ""))
    return F.when(cleaned.rlike(NUMBER), cleaned.try_cast("double"))


def safe_number(text: Column) -> Column:
    """Like :func:`number_or_null` with 0 for blanks and rubbish."""
    return F.coalesce(number_or_null(text), F.lit(0.0))


def whole(value: Column) -> Column:
    """Truncate towards zero; an unusable value counts as 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0)).try_cast("long")


def filled(text: Column) -> Column:
    """True when a text is neither null nor blank."""
    return F.coalesce(F.trim(text.cast("string")) != "", F.lit(False))


def non_blank(*candidates: Column) -> Column:
    """First candidate that is not null and not blank."""
    return F.coalesce(*[F.when(filled(c), c) for c in candidates])


def first_token(text: Column) -> Column:
    """Text up to the first white space, without leading white space."""
    return F.substring_index(F.trim(F.translate(text, "\t\n\r", "   ")), " ", 1)


def parse_date(text: Column) -> Column:
    """First token as a date in one of three layouts, else null.

    The position of the first separator picks the layout, so a value goes through one parse attempt at most.
    """
    token = first_token(text)
    slash, dash = F.instr(token, "/"), F.instr(token, "-")
    return (
        F.when(slash == 5, F.try_to_date(token, "yyyy/M/d"))
        .when(slash.isin(2, 3), F.try_to_date(token, "d/M/yyyy"))
        .when(dash == 5, F.try_to_date(token, "yyyy-M-d"))
    )


def day_first_date(text: Column) -> Column:
    """Birth dates come in one layout only."""
    token = first_token(text)
    return F.when(F.instr(token, "/").isin(2, 3), F.try_to_date(token, "d/M/yyyy"))


def months_between_calendar(later, earlier: Column) -> Column:
    """Difference of year/month numbers; days are ignored."""
    later = F.lit(later)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def age_in_years(birth: Column, as_of) -> Column:
    """Completed years; 0 when the birth date is unknown."""
    as_of = F.lit(as_of)
    before_birthday = F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    return F.coalesce(F.year(as_of) - F.year(birth) - before_birthday.cast("int"), F.lit(0))


# Date layouts in the order they are tried, with the shape each accepts.
DATE_LAYOUTS = [
    ("ISO", r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    ("US_SLASH", r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    ("US_DASH", r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    ("EU_SLASH", r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    ("EU_DASH", r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    ("EU_DOT", r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    ("YYYY_SLASH", r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
]


def date_layout(text: Column) -> Column:
    """Name of the first layout whose shape matches and which yields a real date."""
    value = F.trim(text)
    tried = [
        F.when(value.rlike(shape) & F.try_to_date(value, layout).isNotNull(), F.lit(name))
        for name, shape, layout in DATE_LAYOUTS
    ]
    return F.coalesce(*tried)


def date_to_iso(text: Column) -> Column:
    """Any supported date text as ``yyyy-MM-dd``, null when it is no date."""
    value = F.trim(text)
    tried = [
        F.when(value.rlike(shape), F.try_to_date(value, layout)) for _, shape, layout in DATE_LAYOUTS
    ]
    return F.date_format(F.coalesce(*tried), "yyyy-MM-dd")
