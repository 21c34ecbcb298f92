"""Cleaning rules as column expressions. All parsing is null-on-failure, so ANSI mode never stops a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapwise import constants as C


def trimmed(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def code(column: Column) -> Column:
    return F.upper(F.trim(column))


def title(column: Column) -> Column:
    return F.initcap(F.trim(column))


def iso_date(column: Column) -> Column:
    return F.try_to_timestamp(column, F.lit("yyyy-MM-dd")).cast("date")


def start_timestamp(date: Column, time: Column) -> Column:
    """Start of a race; null without a time or with an unreadable one."""
    text = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), time)
    return F.when(time.isNotNull(), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def any_format_timestamp(column: Column, formats: list[str] | None = None) -> Column:
    """First format that reads the text wins."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) for f in formats or C.DATE_FORMATS])


def minutes_of_day(start: Column) -> Column:
    return F.hour(start) * 60 + F.minute(start) + F.second(start) / 60.0


def season_phase(round_: Column) -> Column:
    return F.when(round_ <= 5, "Early").when(round_ <= 15, "Mid").otherwise("Late")


def full_name(forename: Column, surname: Column) -> Column:
    return F.concat(forename, F.lit(" "), surname)


def age_group(dob: Column) -> Column:
    return (
        F.when(dob > F.lit("2000-01-01").cast("date"), "Gen Z")
        .when(dob > F.lit("1980-01-01").cast("date"), "Millennial")
        .otherwise("Gen X/Boomer")
    )


def circuit_region(country: Column) -> Column:
    regions = {"Europe": C.EUROPE, "Americas": C.AMERICAS, "Asia-Pacific": C.ASIA_PACIFIC}
    found = [F.when(country.isin(*countries), region) for region, countries in regions.items()]
    return F.coalesce(*found, F.lit("Other"))


def whole_number(text: Column) -> Column:
    """Digits only; anything else, such as ``\\N``, becomes null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def within(column: Column, bounds: tuple[int, int]) -> Column:
    return column.between(*bounds)


def within_or_null(column: Column, bounds: tuple[int, int]) -> Column:
    return column.isNull() | column.between(*bounds)


def whole_within_or_null(column: Column, bounds: tuple[int, int]) -> Column:
    """The same for whole numbers as one membership test: a parsed column is then evaluated once per row, also
    after the optimizer has moved the filter below the parsing."""
    low, high = bounds
    return F.coalesce(column, F.lit(low)).isin(*range(low, high + 1))


def flag(test: Column) -> Column:
    """A boolean with null counted as false."""
    return F.coalesce(test, F.lit(False))


def pit_category(milliseconds: Column) -> Column:
    bounds = iter(C.PIT_CATEGORIES)
    limit, label = next(bounds)
    result = F.when(milliseconds < limit, label)
    for limit, label in bounds:
        result = result.when(milliseconds < limit, label)
    return result.otherwise(C.PIT_CATEGORY_LAST)


def number_or_zero(column: Column) -> Column:
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def clamp(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), column))
