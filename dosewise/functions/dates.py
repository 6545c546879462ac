"""Weekday names, ages and age bands as plain column expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shift rosters name the weekday in English, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Age-band labels in report order; '0' marks an age no band covers.
NO_BAND = "0"
BAND_LABELS = ("0-9", "10-19", "20-39", "40-59", "60+")
ALL_BANDS = (NO_BAND,) + BAND_LABELS

# Band edges, lower bound inclusive and upper exclusive. The first set
# is the one in use: it ends two bands a year early, so age 39 counts as 40-59 and
# age 59 falls in no band. The second set does what the labels say.
BAND_EDGES = {
    "reference": ((None, 10), (10, 20), (20, 39), (39, 59), (60, None)),
    "labelled": ((None, 10), (10, 20), (20, 40), (40, 60), (60, None)),
}

# Fixed value: seconds in a mean Gregorian year of 365.2425 days.
MEAN_YEAR_SECONDS = 31_556_952


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(day) + 1)


def age_years(birthday: Column, as_of: date | datetime, mode: str = "mean_year") -> Column:
    """Whole years lived at ``as_of``.

    ``mean_year`` divides the elapsed time, time of day included, by the mean year;
    ``calendar`` counts birthdays.
    """
    day = F.lit(as_of.date() if isinstance(as_of, datetime) else as_of)
    if mode == "calendar":
        before_birthday = F.date_format(day, "MMdd") < F.date_format(birthday, "MMdd")
        return F.year(day) - F.year(birthday) - before_birthday.cast("int")
    if mode != "mean_year":
        raise ValueError(f"unknown age mode {mode!r}")
    time_of_day = 0
    if isinstance(as_of, datetime):
        time_of_day = as_of.hour * 3600 + as_of.minute * 60 + as_of.second
    elapsed = F.datediff(day, birthday).cast("bigint") * 86_400 + time_of_day
    return F.floor(elapsed / MEAN_YEAR_SECONDS).cast("int")


def age_band(age: Column, bands: str = "reference") -> Column:
    result = F.lit(NO_BAND)
    for label, (low, high) in zip(BAND_LABELS, BAND_EDGES[bands]):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (age >= low)
        if high is not None:
            inside = inside & (age < high)
        result = F.when(inside, F.lit(label)).otherwise(result)
    return result
