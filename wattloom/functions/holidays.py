"""US federal holidays as an arithmetic test on a date, so no holiday list is shipped or joined."""

from __future__ import annotations

# Holidays on a date, moved to the nearest workday (month, day, first year).
ON_A_DATE = ((1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))

# Holidays on a weekday (month, weekday with Monday 0, first and last day it can fall on, first year).
ON_A_WEEKDAY = (
    (1, 0, 15, 21, 1986),
    (2, 0, 15, 21, 0),
    (5, 0, 25, 31, 0),
    (9, 0, 1, 7, 0),
    (10, 0, 8, 14, 0),
    (11, 3, 22, 28, 0),
)

# Season of each month.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}


def _falls_on(day: str, month: int, dom: int, since: int) -> str:
    return f"(month({day}) = {month} and day({day}) = {dom} and year({day}) >= {since})"


def is_holiday(day: str) -> str:
    """SQL test that is true on the observed day of a federal holiday."""
    tests = []
    for month, dom, since in ON_A_DATE:
        tests.append(f"(weekday({day}) <= 4 and {_falls_on(day, month, dom, since)})")
        tests.append(f"(weekday({day}) = 4 and {_falls_on(f'date_add({day}, 1)', month, dom, since)})")
        tests.append(f"(weekday({day}) = 0 and {_falls_on(f'date_sub({day}, 1)', month, dom, since)})")
    for month, wanted, first, last, since in ON_A_WEEKDAY:
        tests.append(
            f"(month({day}) = {month} and weekday({day}) = {wanted} "
            f"and day({day}) between {first} and {last} and year({day}) >= {since})"
        )
    return "(" + " or ".join(tests) + ")"


def season(month: str) -> str:
    cases = " ".join(f"when {month} in {months} then '{name}'" for name, months in SEASONS.items())
    return f"case {cases} end"


def calendar_columns(day: str) -> dict[str, str]:
    """Every calendar attribute of a date that needs no neighbouring row."""
    weekend = f"(weekday({day}) >= 5)"
    return {
        "year": f"year({day})",
        "quarter": f"quarter({day})",
        "month": f"month({day})",
        "day_of_month": f"day({day})",
        "day_of_week": f"weekday({day})",
        "day_of_year": f"dayofyear({day})",
        "week_of_year": f"weekofyear({day})",
        "is_weekend": weekend,
        "is_holiday": is_holiday(day),
        "is_business_day": f"not ({weekend} or {is_holiday(day)})",
        "season": season(f"month({day})"),
        "is_day_before_holiday": is_holiday(f"date_add({day}, 1)"),
        "is_day_after_holiday": is_holiday(f"date_sub({day}, 1)"),
    }
