"""Partial dates: struct(year, month, day, precision), read from text and URLs (DT-01, DT-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

TYPE = "struct<year:int,month:int,day:int,precision:string>"
_YEAR = r"1[5-9][0-9]{2}|20[0-3][0-9]"
DAY_MONTH_YEAR = rf"\b([0-9]{{1,2}})\s+([A-Za-z]{{3,9}})\s+({_YEAR})\b"
MONTH_DAY_YEAR = rf"\b([A-Za-z]{{3,9}})\s+([0-9]{{1,2}})(?:st|nd|rd|th)?\s*,\s*({_YEAR})\b"
LONE_YEAR = rf"(?<![0-9])({_YEAR})(?![0-9])"
#: Months; their first three letters and sept are read as well.
MONTHS = "january february march april may june july august september october november december".split()


def month_number(name: Column) -> Column:
    names = {m: i for i, m in enumerate(MONTHS, 1)} | {m[:3]: i for i, m in enumerate(MONTHS, 1)} | {"sept": 9}
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.lower(name))


def partial(year: Column, month: Column, day: Column, precision: str) -> Column:
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), day.cast("int").alias("day"), F.lit(precision).alias("precision"))


def parse_dateish(text: Column) -> Column:
    """Day forms with a known month first, else the first year from 1500 to 2039 that touches no digit, else null."""
    v, none = clean(text), F.lit(None)
    get = lambda pattern, i: F.nullif(F.regexp_extract(v, pattern, i), F.lit(""))
    day_first, month_first = month_number(get(DAY_MONTH_YEAR, 2)), month_number(get(MONTH_DAY_YEAR, 1))
    year = get(LONE_YEAR, 1)
    return (
        F.when(day_first.isNotNull(), partial(get(DAY_MONTH_YEAR, 3), day_first, get(DAY_MONTH_YEAR, 1), "day"))
        .when(month_first.isNotNull(), partial(get(MONTH_DAY_YEAR, 3), month_first, get(MONTH_DAY_YEAR, 2), "day"))
        .when(year.isNotNull(), partial(year, none, none, "year"))
    )


_END = r"(?:\.htm|\.html|/)"
URL_DAY, URL_MONTH, URL_YEAR = rf"/([0-9]{{4}})/([0-9]{{2}})/([0-9]{{2}}){_END}", rf"/([0-9]{{4}})/([0-9]{{2}}){_END}", rf"/([0-9]{{4}}){_END}"


def url_date(url: Column) -> Column:
    """The first /Y/M/D, /Y/M or /Y of a path; a match out of range leaves it to the next pattern."""
    get = lambda pattern, i: F.regexp_extract(url, pattern, i).try_cast("int")
    year_ok = lambda p: get(p, 1).between(1500, 2030)
    month_ok = lambda p: get(p, 2).between(1, 12)
    none = F.lit(None)
    return (
        F.when(year_ok(URL_DAY) & month_ok(URL_DAY) & get(URL_DAY, 3).between(1, 31), partial(get(URL_DAY, 1), get(URL_DAY, 2), get(URL_DAY, 3), "day"))
        .when(year_ok(URL_MONTH) & month_ok(URL_MONTH), partial(get(URL_MONTH, 1), get(URL_MONTH, 2), none, "month"))
        .when(year_ok(URL_YEAR), partial(get(URL_YEAR, 1), none, none, "year"))
    )


def years_of_ranges(text: Column) -> Column:
    """Years of a text in order without repeats; the end of a short range takes its start's century (DT-23)."""
    dashed = F.regexp_extract_all(text, F.lit("(?<![0-9])((?:1[5-9][0-9]{2}|20[0-3][0-9])(?:[-–](?:[0-9]{4}|[0-9]{2}))?)(?![0-9])"), 1)
    first = lambda s: F.substring(s, 1, 4).cast("int")
    last = lambda s: F.when(F.length(s) == 9, F.substring(s, 6, 4).cast("int")).when(F.length(s) == 7, F.concat(F.substring(s, 1, 2), F.substring(s, 6, 2)).cast("int"))
    return F.array_distinct(F.flatten(F.transform(dashed, lambda s: F.filter(F.array(first(s), last(s)), lambda y: y.isNotNull()))))
