"""Predicates on dates given as text: a day, a month, a year or any fragment."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?")


def _span(text: str) -> tuple[date, date] | None:
    """First day and first day after the year, month or day that ``text`` names."""
    match = CALENDAR.fullmatch(text)
    if not match:
        return None
    year, month, day = match.groups()
    try:
        start = date(int(year), int(month or 1), int(day or 1))
    except ValueError:
        return None
    if day:
        return start, start + timedelta(days=1)
    if month:
        return start, date(start.year + start.month // 12, start.month % 12 + 1, 1)
    return start, date(start.year + 1, 1, 1)


def _bound(rows: DataFrame, column: str, day: date) -> Column:
    return F.lit(day.isoformat()).cast(rows.schema[column].dataType)


def _day_text(rows: DataFrame, column: str) -> Column:
    if rows.schema[column].dataType.typeName() == "string":
        return F.substring(column, 1, 10)
    return F.date_format(column, "yyyy-MM-dd")


def in_date_fragment(rows: DataFrame, column: str, fragment: str) -> Column:
    """Whether the date, written YYYY-MM-DD, contains ``fragment``.

    A year, month or day becomes a half-open range on the raw column, which the
    scan can use to skip row groups and partitions. Four digits can only be the
    year and a leading year fixes the rest, so the range is the same test.
    """
    span = _span(fragment)
    if span is None:
        return _day_text(rows, column).contains(fragment)
    start, stop = span
    return (F.col(column) >= _bound(rows, column, start)) & (
        F.col(column) < _bound(rows, column, stop)
    )


def date_before(rows: DataFrame, column: str, text: str) -> Column:
    """Whether the date, as text, sorts before ``text`` (which may be partial)."""
    span = _span(text)
    if span is None:
        return _day_text(rows, column) < text
    return F.col(column) < _bound(rows, column, span[0])


def date_after(rows: DataFrame, column: str, text: str) -> Column:
    """Whether the date, as text, sorts after ``text``.

    A partial date is a prefix of its own days and sorts before them, so every day
    from its first one on is after it; a full date is strictly before its successor.
    """
    span = _span(text)
    if span is None:
        return _day_text(rows, column) > text
    start, stop = span
    return F.col(column) >= _bound(rows, column, stop if len(text) == 10 else start)


def month_of(rows: DataFrame, column: str) -> Column:
    """The first seven characters of the date: ``YYYY-MM``."""
    if rows.schema[column].dataType.typeName() == "string":
        return F.substring(column, 1, 7)
    return F.date_format(column, "yyyy-MM")
