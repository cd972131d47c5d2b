"""Self-describing partition values: a day, month, quarter or year in a directory name."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta

_DAY, _MONTH, _QUARTER, _YEAR = (re.compile(p) for p in (r"(\d{4})-(\d{2})-(\d{2})", r"(\d{4})-(\d{2})", r"(\d{4})Q([1-4])", r"(\d{4})"))


@dataclass(frozen=True, order=True)
class Period:
    start: date
    end: date
    value: str

    @property
    def granularity(self) -> str:
        return "day" if _DAY.fullmatch(self.value) else "month" if _MONTH.fullmatch(self.value) else "quarter" if _QUARTER.fullmatch(self.value) else "year"

    def overlaps(self, start: date | None, end: date | None) -> bool:
        return (start is None or self.end >= start) and (end is None or self.start <= end)

    def before(self) -> Period:
        """The period of the same granularity just before."""
        return parse(label(self.start - timedelta(days=1), self.granularity))  # type: ignore[return-value]

    def elapsed(self, today: date) -> float:
        """The share of the period that has passed, 0 to 1."""
        days = (self.end - self.start).days + 1
        return min(1.0, max(0.0, ((today - self.start).days + 1) / days))


def parse(value: str) -> Period | None:
    """None for what is no period (strays are skipped, not refused)."""
    try:
        if m := _DAY.fullmatch(value):
            d = date(*map(int, m.groups()))
            return Period(d, d, value)
        if m := _MONTH.fullmatch(value):
            y, mo = map(int, m.groups())
            return Period(date(y, mo, 1), _month_end(y, mo), value)
        if m := _QUARTER.fullmatch(value):
            y, q = map(int, m.groups())
            return Period(date(y, 3 * q - 2, 1), _month_end(y, 3 * q), value)
        if m := _YEAR.fullmatch(value):
            y = int(value)
            return Period(date(y, 1, 1), date(y, 12, 31), value)
    except ValueError:
        pass
    return None


def _month_end(y: int, m: int) -> date:
    return (date(y + m // 12, m % 12 + 1, 1)) - timedelta(days=1)


def label(day: date, granularity: str) -> str:
    if granularity == "quarter":
        return f"{day.year:04d}Q{(day.month + 2) // 3}"
    return {"day": f"{day:%Y-%m-%d}", "month": f"{day:%Y-%m}", "year": f"{day:%Y}"}[granularity]


def labels_between(start: date, end: date, granularity: str) -> list[str]:
    out, p = [], parse(label(start, granularity))
    while p and p.start <= end:
        out.append(p.value)
        p = parse(label(p.end + timedelta(days=1), granularity))
    return out
