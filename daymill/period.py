"""A span of whole calendar days, both ends included."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class Period:
    start: date
    end: date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"period ends on {self.end}, before it starts on {self.start}")

    @classmethod
    def of(cls, start: str, end: str) -> Period:
        return cls(date.fromisoformat(start), date.fromisoformat(end))

    @property
    def day_after(self) -> date:
        return self.end + timedelta(days=1)

    def months(self) -> list[str]:
        """Months touched by the period, as ``YYYY-MM``."""
        first = self.start.year * 12 + self.start.month - 1
        last = self.end.year * 12 + self.end.month - 1
        return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]

    def years(self) -> list[str]:
        return [f"{y:04d}" for y in range(self.start.year, self.end.year + 1)]
