"""Job parameters. Every operator takes these instead of hard-coded literals."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, replace

from attrition.functions import values as V


def month_period(month: str) -> tuple[str, str]:
    """'2023-09' -> ('2023-09-01', '2023-09-30')."""
    y, m = (int(x) for x in month.split("-"))
    return f"{y:04d}-{m:02d}-01", f"{y:04d}-{m:02d}-{calendar.monthrange(y, m)[1]:02d}"


def months_of(first: str, last: str) -> tuple[tuple[str, str], ...]:
    """(year, month) of every month from the first day's to the last day's."""
    (y, m), end = (int(x) for x in first.split("-")[:2]), last[:7]
    out = []
    while f"{y:04d}-{m:02d}" <= end:
        out.append((f"{y:04d}", f"{m:02d}"))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return tuple(out)


@dataclass(frozen=True)
class Params:
    # source filters
    brand: str
    # install period (inclusive dates; a calendar month upstream)
    period_start: str
    period_end: str
    # sample range on the install day (inclusive)
    sample_start: str
    sample_end: str
    device: str = "Android"          # attribution event device
    os: str = "Android"              # hit device.operatingSystem
    hit_origin: str = "APP"
    customer_origin: str = "SITE"
    media_sources: tuple[str, ...] = V.MEDIA_SOURCES
    uninstall_window_days: int = 8
    hit_days_after_install: int = 1
    as_of: str | None = None         # 'today' for the age band; None: the day of the run
    # behaviour switches: defaults reproduce the upstream results
    timestamp_mode: str = "compat"
    fix_tail: bool = False
    fix_region: bool = False
    dedupe_uninstalls: bool = False
    drop_null_keys: bool = True
    outliers: str = "approx"         # approx (upstream's error bounds) | exact | off
    materialise: bool = True         # write intermediates that have several consumers

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def last_hit_day(self) -> str:
        """The last day whose hits are wanted: of the period, or after the last sampled install."""
        after = dt.date.fromisoformat(self.sample_end) + dt.timedelta(days=self.hit_days_after_install)
        return max(self.period_end, after.isoformat())

    @property
    def hit_months(self) -> tuple[tuple[str, str], ...]:
        """(year, month) of the hit partitions from the period's start to the last hit day."""
        return months_of(min(self.period_start, self.sample_start), self.last_hit_day)

    @staticmethod
    def for_month(month: str, sample_start: str, sample_end: str, brand: str, **kw) -> "Params":
        start, end = month_period(month)
        return Params(brand=brand, period_start=start, period_end=end, sample_start=sample_start,
                      sample_end=sample_end, **kw)

    @staticmethod
    def for_trailing_days(end: str | None = None, days: int = 2, *, brand: str, **kw) -> "Params":
        """Installs sampled over the last days (FN13); the period is the month, or months, that the days lie in."""
        first, last = trailing_days(end, days)
        months = sorted({first[:7], last[:7]})
        return Params(brand=brand, period_start=month_period(months[0])[0], period_end=month_period(months[-1])[1],
                      sample_start=first, sample_end=last, **kw)


def trailing_days(end: str | None = None, days: int = 2) -> tuple[str, str]:
    """FN13: the sampling window 'end - days .. end' (end defaults to today)."""
    e = dt.date.fromisoformat(end) if end else dt.date.today()
    return (e - dt.timedelta(days=days)).isoformat(), e.isoformat()


@dataclass(frozen=True)
class ModelConfig:
    step_size: float = 0.2
    max_depth: int = 6
    max_iter: int = 300
    subsampling_rate: float = 0.8
    seed: int = 42
    train_tenths: int = V.TRAIN_FRACTION_TENTHS
    split: str = "exact"             # exact (exact share, by hash order) | hash (each id on its own) | random (randomSplit)
    engine: str = "histogram"        # histogram (boosting.py) | spark (pyspark.ml's GBTClassifier)
    corr_threshold: float = V.CORR_THRESHOLD
    include_label_in_corr: bool = True
