"""Run parameters: one frozen value passed to every pipeline.

The clock is never read inside a plan; ``as_of`` is explicit so reruns and
tests are reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class RunSpec:
    as_of: dt.date
    start_date: dt.date | None = None
    end_date: dt.date | None = None
    device_type: str | None = None
    batch_number: int = 1
    batch_uuid: str = "batch-0"
    batch_size: int = 50
    # Retry windows (days before as_of). Device: from D-3 on; geo: D-20 .. D-1.
    retry_from_days: int = 3
    retry_to_days: int = 0
    radius_m: float = 700.0
    extra: dict = field(default_factory=dict)

    def with_range_defaults(self) -> "RunSpec":
        """Missing start -> yesterday, missing end -> start."""
        start = self.start_date or (self.as_of - dt.timedelta(days=1))
        end = self.end_date or start
        return replace(self, start_date=start, end_date=end)

    def validate(self) -> None:
        if self.start_date and self.end_date and self.start_date > self.end_date:
            raise ValueError(f"start_date {self.start_date} is after end_date {self.end_date}")
        if self.batch_size <= 0:
            raise ValueError("batch_size must be positive")


def ntz(value: dt.datetime):
    """TIMESTAMP_NTZ literal from its text: independent of the driver's and
    the session's time zone (a Python datetime literal is not)."""
    from pyspark.sql import functions as F
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


DEVICE_DEFAULTS = dict(batch_size=50, retry_from_days=3, retry_to_days=0)
GEO_DEFAULTS = dict(batch_size=500, retry_from_days=20, retry_to_days=1)
