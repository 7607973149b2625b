"""Run parameters and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domain codes, order states and event states of the source system.
MARKET_DOMAINS = (1, 3)
FOOD_DOMAIN = 2
WATER_DOMAIN = 4
ARTISAN_DOMAIN = 6
FINISHED_STATUSES = (900, 1000)
DIRECT_DELIVERY = 1
REFILL_STATUS = 4100
AVAILABLE_STATUS = 200
BUSY_STATUS = 900
QUIET_HOURS = (2, 3, 4, 5, 6, 7)
# Distance labels and step of a leg back to the warehouse.
ROAD = "osrm"
GPS = "gps"
PREDICTED = "predicted"
RETURN_STEP = -1
# Refill trip labels.
REFILL_TRIP = "refill"
BUSY_TRIP = "busy_return_warehouse"
# Pads, retention, caps and batch size.
MARKET_LOOK_BACK_HOURS = 2
WATER_LOOK_BACK_HOURS = 24
REFILL_LOOK_AHEAD_HOURS = 2
RETENTION_DAYS = 31
WATER_KM_CAP = 13.0
LEGS_PER_CALL = 50
ERROR_REPORT_ROWS = 100
PREVIEW_ROWS = 200
# Partition column of tables stored by day: the UTC day of the effective date, or of an event's time.
EVENT_DAY = "event_day"
# Time zone of the water line's drop order, and ISO text layout.
HOME_ZONE = "Europe/Istanbul"
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def as_datetime(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def ntz(value: datetime | str) -> Column:
    """A zone-less timestamp literal; folded to a constant, so it reaches the parquet filter."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class RunWindow:
    """Half-open UTC window ``[start, end)`` of one run."""

    start: datetime | str
    end: datetime | str

    @property
    def lo(self) -> Column:
        return ntz(self.start)

    @property
    def hi(self) -> Column:
        return ntz(self.end)

    def widened(self, back_hours: int = 0, ahead_hours: int = 0) -> "RunWindow":
        return RunWindow(
            as_datetime(self.start) - timedelta(hours=back_hours),
            as_datetime(self.end) + timedelta(hours=ahead_hours),
        )


@dataclass(frozen=True)
class Reasons:
    """Ids of the two status-change reasons; they belong to a deployment, so they are arguments."""

    refill: str = "refill"
    busy: str = "busy"


@dataclass(frozen=True)
class SplitPolicy:
    """An ordered group of more than ``rows`` rows is cut into pieces of about that many."""

    rows: int = 5_000_000


@dataclass(frozen=True)
class JobConfig:
    mode: str
    window: RunWindow
    updated_at: datetime | str
    line: str = "all"
    warehouses: tuple[str, ...] = ("all",)
    reasons: Reasons = field(default_factory=Reasons)
    split: SplitPolicy = field(default_factory=SplitPolicy)
    partner_label: str = "partner"
    partner_period: str = "hourly"
    zero_offset_is_null: bool = True
