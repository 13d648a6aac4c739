"""Constants and small frozen configs.

Everything a job needs as a parameter lives here so that the jobs themselves
stay plain functions of DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the source system's values for identical results.
# ---------------------------------------------------------------------------
SERVICE_WINDOW_HOURS = 17  # trading hours 06-22 inclusive
HOURLY_WEIGHTS = (
    0.02, 0.02, 0.02, 0.02, 0.02, 0.02, 0.04, 0.05, 0.08, 0.08, 0.06, 0.05,
    0.04, 0.04, 0.05, 0.07, 0.08, 0.08, 0.07, 0.05, 0.04, 0.03, 0.02, 0.02,
)
STOCKOUT_LAST_HOUR = 21  # a day with n stock-out hours is flagged at hours 22-n .. 21
STORE_KEY_FORMAT = "NM-STORE-%03d"
PRODUCT_KEY_FORMAT = "NM-SKU-%05d"
STORE_FORMATS = ("flagship", "standard", "outlet")
REPLENISHMENT_CLASSES = ("fast", "standard", "slow", "seasonal")
SEASONAL_PEAKS = ("spring", "summer", "fall", "winter", "year_round")
PROMO_CAMPAIGN = "Seasonal Demand Push"
MARKDOWN_CAMPAIGN = "Markdown Support"
PROMO_RISK_UPLIFT = 0.15
SEASONAL_RISK_UPLIFT = 0.10
WATCH_HOURS = 2  # silver: up to this many stock-out hours "watch"
AT_RISK_HOURS = 6  # silver: up to this many "at_risk", beyond "stockout"
CRITICAL_HOURS = 6  # gold: from this many hours the tier is "critical"
CRITICAL_LOST_SALES = 100
HIGH_HOURS = 3
PRECIPITATION_THRESHOLD = 0.2
WIND_THRESHOLD = 6
CORRECTION_SALES_FACTOR = 2.0
CORRECTION_STOCKOUT_HOURS = 8
CORRECTION_DISCOUNT = 0.85
GRID_SLICE = {"stores": 8, "products": 80, "first_day": date(2024, 3, 1), "days": 90}
GRID_BATCHES = (
    ("replay-001-seed", 1, 60),
    ("replay-002-inc", 2, 15),
    ("replay-003-inc", 3, 15),
    ("replay-004-restatement", 4, None),
)
GRID_LATE = (10007, 15)  # store, days withheld
GRID_CORRECTED = (10000, (50000, 50001, 50002, 50003, 50004), (5, 6, 7))  # store, products, day offsets
FIRST_LOAD = datetime(2024, 6, 1, tzinfo=timezone.utc)
# --------------------------------------------------------------------------- end

# Sum taken left to right, the same way the hourly split divides by it.
HOURLY_WEIGHT_TOTAL = sum(HOURLY_WEIGHTS)

RAW_GRAIN = ("store_id", "product_id", "dt")
FACT_GRAIN = ("store_key", "product_key", "date_key")
# Newest version first; nulls lose.
VERSION_ORDER = ("batch_seq", "_loaded_at")


class ReplayError(ValueError):
    """The batches do not fit the history that is to be replayed."""


@dataclass(frozen=True)
class Expected:
    """What a landed slice of the daily feed should hold."""

    stores: int
    products: int
    days: int
    batch_id: str = "static-001"
    source_dataset: str = "retail-daily-source"
    source_split: str = "train"


@dataclass(frozen=True)
class Delivery:
    """One landed batch: ``days`` of history, or (None) what is restated at the end."""

    batch_id: str
    sequence: int
    days: int | None
    loaded: datetime

    @property
    def loaded_text(self) -> str:
        return self.loaded.strftime("%Y-%m-%d %H:%M:%S+00:00")


@dataclass(frozen=True)
class Replay:
    """A history cut into deliveries, with one late store and some corrected keys."""

    first_day: date
    deliveries: tuple[Delivery, ...]
    late_store: int
    late_days: int
    corrected_store: int
    corrected_products: tuple[int, ...]
    corrected_days: tuple[int, ...]

    @property
    def windows(self) -> list[tuple[int, int, Delivery]]:
        """(first day offset, end, delivery) of the deliveries of history."""
        out, at = [], 0
        for d in self.deliveries:
            if d.days is not None:
                out.append((at, at + d.days, d))
                at += d.days
        return out

    @property
    def restatement(self) -> Delivery:
        return self.deliveries[-1]

    @property
    def days(self) -> int:
        return sum(d.days or 0 for d in self.deliveries)

    def day(self, offset: int) -> date:
        return self.first_day + timedelta(days=offset)

    def verify(self, days: int) -> None:
        """Refuse deliveries that leave days of the history out or do not land in order."""
        if self.days != days:
            raise ReplayError(f"the deliveries hold {self.days} days of a history of {days}")
        if [d.days is None for d in self.deliveries] != [False] * (len(self.deliveries) - 1) + [True]:
            raise ReplayError("the last delivery, and no other, restates")
        numbers = [d.sequence for d in self.deliveries]
        if any(a >= b for a, b in zip(numbers, numbers[1:], strict=False)):
            raise ReplayError(f"each delivery needs a higher number than the one before: {numbers}")


def deliveries(batches: tuple[tuple[str, int, int | None], ...]) -> tuple[Delivery, ...]:
    return tuple(Delivery(b, n, days, FIRST_LOAD + timedelta(hours=i)) for i, (b, n, days) in enumerate(batches))


GRID = Expected(GRID_SLICE["stores"], GRID_SLICE["products"], GRID_SLICE["days"])
GRID_REPLAY = Replay(GRID_SLICE["first_day"], deliveries(GRID_BATCHES), *GRID_LATE, *GRID_CORRECTED)

# The driver tables (TPC-H-like) carry seven years of ship dates; the fixture
# adapter maps them onto the feed with these parameters.
FIXTURE = Expected(stores=100, products=2000, days=2922, source_dataset="lineitem")
FIXTURE_REPLAY = Replay(
    first_day=date(1995, 1, 1),
    deliveries=deliveries(
        (("replay-001-seed", 1, 1461), ("replay-002-inc", 2, 730), ("replay-003-inc", 3, 731), ("replay-004-restatement", 4, None))
    ),
    late_store=7,
    late_days=365,
    corrected_store=5,
    # keys and months present at every driver scale
    corrected_products=(37, 1, 2, 3, 8, 15, 21, 23, 25, 32, 36, 39, 66, 89),
    corrected_days=(59, 120, 151, 181, 334, 365, 700, 731, 762, 882, 943, 1247, 1369, 1400, 1734, 1826, 1917, 1947, 2070, 2343),
)
FIXTURE_INGESTED_AT = "2024-06-01 00:00:00+00:00"
FIXTURE_CLIMATE_ZONES = ("coastal", "continental", "tropical", "arid", "temperate")
