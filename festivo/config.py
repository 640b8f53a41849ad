"""Run parameters and the fixed values of the model."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- fixed values -----------------------------------------------------------
PROMO_STEP_CODES = ("P", "B")
NO_EXPIRY_WEEK = "209952"
PLAN_VALIDITY_DAYS = 56
WIDE_STORE_RANGE = (1001, 5999)
NARROW_STORE_RANGE = (1001, 4999)
NARROW_RANGE_COUNTRIES = ("CZ", "SK")
MODEL_STORE_RANGE = (1000, 5999)
EARLY_START_STORES = (("CZ", 1029), ("SK", 1014), ("SK", 1102), ("SK", 4155), ("HU", 1520))
EARLY_START_WEEKDAYS = (2, 3, 4)
CLUSTERING_EXCLUDED_DAYS = ("12-25", "12-26", "01-01")
NEVER_HOLIDAY = "12-24"
MOVABLE_EVENT = "EASTER"
SPECIAL_DAYS = ("12-23", "12-24", "12-30", "12-31")
COUNTRY_SPECIAL_DAYS = (("SK", "01-05"),)
FIXED_DATE_DAYS = ("12-04", "12-05", "12-06")
BASE_SHARE_ONLY_DAYS = ("12-31", "12-06")
HOURS_LABEL_SHIFTS = {
    "THIS WEEK CLOSE": (0,),
    "WEEK + 1 CLOSE": (7,),
    "WEEK + 2 CLOSE": (14,),
    "WEEK + 3 CLOSE": (21,),
    "WEEK + 4 CLOSE": (28,),
    "WEEK + 5 CLOSE": (35,),
    "WEEK + 6 CLOSE": (42,),
    "WEEK + 7 CLOSE": (49,),
    "WEEK + 8 CLOSE": (56,),
    "STANDARD CLOSE": tuple(range(63, 155, 7)),
}
FACTOR_CAP = 0.999
TARGET_FLOOR, TARGET_CEILING = 0.02, 0.999
UPLOAD_CEILING, UPLOAD_CAPPED = 99.99, 99.9
FIRST_DAY_DAMPING, FIRST_DAY_MIN_UPLIFT = 0.55, 1.2
PLACEHOLDER_COUNTRY = "XX"
GAP_FILL_SOURCE_DATE = date(1900, 1, 1)
WEEKDAY_NAMES = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
PROMO_WEEKS = 10
IN_OUT_MARK = "I/O"
LEAFLET_DATES = 10
EXCLUDED_DEPARTMENTS = ("0011", "0012", "0014")
PARTLY_EXCLUDED_DEPARTMENT = "0012"
KEPT_SECTIONS_OF_PARTLY_EXCLUDED = ("-", "1206", "1208")
# ---------------------------------------------------------------------------

LEVELS = ("division", "department", "section", "grp", "subgroup")
LEVEL_NUMBER = {"division": 1, "department": 2, "section": 3, "grp": 4, "subgroup": 5}
ROLLED_UP = "-"


@dataclass(frozen=True)
class GateRule:
    """Thresholds a hierarchy node has to pass at one level; ``None`` = not tested."""

    min_sales: float | None = None
    sales_per_row: float | None = None
    min_ratio: float | None = None
    min_ratio_to_base: float | None = None
    max_weekly_promo_ratio: float | None = None
    min_event_base_ratio: float | None = None
    enforced_min_sales: float | None = None
    enforced_sales_per_row: float | None = None


DEFAULT_GATES: dict[str, GateRule] = {
    "subgroup": GateRule(70, 100, 2.0, 0.75, 0.70, 0.70, 10, 10),
    "grp": GateRule(70, 100, None, 0.75, 0.80, 0.70, 10, 10),
    "section": GateRule(50, 80, enforced_min_sales=10, enforced_sales_per_row=10),
    "department": GateRule(50, 80),
    "division": GateRule(),
}


def monday_of(yearweek: str) -> date:
    """Monday of a ``yyyyww`` week."""
    return date.fromisocalendar(int(yearweek[:4]), int(yearweek[4:]), 1)


@dataclass(frozen=True)
class RunConfig:
    """One run of the model or of the upload.

    ``country=None`` computes every country at once, keyed by country.
    """

    event_id: str = "CHRISTMAS"
    as_of: date = date(2000, 12, 1)
    country: str | None = None
    base_weeks: tuple[str, ...] = ("199944", "199945", "199946")
    norm_years: tuple[int, ...] = (1997, 1998, 1999)
    weeks_before: int = 4
    weeks_after: int = 1
    min_week_sales: float = 1000.0
    min_products_per_store: int = 100
    small_cluster: int = 6
    gates: dict[str, GateRule] = field(default_factory=lambda: dict(DEFAULT_GATES))
    departments: tuple[int, ...] | None = None
    excluded_sections: tuple[int, ...] = ()
    excluded_departments: tuple[str, ...] = EXCLUDED_DEPARTMENTS
    promo_week: str | None = None
    week_reupload: bool = False
    added_promotions: bool = False
    base_promo_division: str = "4"
    hours_snapshot_days: int = 6
    early_start_stores: tuple[tuple[str, int], ...] = EARLY_START_STORES

    @property
    def event_id_key(self) -> str:
        return self.event_id.upper()

    @property
    def fy_year(self) -> int:
        return self.as_of.year

    @property
    def ly_year(self) -> int:
        return self.as_of.year - 1

    @property
    def latest_base_week(self) -> str:
        return max(self.base_weeks)

    @property
    def base_monday(self) -> date:
        """First day of the latest base week."""
        return monday_of(self.latest_base_week)

    @property
    def event_years(self) -> tuple[int, ...]:
        """Years whose event dates a run looks at."""
        return tuple(sorted({*self.norm_years, self.ly_year, self.fy_year}))
