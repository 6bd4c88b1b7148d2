"""Local time, run slots and date ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOCAL_OFFSET_HOURS = 3
RUN_SLOTS = [10, 12, 15, 18]
SLOT_TOLERANCE_MINUTES = 10
END_OF_DAY_HOUR = 18
PRESET_DAYS = {"today": 0, "last_7_days": 7, "last_30_days": 30, "last_90_days": 90, "last_year": 365}
ALL_TIME_START = date(2020, 1, 1)
# End of fixed values.


def local_time(ts: Column) -> Column:
    """Wall clock at the fixed UTC+3 offset (the session zone is UTC)."""
    return ts + F.expr(f"INTERVAL {LOCAL_OFFSET_HOURS} HOURS")


def classify_run(ts: Column, now: Column | None = None) -> Column:
    """Struct telling whether a run started in a planned slot, and which slot came before.

    ``now`` is the moment the check is made (the run itself by default). A missing
    timestamp is never reported as manual.
    """
    wall = local_time(ts)
    in_slot = F.hour(wall).isin(RUN_SLOTS) & (F.minute(wall) <= SLOT_TOLERANCE_MINUTES)
    current = F.hour(local_time(ts if now is None else now))
    earlier = F.filter(F.array(*[F.lit(h) for h in RUN_SLOTS]), lambda h: h < current)
    return F.struct(
        F.coalesce(in_slot, F.lit(False)).alias("scheduled"),
        F.coalesce(~in_slot, F.lit(False)).alias("manual"),
        F.date_format(wall, "HH:mm").alias("run_time"),
        F.coalesce(F.array_max(earlier), F.lit(RUN_SLOTS[-1])).alias("previous_slot"),
    )


def target_date(now: datetime, date_key: str | None = None, days_back: int | None = None) -> str:
    """Day (or month) key of a pull: as asked, else so many local days before ``now``."""
    if date_key:
        return date_key
    local = now.astimezone(timezone(timedelta(hours=LOCAL_OFFSET_HOURS)))
    return (local - timedelta(days=days_back or 0)).strftime("%Y-%m-%d")


def preset_range(name: str, as_of: date) -> tuple[date, date]:
    """Both ends of a named reporting range."""
    if name == "all_time":
        return ALL_TIME_START, as_of
    return as_of - timedelta(days=PRESET_DAYS[name]), as_of


def comparison_range(start: date, end: date, mode: str) -> tuple[date, date]:
    """Base period of a comparison: the period before, the year before or the month before."""
    if mode == "previous_period":
        return start - timedelta(days=(end - start).days + 1), start - timedelta(days=1)
    shift = timedelta(days={"previous_year": 365, "previous_month": 30}[mode])
    return start - shift, end - shift
