"""Run parameters: what the jobs compute."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Params:
    """Validated parameters of every job.

    ``as_of`` is the run date and ``as_of_ts`` the run time (naive, UTC); no operator reads the
    clock itself, so a run can be repeated. ``parity=True`` reproduces the historic quirks that
    the defaults correct.
    """

    as_of: dt.date
    as_of_ts: dt.datetime | None = None
    days_minus_hourly: int = -2
    days_minus_daily: int = -62
    sigma: float = 2.5
    months: int = 15
    min_usage: float = 3000
    leak_hours: int = 24
    leak_min: float = 5
    min_readings: int = 1
    districts: tuple[str, ...] = ()
    slot_begin: dt.datetime | None = None
    interval_suffix: str = ""
    high_usage_endpoint: str = ""
    leak_endpoint: str = ""
    job_id: str = "meterlake"
    parity: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.as_of, dt.datetime) or not isinstance(self.as_of, dt.date):
            raise ValueError("as_of must be a date")
        for name in ("days_minus_hourly", "days_minus_daily"):
            days = int(getattr(self, name))
            if days >= 0:
                raise ValueError(f"{name} must be negative, got {days}")
            object.__setattr__(self, name, days)
        for name in ("months", "leak_hours", "min_readings"):
            if int(getattr(self, name)) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.as_of_ts is None:
            object.__setattr__(self, "as_of_ts", dt.datetime.combine(self.as_of, dt.time()))
        if self.as_of_ts.tzinfo is not None:
            naive = self.as_of_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
            object.__setattr__(self, "as_of_ts", naive)
        object.__setattr__(self, "districts", tuple(self.districts))

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> "Params":
        """Build from plain text values (a JSON object, command-line pairs). Unknown keys fail."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown parameters: {unknown}")
        if "as_of" not in values:
            raise ValueError("as_of is mandatory")
        out = dict(values)
        readers = {
            "as_of": dt.date.fromisoformat,
            "as_of_ts": dt.datetime.fromisoformat,
            "slot_begin": dt.datetime.fromisoformat,
        }
        for name, read in readers.items():
            if isinstance(out.get(name), str):
                out[name] = read(out[name])
        for name in ("days_minus_hourly", "days_minus_daily", "months", "leak_hours", "min_readings"):
            if name in out:
                out[name] = int(out[name])
        for name in ("sigma", "min_usage", "leak_min"):
            if name in out:
                out[name] = float(out[name])
        if isinstance(out.get("parity"), str):
            out["parity"] = out["parity"].strip().lower() == "true"
        if isinstance(out.get("districts"), str):
            out["districts"] = tuple(d.strip() for d in out["districts"].split(",") if d.strip())
        return cls(**out)

    @classmethod
    def from_json(cls, text: str) -> "Params":
        return cls.from_mapping(json.loads(text))
