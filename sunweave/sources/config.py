"""A run's settings from an environment, typed and checked, and the lists of dates that they name."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date


def _flag(text: str) -> bool:
    known = {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False}
    if (low := text.strip().lower()) not in known:
        raise ValueError(f"neither true nor false: {text!r}")
    return known[low]


@dataclass(frozen=True)
class RunConfig:
    """Settings by name; a variable SUNWEAVE_<NAME> overrides the default."""

    run_id: str = "run"
    start_minute: int = 180
    end_minute: int = 1260
    step_minute: int = 3
    windows: int = 6
    section_metres: float = 1000.0
    sample_spacing: float = 2.0
    guard_degrees: float = 5.0
    lease_seconds: int = 120
    heartbeat_seconds: int = 30
    max_tasks_per_shard: int = 12
    max_imbalance: float = 1.25
    affinity: bool = True

    @classmethod
    def load(cls, environment: Mapping[str, str], prefix: str = "SUNWEAVE_") -> RunConfig:
        """Reads the variables that are set and not empty; ValueError names the one that can't be read or doesn't fit."""
        read = {"int": int, "float": float, "str": str, "bool": _flag}
        values = {}
        for f in dataclasses.fields(cls):
            text = environment.get(name := prefix + f.name.upper(), "")
            if text.strip():
                try:
                    values[f.name] = read[f.type](text.strip())
                except ValueError as e:
                    raise ValueError(f"{name}: {e}") from e
        out = cls(**values)
        out.check()
        return out

    def check(self) -> None:
        span = self.end_minute - self.start_minute
        rules = {
            "the day must end after it starts": span > 0,
            "steps must divide the day": self.step_minute > 0 and span % max(1, self.step_minute) == 0,
            "windows must divide the day into whole steps": self.windows > 0 and span % max(1, self.windows * self.step_minute) == 0,
            "the lease must hold three heartbeats": self.lease_seconds >= 3 * self.heartbeat_seconds > 0,
            "sections, spacing and tasks must be positive": min(self.section_metres, self.sample_spacing, self.max_tasks_per_shard) > 0,
            "imbalance is at least 1": self.max_imbalance >= 1,
            "the guard is an angle above the horizon": 0 <= self.guard_degrees < 90,
            "a run needs a name": bool(self.run_id),
        }
        if broken := [rule for rule, good in rules.items() if not good]:
            raise ValueError("; ".join(broken))


def planned_dates(spec: str, year: int) -> list[date]:
    """Dates of "M.D, M.D": sorted, each once; a token that is none raises."""
    out = set()
    for token in spec.replace(",", " ").split():
        month, dot, day = token.partition(".")
        try:
            if not dot:
                raise ValueError("expected M.D")
            out.add(date(year, int(month), int(day)))
        except ValueError as e:
            raise ValueError(f"bad date {token!r}: {e}") from e
    return sorted(out)


def typed_dates(spec: str) -> list[tuple[int, int]]:
    """(month, day) of "M.D, M.D" in order, what isn't two whole numbers left out; no calendar is asked."""
    out = []
    for token in spec.replace(",", " ").split():
        parts = token.split(".")
        if len(parts) == 2 and all(p.strip().lstrip("+-").isdigit() for p in parts):
            out.append((int(parts[0]), int(parts[1])))
    return out
