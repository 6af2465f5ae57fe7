"""One immutable settings object, passed explicitly to every operator.

Nothing in the package reads the environment or module-level state; two jobs with
different day lengths or thresholds can run in one session.
"""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    # Simulated clock: day N covers [epoch + N*day_seconds, epoch + (N+1)*day_seconds).
    epoch_seconds: float = 1767225600.0
    day_seconds: int = 300

    # Fixed domain values: zones, plausible reading cap, tariff tiers, subsidy.
    zones: tuple[str, ...] = ("North", "South", "East", "West")
    max_reading_kwh: float = 50.0
    tiers: tuple[str, ...] = ("residential_low", "residential_standard", "residential_high")
    subsidy_discount_pct: float = 15.0

    # Decimal places kept exactly inside kWh sums.
    kwh_scale: int = 6

    # Speed layer.
    window: str = "30 seconds"
    slide: str = "15 seconds"
    watermark: str = "1 minute"
    trigger: str = "10 seconds"
    max_offsets_per_trigger: int = 20_000

    # Alert thresholds.
    low_renewable_pct: float = 10.0
    daylight_start: float = 0.40
    daylight_end: float = 0.60
    no_data_seconds: float = 120.0
    invalid_rate_pct: float = 5.0
    stream_lag_seconds: float = 60.0
    drift_pct: float = 10.0
    lag_batches: int = 3

    # Look-back horizons.
    quality_window_seconds: int = 300
    retention_seconds: int = 6 * 3600
    pending_lookback_days: int = 3
    # Failed runs older than this are no longer looked at.
    failure_horizon_days: int = 7
    # Gauge samples further apart say nothing about the time between them.
    sample_gap_seconds: float = 300.0
    # Rule passes whose changes are kept.
    kept_passes: int = 1000
    # How long readers may use what a newer version has replaced.
    grace_seconds: int = 600
    # Folded micro-batches of the lake stay for so long, for billing runs that listed them before.
    lake_grace_seconds: int = 86400
    # A finished day of the lake is compacted once it has so many loose micro-batches.
    compact_batches: int = 16
    # A run that wrote nothing for so long and has not committed is given up.
    abandoned_seconds: int = 7 * 86400

    @property
    def window_seconds(self) -> int:
        """Length of `window`, a number of seconds or minutes."""
        number, unit = self.window.split()
        return int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]

    @property
    def epoch_micros(self) -> int:
        return round(self.epoch_seconds * 1_000_000)

    @property
    def day_micros(self) -> int:
        return self.day_seconds * 1_000_000

    @property
    def component_budgets(self) -> dict[str, float]:
        """Seconds each budgeted component may stay silent; others get `no_data_seconds`."""
        return {
            "meter_producer": self.no_data_seconds,
            "speed_layer": self.no_data_seconds,
            "alerts_engine": self.no_data_seconds,
            "batch_layer": 2 * self.day_seconds + self.no_data_seconds,
        }

    @property
    def expected_components(self) -> tuple[str, ...]:
        """Components that must have reported; the batch layer first reports after its first run."""
        return tuple(sorted(set(self.component_budgets) - {"batch_layer"}))

    @classmethod
    def from_mapping(cls, values: dict[str, str]) -> Settings:
        """Build settings from text values, e.g. `--set day_seconds=600` of a job."""
        parsed = {}
        defaults = cls()
        known = {f.name for f in fields(cls)}
        for name, text in values.items():
            if name not in known:
                raise ValueError(f"unknown setting {name!r}")
            default = getattr(defaults, name)
            if isinstance(default, tuple):
                parsed[name] = tuple(part.strip() for part in text.split(","))
            else:
                parsed[name] = type(default)(text)
        return cls(**parsed)
