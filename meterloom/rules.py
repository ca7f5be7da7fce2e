"""Rules as data. Operators turn these into native Column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

# Sensor categories, in report order. The last one marks a rejected entity.
CATEGORIES = (
    "energy",
    "power",
    "temperature",
    "percentage",
    "electrical",
    "network",
    "pressure",
    "special",
)
EXCLUDED = "excluded"

# Unit -> category.
UNIT_CATEGORY = {
    "kWh": "energy",
    "W": "power",
    "°C": "temperature",
    "°F": "temperature",
    "%": "percentage",
    "A": "electrical",
    "V": "electrical",
    "kB/s": "network",
    "MB/s": "network",
    "GB": "network",
    "MB": "network",
    "hPa": "pressure",
    "bar": "pressure",
    "mbar": "pressure",
}

# Category -> (aggregation method, window).
CATEGORY_AGGREGATION = {
    "energy": ("last", "1h"),
    "power": ("mean", "1h"),
    "temperature": ("mean", "1h"),
    "percentage": ("mean", "1h"),
    "electrical": ("mean", "1h"),
    "network": ("mean", "1h"),
    "pressure": ("mean", "1h"),
    "special": ("last", "1h"),
}


@dataclass(frozen=True)
class EntityRules:
    """Which entities are exported and under which category."""

    # Defaults of the entity filter.
    include_units: tuple[str, ...] = (
        "kWh", "W", "°C", "°F", "%", "kB/s", "GB", "MB", "A", "V",
        "hPa", "bar", "mbar", "lux", "ppm", "dB", "rpm",
    )
    special_sources: tuple[str, ...] = ("tibber",)
    exclude_patterns: tuple[str, ...] = ("%availability%", "%status%", "%signal%", "%connected%")
    include_domains: tuple[str, ...] = ("sensor", "counter", "weather", "climate", "utility_meter")
    status_words: tuple[str, ...] = (
        "availability", "status", "connected", "online", "signal", "rssi",
    )

    def __post_init__(self):
        # A pattern without text is a substring of every id and would drop everything.
        if any(not p.replace("%", "") for p in self.exclude_patterns):
            raise ValueError("exclude_patterns must not contain an empty pattern")


@dataclass(frozen=True)
class QualityRules:
    """Limits by unit and category; every limit value itself is still valid."""

    # Unit -> (lowest, highest); None means unbounded.
    unit_range: dict[str, tuple[float | None, float | None]] = field(
        default_factory=lambda: {
            "°C": (-50.0, 80.0),
            "W": (0.0, 50000.0),
            "kWh": (0.0, None),
            "%": (0.0, 100.0),
            "V": (0.0, 500.0),
            "A": (0.0, 1000.0),
            "kB/s": (0.0, 1000000.0),
            "MB/s": (0.0, 1000.0),
            "GB": (0.0, 10000.0),
            "MB": (0.0, 10000000.0),
            "hPa": (800.0, 1200.0),
            "bar": (0.8, 1.2),
        }
    )
    # Category -> (lowest, highest, issue below, issue above).
    category_range: dict[str, tuple[float, float, str, str]] = field(
        default_factory=lambda: {
            "energy": (0.0, 1000000.0, "energy_negative", "energy_high"),
            "power": (-100000.0, 100000.0, "power_high", "power_high"),
            "percentage": (-5.0, 105.0, "percentage_range", "percentage_range"),
            "temperature": (-100.0, 200.0, "temperature_range", "temperature_range"),
        }
    )
    # Fixed values: (category, unit or None for any unit) -> repair floor and ceiling.
    repair: dict[tuple[str, str | None], tuple[float | None, float | None]] = field(
        default_factory=lambda: {
            ("percentage", "%"): (0.0, 100.0),
            ("energy", None): (0.0, None),
        }
    )
    # Error sentinels and the valid time range, both ends inclusive.
    sentinel_low: float = -999999.0
    sentinel_high: float = 999999.0
    earliest: str = "2020-01-01 00:00:00"
    latest: str = "2030-01-01 00:00:00"


# Issue code -> (report category, message). The message slots are filled by
# functions.quality.issue_message.
ISSUES = {
    "nan": ("NaN values", "Value is NaN"),
    "infinite": ("Infinite values", "Value is infinite"),
    "sentinel_low": ("Error sentinel values", "Value appears to be error sentinel (-999999)"),
    "sentinel_high": ("Error sentinel values", "Value appears to be error sentinel (999999)"),
    "below_minimum": ("Out of range values", "Value {value} below minimum {limit} for unit {unit}"),
    "above_maximum": ("Out of range values", "Value {value} above maximum {limit} for unit {unit}"),
    "energy_negative": ("Negative values (invalid for type)", "Energy value cannot be negative"),
    "energy_high": ("Other validation issues", "Energy value seems unrealistically high"),
    "power_high": ("Other validation issues", "Power value seems unrealistically high"),
    "percentage_range": ("Other validation issues", "Percentage value outside reasonable range"),
    "temperature_range": (
        "Other validation issues",
        "Temperature value outside physically reasonable range",
    ),
}


@dataclass(frozen=True)
class ScanRules:
    """The raw-issue scan, which has limits of its own."""

    # Unit -> (issue type, lowest, highest).
    unit_checks: dict[str, tuple[str, float, float | None]] = field(
        default_factory=lambda: {
            "%": ("Percentage", 0.0, 100.0),
            "°C": ("Temperature", -50.0, 80.0),
            "kWh": ("Negative", 0.0, None),
        }
    )
    unusual_above: float = 10000.0
    unusual_exempt_units: tuple[str, ...] = ("kWh", "GB", "MB")


@dataclass(frozen=True)
class RollupRules:
    """Hourly rollup: measurement -> method; the counter domain and unit-less data differ."""

    # Measurements by method.
    last: tuple[str, ...] = ("kWh", "Wh", "GB", "MB")
    mean: tuple[str, ...] = (
        "W", "kW", "°C", "°F", "hPa", "bar", "mbar", "%", "A", "V", "mA", "mV",
        "lux", "ppm", "dB", "rpm", "kB/s", "MB/s",
    )
    max_domains: tuple[str, ...] = ("counter",)
    fallback_pattern: str = "_data$"
    window: str = "1 hour"


@dataclass(frozen=True)
class Lifecycle:
    """Ages, in days, at which points are rolled up and dropped."""

    rollup_from_days: int = 31
    rollup_until_days: int = 30
    recent_retention_days: int = 90
    historical_retention_days: int = 0


# Fixed value: bytes assumed per stored point in size estimates.
BYTES_PER_POINT = 150

# Fixed value: tag written on every exported point.
MIGRATION_SOURCE = "migration"
