"""Fixed values and the settings object shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. Results depend on them, so they are stated as plain text.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Box:
    """A latitude/longitude rectangle, both ends inclusive."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


CHOKEPOINT_BOXES = (
    Box("hormuz", 25.06, 28.06, 54.75, 57.75),
    Box("suez", 29.46, 31.46, 31.34, 33.34),
    Box("red_sea", 11.00, 17.00, 40.00, 46.00),
    Box("black_sea", 41.60, 47.60, 30.50, 36.50),
    Box("malacca", 0.50, 4.50, 99.50, 103.50),
    Box("panama", 8.58, 9.58, -80.18, -79.18),
    Box("taiwan", 23.00, 26.00, 118.00, 121.00),
    Box("chile", -26.50, -20.50, -72.50, -66.50),
)

OIL_BOXES = ("hormuz", "suez", "red_sea")

# CAMEO root codes: protest, coerce, assault, fight, mass violence.
SUPPLY_CHAIN_ROOTS = ("14", "17", "18", "19", "20")
CONFLICT_ROOTS = ("18", "19", "20")

DEDUP_KEYS = ("SOURCEURL", "SQLDATE", "Actor1Code", "Actor2Code")

# Decides which of several copies survives; a total order over distinct rows.
DEDUP_ORDER = (
    "GLOBALEVENTID",
    "EventRootCode",
    "AvgTone",
    "GoldsteinScale",
    "ActionGeo_Lat",
    "ActionGeo_Long",
    "NumMentions",
)

PANEL_METRICS = (
    "event_count",
    "avg_goldstein",
    "avg_tone",
    "total_mentions",
    "conflict_ratio",
)

MODEL_INPUTS = (
    "event_count_7d",
    "avg_goldstein_7d",
    "avg_tone_7d",
    "total_mentions_7d",
    "conflict_ratio_7d",
    "event_count_30d",
    "avg_goldstein_30d",
    "avg_tone_30d",
    "total_mentions_30d",
    "conflict_ratio_30d",
    "return_5d",
    "return_20d",
    "volatility_20d",
    "treasury_10y",
    "usd_index",
)

MACRO_SERIES = ("treasury_10y", "usd_index")


# ---------------------------------------------------------------------------
# Settings
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSettings:
    """Everything the feature table depends on besides its inputs."""

    boxes: tuple[Box, ...] = CHOKEPOINT_BOXES
    scope: tuple[str, ...] | None = OIL_BOXES
    roots: tuple[str, ...] = SUPPLY_CHAIN_ROOTS
    conflict_roots: tuple[str, ...] = CONFLICT_ROOTS
    commodity: str = "crude_oil"
    windows: tuple[int, ...] = (7, 30)
    window_mode: str = "rows"
    quantiles: tuple[float, float] = (0.33, 0.66)
    macro_series: tuple[str, ...] = MACRO_SERIES
    carry_in: bool = False
    dedup_after_filter: bool = False
    prune_keys: bool = True

    def scoped_boxes(self) -> tuple[Box, ...]:
        """Boxes that reach the result; choosing them before tagging spares the rest."""
        if self.scope is None:
            return self.boxes
        return tuple(b for b in self.boxes if b.name in self.scope)
