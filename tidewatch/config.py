"""Settings and fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Control actions as spelled on the wire.
ACTION_DELETE_SERIES = "deletemetricbyhash"
ACTION_RESET_REGRESSION = "resetregresion"
ACTION_UPDATE_LEVELS = "updatelevels"

# Reaction codes with a meaning of their own.
REACTION_DOWN_ONLY = -1
REACTION_UP_ONLY = -2
REACTION_MUTED = -3
REACTION_LATE = -4
REACTION_CHECKS_OFF = -5

# Levels and state codes of an alert.
NO_LEVEL = -1
SEVERE_LEVEL = 5
STATE_START = 0
STATE_SAME = 1
STATE_CHANGE = 2
STATE_END = 3

# Level reached by a special point with this status.
STATUS_LEVELS = {"OK": -1, "WARNING": 3, "ERROR": 5}

FIXED_THRESHOLD_WEIGHT = 16
HEARTBEAT_NAME = "host_alive"
ABSENCE_NAME = "host_absent"
MAIN_TOPIC = "errors"

# Different levels over all rules in use; more are refused openly.
MAX_LEVELS = 10_000


@dataclass(frozen=True)
class LevelRule:
    """Thresholds a point has to meet to reach ``level``."""

    level: int
    min_weight: float
    min_pct: float
    min_value: float
    min_predict_pct: float
    rec_count: int


DEFAULT_LEVELS = (
    LevelRule(0, 2.0, 5.0, 0.0, 0.0, 3),
    LevelRule(1, 4.0, 10.0, 0.0, 0.0, 3),
    LevelRule(2, 8.0, 20.0, 0.0, 0.0, 3),
    LevelRule(3, 12.0, 30.0, 0.0, 0.0, 2),
    LevelRule(4, 14.0, 50.0, 0.0, 0.0, 2),
    LevelRule(5, 16.0, 70.0, 0.0, 0.0, 1),
)


@dataclass(frozen=True)
class Settings:
    """Parameters of a monitoring run; the defaults are the production values."""

    baseline_days: int = 7
    deviation_factor: float = 1.0
    window_samples: int = 15
    tick_ms: int = 60_000
    absence_limit_ms: int = 180_000
    heartbeat_name: str = ABSENCE_NAME
    main_topic: str = MAIN_TOPIC
    checks_enabled: bool = True
    default_levels: tuple[LevelRule, ...] = DEFAULT_LEVELS
    status_levels: dict[str, int] = field(default_factory=lambda: dict(STATUS_LEVELS))


DEFAULTS = Settings()
