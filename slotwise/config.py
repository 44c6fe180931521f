"""Settings shared by every job, and the fixed values that define the results."""

from __future__ import annotations

from dataclasses import dataclass

# They define the results and are not tuning knobs.
PLAUSIBLE_CAP = 20.0
SHORT_GAP_LIMIT = 2
WEATHER_GAP_LIMIT = 3
ASOF_TOLERANCE_MINUTES = 60
HEATING_BASE_C = 18.0
COOLING_BASE_C = 22.0
MAPE_FLOOR = 1e-3
VALIDATION_SHARE = 0.15
TEST_SHARE = 0.15
MAX_CRITICAL = 0
MAX_WARNING = 3
MAX_AGE_DAYS = 30
MAX_MAE_LOSS_PCT = 15
PEAK_FIRST_HOUR = 17
PEAK_LAST_HOUR = 20
HIGH_LOAD_KWH = 0.85
PEAK_SAVING_SHARE = 0.15
COLD_DEGREES = 8.0
COLD_SAVING_PER_DEGREE = 0.05
ABOVE_MEAN_FACTOR = 1.5
RECENT_BUFFER_ROWS = 400
RECENT_MEAN_ROWS = 48
HORIZON_HOURS = (1, 48)
REFERENCE_SAMPLE_ROWS = 500
ATTRIBUTION_SAMPLE_ROWS = 300
BACKGROUND_ROWS = 100
TOP_CONTRIBUTIONS = 8
TOP_FEATURES = 10
MIN_PLOT_ROWS = 2
MIN_FORECAST_ROWS = 5
MIN_DRIFT_ROWS = 30
MONITORED_BATCH = (
    "temperature_c", "heating_degree", "lag_1", "lag_48", "roll_mean_48", "roll_std_48",
)
MONITORED_ONLINE = (
    "consumption_kwh", "temperature_c", "heating_degree", "lag_1", "lag_48",
)
NOT_FEATURES = (
    "household_id", "timestamp", "consumption_kwh", "is_winsorised", "was_missing",
    "is_real_data", "is_real_meter_data",
)


@dataclass(frozen=True)
class SeriesConfig:
    """Column roles, grid step and look-backs of one panel of series."""

    entity: str = "household_id"
    time: str = "timestamp"
    value: str = "consumption_kwh"
    freq_minutes: int = 30
    lag_steps: tuple[int, ...] = (1, 2, 48, 336)
    rolling_windows: tuple[int, ...] = (48, 336)
    seed: int = 42
    real_entity_id: str = "HH_REAL_000"
    # Slots per window block. A window task never sorts more than this many rows of an
    # entity plus the look-back copied from its neighbour.
    block_slots: int = 4096

    @property
    def step_us(self) -> int:
        return self.freq_minutes * 60_000_000

    @property
    def look_back(self) -> int:
        return max((*self.lag_steps, *(w for w in self.rolling_windows), 0))

    @property
    def purge(self) -> int:
        return max(self.lag_steps, default=0)


DEFAULT = SeriesConfig()
