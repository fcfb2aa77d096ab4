"""Fixed values of the event rules and the run-time knobs around them."""

from __future__ import annotations

from dataclasses import dataclass

# The decision rules only give the right answers with exactly these.
REACH_INTERCEPT = -0.414
REACH_WEIGHTS = (-0.815, 0.407)  # distance bin, ln(seconds in bin + 1)
DEPART_INTERCEPT = -5.234
DEPART_WEIGHTS = (0.557, 0.047, 1.165)  # speed to place, speed along the trace, ln(metres)
MIN_POINTS = 3
BIN_BASE_METRES = 50
BIN_STEPS = (1, 2, 3, 5, 8, 13, 21)
MAX_DEPART_METRES = 150
MAX_CLIENT_METRES = 150
CLIENT_HOLD_SECONDS = 90
DEFAULT_ZONE = "Europe/Istanbul"
FINISHED_STATUSES = (900, 1000)
EARTH_RADIUS_KM = 6371.0

# Business lines.
MARKET, FOOD, MARKET_ALT, WATER, ARTISAN = 1, 2, 3, 4, 6
MARKET_DOMAINS = (1, 3)
MERCHANT_DOMAINS = (2, 6)
DOMAIN_TYPES = (1, 2, 4, 6)


@dataclass(frozen=True)
class EventParams:
    """Everything an event rule can be tuned with.

    ``slice_seconds`` is the time slice a long trace or a busy courier is cut
    into before windows run over it (see ``operators.slices``): no task ever
    holds more of one key than one slice of it. ``parallel_jobs`` is how many
    independent events of a run are computed side by side.
    """

    reach_intercept: float = REACH_INTERCEPT
    reach_weights: tuple[float, ...] = REACH_WEIGHTS
    depart_intercept: float = DEPART_INTERCEPT
    depart_weights: tuple[float, ...] = DEPART_WEIGHTS
    client_intercept: float = DEPART_INTERCEPT
    client_weights: tuple[float, ...] = DEPART_WEIGHTS
    min_points: int = MIN_POINTS
    bin_base: int = BIN_BASE_METRES
    bin_steps: tuple[int, ...] = BIN_STEPS
    max_depart_metres: float = MAX_DEPART_METRES
    max_client_metres: float = MAX_CLIENT_METRES
    client_hold_seconds: int = CLIENT_HOLD_SECONDS
    slice_seconds: int = 600
    slice_rows: int | None = 200_000
    parallel_jobs: int = 4


@dataclass(frozen=True)
class RfmParams:
    """Parameters of the customer segmentation."""

    check_date: str
    statuses: tuple = FINISHED_STATUSES
    max_churn_recency: int = 365
    max_f_recency: int = 180
    first_n: int = 5
    last_n: int = 10
    store_last_n: int = 5
