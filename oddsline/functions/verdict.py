"""From window prices and probabilities to a prediction verdict."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from oddsline.config import Settings
from oddsline.functions.times import as_column

_DEFAULTS = Settings()


def price_movement(open_: Column | str, close: Column | str) -> Column:
    """Relative change; null for a zero open."""
    return F.try_divide(as_column(close) - as_column(open_), as_column(open_))


def actual_direction(movement: Column | str, min_movement: float = _DEFAULTS.min_movement) -> Column:
    """UP/DOWN strictly beyond the minimum movement, otherwise FLAT (also for null)."""
    value = as_column(movement)
    return (F.when(value > F.lit(min_movement), "UP")
            .when(value < F.lit(-min_movement), "DOWN").otherwise("FLAT"))


def predicted_direction(probability: Column | str,
                        threshold: float = _DEFAULTS.prediction_threshold) -> Column:
    """UP above the threshold, DOWN below its complement (in doubles), otherwise UNCERTAIN."""
    value = as_column(probability)
    return (F.when(value > F.lit(threshold), "UP")
            .when(value < F.lit(1 - threshold), "DOWN").otherwise("UNCERTAIN"))


def prediction_result(predicted: Column | str, actual: Column | str) -> Column:
    """CORRECT_/FAILED_ with BULL for a predicted UP and BEAR for DOWN; the rest UNCERTAIN."""
    said, was = as_column(predicted), as_column(actual)
    decided = said.isin("UP", "DOWN") & was.isin("UP", "DOWN")
    outcome = F.when(said == was, "CORRECT").otherwise("FAILED")
    side = F.when(said == "UP", "BULL").otherwise("BEAR")
    return F.when(decided, F.concat_ws("_", outcome, side)).otherwise("UNCERTAIN")
