"""Prediction-market odds against exchange prices, as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame, so the same code runs
on batch tables and on streams.  ``plans`` holds the jobs and the registered
queries built from them.
"""

from oddsline.config import Settings

__all__ = ["Settings"]
