"""All registered queries."""

from oddsline.plans import (queries_sources, queries_windows, queries_views,  # noqa: F401
                            queries_sinks, queries_streams)
from oddsline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
