"""Streaming entry points.

The catalogue jobs have no streaming operators (no windows over event time, no state);
the only streaming piece is an incremental runner that republishes the months touched by
newly arrived item files, on top of the batch plans.
"""

from freshcat.streaming.incremental import run_incremental, touched_months

__all__ = ["run_incremental", "touched_months"]
