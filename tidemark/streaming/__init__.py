"""Structured Streaming jobs."""

from .inferring import read_inferred, run_inferring_ingest
from .ingest import run_ingest, run_split_ingest
from .state import run_state_stream

__all__ = ["read_inferred", "run_inferring_ingest", "run_ingest", "run_split_ingest", "run_state_stream"]
