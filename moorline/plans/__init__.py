"""Named query plans.  Importing this package registers every query."""

from . import (q_asof, q_dashboard, q_decisions, q_drift, q_features, q_metrics, q_model,  # noqa: F401
               q_population,
               q_io, q_profiles, q_registry, q_streaming)
from .registry import ORACLE, QUERIES  # noqa: F401
