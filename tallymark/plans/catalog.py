"""All registered queries."""

from tallymark.plans import (  # noqa: F401
    queries_ingest,
    queries_models,
    queries_profile,
    queries_supervised,
)
from tallymark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
