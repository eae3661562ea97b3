"""Importing this module fills the catalog."""

from tallyforge.plans import (  # noqa: F401
    descent_queries,
    describe_queries,
    encode_queries,
    metric_queries,
    model_queries,
    moment_queries,
    neighbour_queries,
    proof_queries,
    stream_queries,
    sweep_queries,
    vector_queries,
)
from tallyforge.plans.registry import CATALOG  # noqa: F401
