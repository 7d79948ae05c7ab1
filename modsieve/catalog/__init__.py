"""The catalogue of registered queries."""

from modsieve.catalog import (  # noqa: F401  (registration)
    augmenting,
    drifting,
    folding,
    mining,
    modelling,
    profiling,
    prompting,
    reshaping,
    scoring,
    storage,
    validation,
)
from modsieve.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
