"""All registered queries; importing the modules fills the registry."""

from tidemark.plans.catalog import cleaning, evaluation, features, modelling, small_forecaster  # noqa: F401
from tidemark.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
