"""Query catalogue: Spark plans with their SQL twins."""

from . import catalog_backtest, catalog_chunked, catalog_eval, catalog_features, catalog_models, catalog_training  # noqa: F401
from .registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
