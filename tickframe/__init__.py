"""tickframe: order-book features, labels, signals, ledger and metrics on Spark."""

from .config import (ExecutionConfig, FeatureConfig, LabelConfig, MetricsConfig, ModelConfig,
                     Ordering, SignalConfig)
from .session import get_session

__all__ = ["ExecutionConfig", "FeatureConfig", "LabelConfig", "MetricsConfig", "ModelConfig",
           "Ordering", "SignalConfig", "get_session"]
