"""demandlens: demand analytics (cleaning, features, exploration, forecasting,
scoring) expressed as composable Spark DataFrame transformations."""

from demandlens.config import CleanConfig, FeatureConfig, TrainConfig

__all__ = ["CleanConfig", "FeatureConfig", "TrainConfig"]
