"""Event-to-market analytics on Spark DataFrames."""

from straitflow.config import Box, FeatureSettings

__all__ = ["Box", "FeatureSettings"]
