"""Network-flow analytics and threat scoring on Spark DataFrames."""

from wiretide.schemas import DetectionConfig, ExtractionConfig

__all__ = ["DetectionConfig", "ExtractionConfig"]
