"""Operators: each a lazy function from DataFrame to DataFrame."""

from sessionlens.operators import (clean, cohorts, descriptive, features, prediction, quality,
                                   reviews, segmentation, series, temporal)

__all__ = ["clean", "cohorts", "descriptive", "features", "prediction", "quality", "reviews",
           "segmentation", "series", "temporal"]
