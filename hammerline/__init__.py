"""Auction listing analytics on Spark: features, regressions, scores, explanations and publishing."""

from hammerline.params import Params

__all__ = ["Params"]
