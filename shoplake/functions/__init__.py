from shoplake.functions.ratios import growth_pct, mean, pct, ratio
from shoplake.functions.times import day_of, day_text, epoch_ms

__all__ = ["day_of", "day_text", "epoch_ms", "growth_pct", "mean", "pct", "ratio"]
