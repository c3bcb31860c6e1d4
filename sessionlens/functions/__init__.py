from sessionlens.functions.money import money_avg, money_avg_raw, money_sum, percent, safe_ratio
from sessionlens.functions.quantiles import iqr_bounds, quantiles
from sessionlens.functions.text import tokens

__all__ = ["money_avg", "money_avg_raw", "money_sum", "percent", "safe_ratio",
           "iqr_bounds", "quantiles", "tokens"]
