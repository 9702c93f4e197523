"""Column scalers; all statistics of a call come from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import log

from pyspark.sql import Column, DataFrame, functions as F

METHODS = ("standard", "minmax", "log", "root", "yeojohnson")


def yeo_johnson(c: Column, lam: float) -> Column:
    """The Yeo-Johnson power transform for a fixed lambda."""
    up = F.log1p(c) if abs(lam) < 1e-12 else (F.pow(c + 1, F.lit(lam)) - 1) / lam
    low = 2 - lam
    down = -F.log1p(-c) if abs(low) < 1e-12 else -(F.pow(1 - c, F.lit(low)) - 1) / low
    return F.when(c >= 0, up).otherwise(down)


def yeo_johnson_lambdas(df: DataFrame, cols: Sequence[str], grid: Sequence[float]) -> dict[str, float]:
    """The lambda of the highest log-likelihood on the grid, for all columns in one pass."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        parts.append(F.struct(F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("j"),
                              F.array(*[F.var_pop(yeo_johnson(x, lam)) for lam in grid]).alias("v")).alias(c))
    row = df.agg(*parts).first()
    best = {}
    for c in cols:
        s = row[c]
        gain = [(-s["n"] / 2 * log(v) + (lam - 1) * s["j"]) if v and v > 0 else float("-inf")
                for lam, v in zip(grid, s["v"])]
        best[c] = grid[max(range(len(grid)), key=gain.__getitem__)]
    return best


def scale(df: DataFrame, methods: Mapping[str, str], ddof: int = 1,
          grid: Sequence[float] = tuple(i / 10 for i in range(-20, 21))) -> DataFrame:
    """Replace each column by its scaled form: standard, minmax, log (0 stays 0), root, or standardised Yeo-Johnson."""
    power = [c for c, m in methods.items() if m == "yeojohnson"]
    lambdas = yeo_johnson_lambdas(df, power, grid) if power else {}
    shaped = {c: yeo_johnson(F.col(c).cast("double"), lambdas[c]) if c in lambdas else F.col(c).cast("double")
              for c in methods}
    dev = F.stddev_samp if ddof == 1 else F.stddev_pop
    stats = df.agg(*[F.struct(F.avg(x).alias("mean"), dev(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi")).alias(c)
                     for c, x in shaped.items()]).select(F.struct("*")).scalar()
    out = {}
    for c, method in methods.items():
        x, s = shaped[c], stats[c]
        if method in ("standard", "yeojohnson"):
            out[c] = F.try_divide(x - s["mean"], s["sd"])
        elif method == "minmax":
            out[c] = F.try_divide(x - s["lo"], s["hi"] - s["lo"])
        elif method == "log":
            out[c] = F.when(x == 0, 0.0).otherwise(F.log(x))
        elif method == "root":
            out[c] = F.sqrt(x)
        else:
            raise ValueError(f"unknown method {method}")
    return df.withColumns(out)
