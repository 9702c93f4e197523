"""Numeric and geographic expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: earth radius in km.
EARTH_KM = 6378.0


def draw(*keys: Column) -> Column:
    """A scrambled number below 2 ** 60 that depends on the keys alone: the first 15 hex digits of their text's MD5."""
    text = F.concat_ws(" ", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius_km: float = EARTH_KM) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * radius_km * 1000)


def unit_sphere(lon: Column, lat: Column) -> Column:
    """Point on the unit sphere; straight-line distance there grows with great-circle distance."""
    lo, la = F.radians(lon), F.radians(lat)
    return F.array(F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def nerd_score(x: Column, y: Column, z: Column) -> Column:
    return x * F.sqrt(F.lit(42.0) * y * y / (z + 1))


def safe_log(c: Column) -> Column:
    """Natural logarithm with 0 staying 0."""
    return F.when(c == 0, F.lit(0.0)).otherwise(F.log(c))


def interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add the product of every pair of columns as ``a_x_b``."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(cols, 2)})


def powers(df: DataFrame, cols: Sequence[str], power: int) -> DataFrame:
    """Add the powers 2..``power`` of every column as ``a_p2``."""
    return df.withColumns({f"{c}_p{p}": F.pow(F.col(c), F.lit(p)) for c in cols for p in range(2, power + 1)})


def repair_latlon(lat: Column, lon: Column) -> Column:
    """Struct (lat, lon) for a southern city: swapped pairs are put back, then lost signs."""
    swapped = (lat > 100) & (lon < 0)
    a, b = F.when(swapped, lon).otherwise(lat), F.when(swapped, lat).otherwise(lon)
    return F.struct(F.when((a > 30) & (a < 40), -a).otherwise(a).alias("lat"), b.alias("lon"))


def ratio_flag(pred: Column, actual: Column, cut: float = 1.5) -> Column:
    """1 when the prediction is at least ``cut`` times the actual value."""
    return F.when(F.try_divide(pred, actual) >= cut, 1).otherwise(0)


def two_stage(gate: Column, pred: Column) -> Column:
    """Regression kept only behind a positive gate, never below 0."""
    return F.when(gate, F.greatest(pred, F.lit(0.0))).otherwise(F.lit(0.0))
