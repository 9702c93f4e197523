"""Rule-based repair, imputation and change audits over dirty tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .aggregates import iqr_bounds
from .joins import attach_groups
from .ordering import index_within


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], sentinel: str = "NA",
           digits: int = 1) -> DataFrame:
    """Sentinels and NULLs become the rounded column mean, or the most frequent value (smallest on ties).

    All means come from one aggregation and all modes from another over the value
    counts; both are single rows attached as scalar subqueries.
    """
    def present(c):
        return F.nullif(F.col(c).cast("string"), F.lit(sentinel))

    means = df.agg(*[F.round(F.avg(present(c).try_cast("double")), digits).alias(c) for c in numeric])
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), present(c).alias("v")) for c in categorical])).alias("e")).select("e.*")
    counts = values.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("neg"), "v")).alias("b"))
    modes = best.agg(*[F.max(F.when(F.col("c") == c, F.col("b.v"))).alias(c) for c in categorical])
    mean_row, mode_row = means.select(F.struct("*")).scalar(), modes.select(F.struct("*")).scalar()
    fixed = {c: F.coalesce(present(c).try_cast("double"), mean_row[c]) for c in numeric}
    fixed.update({c: F.coalesce(present(c), mode_row[c]) for c in categorical})
    return df.withColumns(fixed)


def repair(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Fold ordered repair steps over a table; Catalyst sees them as one plan."""
    return reduce(lambda d, step: d.transform(step), steps, df)


def audit(raw: DataFrame, fixed: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """How many rows each column changed on, in one pass over the joined versions.

    Keys and values compare NULL-safe. A row that only one version has counts as a change of every column.
    """
    old = raw.select(*[F.col(c).alias(f"_key_{c}") for c in key],
                     F.struct(*[F.col(c).alias(c) for c in cols]).alias("_old"))
    new = fixed.select(*key, F.struct(*[F.col(c).alias(c) for c in cols]).alias("_new"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key])
    both = new.join(old, same, "full")
    alone = F.col("_old").isNull() | F.col("_new").isNull()
    wide = both.agg(*[F.count_if(alone | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_changed")) for c in cols])
    return wide.select(F.explode(rows).alias("e")).select("e.*")


def audit_columns(df: DataFrame, triples: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Change counts when both versions are on the same row: ``(name, old column, new column)``."""
    wide = df.agg(*[F.count_if(~F.col(old).eqNullSafe(F.col(new))).alias(name) for name, old, new in triples])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_changed")) for n, _, _ in triples])
    return wide.select(F.explode(rows).alias("e")).select("e.*")


def repair_code(df: DataFrame, id_col: str, code: str, prefix_map: Mapping[str, str], prefix_length: int = 4) -> DataFrame:
    """The code that the prefix of the id stands for; for unknown prefixes the given code in upper case, if known."""
    known = list(dict.fromkeys(prefix_map.values()))
    lookup = F.create_map(*[F.lit(x) for kv in prefix_map.items() for x in kv])
    upper = F.upper(code)
    derived = F.try_element_at(lookup, F.substring(id_col, 1, prefix_length))
    return df.withColumn(code, F.coalesce(derived, F.when(upper.isin(*known), upper)))


# ---- items and prices -------------------------------------------------------------------------

def infer_unit_prices(df: DataFrame, group: str, quantities: Sequence[str], total: str, digits: int = 2) -> DataFrame:
    """Unit prices per group from (quantities, total) rows, as rows (group, item, price).

    Only the normal-equation sums are aggregated, so each group reaches the solver
    as one row of k*k + k numbers; items a group never orders get no price.
    """
    return _solved_prices(df, [group], quantities, total, digits)


def infer_modal_prices(df: DataFrame, group: str, quantities: Sequence[str], total: str, order: Sequence[str],
                       block_rows: int = 8, digits: int = 2) -> DataFrame:
    """Unit prices per group when some totals are wrong, as rows (group, item, price).

    In the given order, a group is cut into blocks of ``block_rows`` rows, each block that determines its prices is
    solved, and the most frequent solution of an item is its price (the smallest on ties).
    """
    needed = df.select(*dict.fromkeys([group, *quantities, total, *order])).dropna(subset=[*quantities, total])
    placed = index_within(needed, [group], order, name="_pos")
    blocks = placed.withColumn("_block", F.floor(F.col("_pos") / block_rows))
    solved = _solved_prices(blocks, [group, "_block"], quantities, total, digits, determined=True)
    votes = solved.groupBy(group, "item", "price").agg(F.count("*").alias("n"))
    best = votes.groupBy(group, "item").agg(F.min(F.struct((-F.col("n")).alias("votes"), "price")).alias("b"))
    return best.select(group, "item", F.col("b.price").alias("price"))


def _solved_prices(df: DataFrame, by: Sequence[str], quantities: Sequence[str], total: str, digits: int,
                   determined: bool = False) -> DataFrame:
    """Least-squares prices per group; with ``determined`` only of groups whose rows leave no choice."""
    k = len(quantities)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = df.groupBy(*by).agg(
        F.array(*[F.sum(F.col(quantities[i]).cast("double") * F.col(quantities[j])) for i, j in pairs]).alias("qq"),
        F.array(*[F.sum(F.col(q).cast("double") * F.col(total)) for q in quantities]).alias("qt"))

    def solve(batches):
        for pdf in batches:
            prices = []
            for qq, qt in zip(pdf["qq"], pdf["qt"]):
                a = np.zeros((k, k))
                for (i, j), v in zip(pairs, qq):
                    a[i, j] = a[j, i] = v
                used = np.flatnonzero(np.diag(a) > 0)
                x = np.full(k, np.nan)
                if len(used):
                    found, _, rank, _ = np.linalg.lstsq(a[np.ix_(used, used)], np.asarray(qt)[used], rcond=None)
                    if rank == len(used) or not determined:
                        x[used] = found
                prices.append([None if np.isnan(v) else float(v) for v in x])
            yield pd.DataFrame({**{b: pdf[b] for b in by}, "prices": prices})

    kinds = ", ".join(f"{b} {sums.schema[b].dataType.simpleString()}" for b in by)
    solved = sums.mapInPandas(solve, f"{kinds}, prices array<double>")
    names = F.array(*[F.lit(q) for q in quantities])
    return (solved.select(*by, F.explode(F.arrays_zip(names.alias("item"), F.col("prices").alias("price"))).alias("e"))
            .select(*by, F.col("e.item").alias("item"), F.round("e.price", digits).alias("price"))
            .where(F.col("price").isNotNull()))


def _with_menu(df: DataFrame, prices: DataFrame, group: str | None) -> DataFrame:
    """Each row with the menu of its group as two maps: ``_menu`` from dish to price, ``_dishes`` back to the first dish.

    A menu is one row; how all of them travel depends on the number of prices, see ``attach_groups``.
    """
    by = [group] if group else []
    slim = prices.select(*by, "item", F.col("price").cast("decimal(12,2)").alias("price")).dropna(subset=["item", "price"])
    of_item = slim.groupBy(*by, "item").agg(F.min("price").alias("price"))
    of_price = slim.groupBy(*by, "price").agg(F.min("item").alias("item"))
    entries = lambda d, k, v: d.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(k, v))).alias("_m"))
    menus = entries(of_item, "item", "price").withColumnRenamed("_m", "_menu")
    back = entries(of_price, "price", "item").withColumnRenamed("_m", "_dishes")
    if not group:
        return df.withColumns({"_menu": menus.scalar(), "_dishes": back.scalar()})
    return attach_groups(df, attach_groups(menus, back, by), by, size=prices.count())


def _paid(items: str) -> Column:
    """What the items on the menu cost, in decimals."""
    zero = F.lit(0).cast("decimal(20,2)")
    cost = lambda e: F.coalesce(F.try_element_at("_menu", e["item"]) * e["qty"], zero)
    return F.aggregate(items, zero, lambda sum_, e: (sum_ + cost(e)).cast("decimal(20,2)"))


def _unknown(items: str) -> Column:
    return F.filter(items, lambda e: F.try_element_at("_menu", e["item"]).isNull())


def recompute_total(df: DataFrame, key: Sequence[str], items: str, prices: DataFrame, name: str = "total",
                    group: str | None = None) -> DataFrame:
    """``sum(price * qty)`` over the nested items in decimals; NULL without items or when one has no price.

    ``prices`` is (item, price), or (group, item, price) with the menu of every group of rows, as
    ``infer_unit_prices`` returns it. Rows are priced where they are; ``key`` may repeat.
    """
    whole = (F.size(items) > 0) & (F.size(_unknown(items)) == 0)
    return _with_menu(df.drop(name), prices, group).withColumn(name, F.when(whole, _paid(items))).drop("_menu", "_dishes")


def repair_items(df: DataFrame, key: Sequence[str], items: str, total: str, prices: DataFrame,
                 group: str | None = None) -> DataFrame:
    """Replace the one item that is not on the menu by the dish whose price closes the gap to the total.

    With ``group``, ``prices`` has a menu for every group of rows, and a dish of another group's menu is as wrong
    as an unknown one. Rows without exactly one such item, or without a dish of exactly that price,
    keep their items. Of dishes with equal prices the first by name is taken. ``key`` may repeat.
    """
    wrong = _unknown(items)
    gap = F.col(total).cast("decimal(20,2)") - _paid(items)
    qty = F.get(wrong, 0)["qty"]
    unit = F.round(F.try_divide(gap, qty), 2).cast("decimal(12,2)")
    dish = F.when((F.size(wrong) == 1) & (unit * qty == gap), F.try_element_at("_dishes", unit))
    found = _with_menu(df, prices, group).withColumn("_dish", dish)
    swapped = F.transform(items, lambda e: F.struct(
        F.when(F.try_element_at("_menu", e["item"]).isNull(), F.col("_dish")).otherwise(e["item"]).alias("item"), e["qty"].alias("qty")))
    return found.withColumn(items, F.when(F.col("_dish").isNotNull(), swapped).otherwise(F.col(items))) \
        .drop("_menu", "_dishes", "_dish")


# ---- linear models and outliers ----------------------------------------------------------------

def group_linear_fit(df: DataFrame, by: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Least squares per group, as (by, n, coefs array, intercept).

    One aggregation of means and centred co-moments over the rows that have all features and the target; a
    hot group is reduced map-side and the solver sees one row per group. NULL is a group.
    """
    k, by = len(features), list(by)
    df = df.dropna(subset=[*features, target])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = df.groupBy(*by).agg(
        F.count(target).alias("n"), F.avg(target).alias("my"),
        F.array(*[F.avg(f) for f in features]).alias("mx"),
        F.array(*[F.covar_pop(features[i], features[j]) for i, j in pairs]).alias("sxx"),
        F.array(*[F.covar_pop(f, target) for f in features]).alias("sxy"))

    def solve(batches):
        for pdf in batches:
            coefs, inter = [], []
            for mx, my, sxx, sxy in zip(pdf["mx"], pdf["my"], pdf["sxx"], pdf["sxy"]):
                a = np.zeros((k, k))
                for (i, j), v in zip(pairs, sxx):
                    a[i, j] = a[j, i] = v
                c = np.linalg.lstsq(a, np.asarray(sxy, dtype=float), rcond=None)[0]
                coefs.append([float(v) for v in c])
                inter.append(float(my - np.dot(c, np.asarray(mx, dtype=float))))
            yield pd.DataFrame({**{b: pdf[b] for b in by}, "n": pdf["n"], "coefs": coefs, "intercept": inter})

    keys = ", ".join(f"{b} {moments.schema[b].dataType.simpleString()}" for b in by)
    return moments.mapInPandas(solve, f"{keys}, n bigint, coefs array<double>, intercept double")


def predict_linear(df: DataFrame, model: DataFrame, by: Sequence[str], features: Sequence[str], name: str = "pred") -> DataFrame:
    """Attach each group's prediction; rows of a group without a model, or with a missing feature, get NULL."""
    pred = F.col("intercept")
    for i, f in enumerate(features):
        pred = pred + F.col("coefs")[i] * F.col(f)
    return attach_groups(df, model.drop("n"), by).withColumn(name, pred).drop("coefs", "intercept")


def mark_outliers(df: DataFrame, residual: str, by: Sequence[str], t: float = 3.0, name: str = "is_outlier") -> DataFrame:
    """Flag residuals outside the IQR fences of their group; the fences are taken with the outliers in.

    A NULL residual has a NULL flag.
    """
    bounds = iqr_bounds(df, residual, by, t).select(*by, "lower", "upper")
    inside = F.col(residual).between(F.col("lower"), F.col("upper"))
    return attach_groups(df, bounds, by).withColumn(name, (~inside).cast("int")).drop("lower", "upper")


def drop_outliers(df: DataFrame, residual: str, by: Sequence[str], t: float = 3.0) -> DataFrame:
    """Rows whose residual is no outlier; those without a residual stay."""
    return mark_outliers(df, residual, by, t, "_out").where("coalesce(_out, 0) = 0").drop("_out")


def impute_by_rule(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Fill missing values column by column, in order; a later rule sees the earlier repairs."""
    for name, rule in rules.items():
        df = df.withColumn(name, F.coalesce(F.col(name), rule))
    return df
