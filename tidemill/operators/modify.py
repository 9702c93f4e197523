"""Table modification as new versions, constraint reports, and snapshot differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def update_rows(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE`` as a new version; rows where the predicate is NULL stay."""
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_cascade(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                   doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the doomed parent keys (one column) from the child first, then from the parent."""
    keys = doomed.toDF("_doomed").distinct()
    return (child.join(keys, F.col(child_key) == F.col("_doomed"), "left_anti"),
            parent.join(keys, F.col(parent_key) == F.col("_doomed"), "left_anti"))


def bridge_table(df: DataFrame, key: str, member: str, role: int, extra: DataFrame | None = None) -> DataFrame:
    """Split a member column out into (key, member, role_no) rows, NULL members left out."""
    rows = df.where(F.col(member).isNotNull()).select(key, member, F.lit(role).alias("role_no"))
    return rows if extra is None else rows.unionByName(extra)


def constraint_report(df: DataFrame, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = (),
                      checks: Mapping[str, Column] | None = None,
                      foreign: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """Violation counts per declared constraint, as rows (constraint_name, n_violations).

    All NOT NULL and CHECK rules share one pass; a CHECK on NULL is not a violation.
    UNIQUE counts the keys that occur more than once, FOREIGN KEY the orphaned rows.
    """
    checks = checks or {}
    rules = {f"not_null({c})": F.count_if(F.col(c).isNull()) for c in not_null}
    rules.update({f"check({n})": F.count_if(~c) for n, c in checks.items()})
    parts = []
    if rules:
        wide = df.agg(*[agg.alias(f"r{i}") for i, agg in enumerate(rules.values())])
        rows = F.array(*[F.struct(F.lit(n).alias("constraint_name"), F.col(f"r{i}").alias("n_violations"))
                         for i, n in enumerate(rules)])
        parts.append(wide.select(F.explode(rows).alias("e")).select("e.*"))
    for cols in unique:
        repeated = df.groupBy(*cols).agg(F.count("*").alias("_n")).where("_n > 1")
        parts.append(repeated.agg(F.lit(f"unique({', '.join(cols)})").alias("constraint_name"),
                                  F.count("*").alias("n_violations")))
    for col, ref, ref_col in foreign:
        keys = ref.select(F.col(ref_col).alias("_ref")).distinct()
        uses = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
        orphans = uses.join(keys, F.col(col) == F.col("_ref"), "left_anti")
        parts.append(orphans.agg(F.lit(f"foreign({col})").alias("constraint_name"),
                                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_violations")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def reject_rows(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected) rows; a NULL verdict accepts."""
    verdict = F.coalesce(bad, F.lit(False))
    return df.where(~verdict), df.where(verdict)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Changed values between two versions as (key, column_name, old_value, new_value) text rows.

    Inserted and deleted keys appear with all columns, NULL on the missing side. Keys compare NULL-safe.
    """
    pack = lambda df, alias: df.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in cols]).alias(alias))
    before, after = pack(old, "o").withColumnRenamed(key, "_key"), pack(new, "n")
    both = (before.join(after, F.col("_key").eqNullSafe(F.col(key)), "full")
            .select(F.coalesce(key, "_key").alias(key), "o", "n", (F.col("o").isNull() | F.col("n").isNull()).alias("_alone")))
    changes = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"o.{c}").alias("old_value"),
                                 F.col(f"n.{c}").alias("new_value")) for c in cols])
    return (both.select(key, "_alone", F.explode(changes).alias("e")).select(key, "_alone", "e.*")
                .where(F.col("_alone") | ~F.col("old_value").eqNullSafe(F.col("new_value"))).drop("_alone"))


def stock_after_usage(stock: DataFrame, usage: DataFrame, key: str, level: str, usage_key: str, used: str,
                      name: str = "stock_left") -> DataFrame:
    """Stock less all recorded usage; items never used keep their stock."""
    taken = usage.groupBy(F.col(usage_key).alias("_k")).agg(F.sum(used).alias("_used"))
    return (stock.join(taken, F.col(key) == F.col("_k"), "left")
                 .withColumn(name, F.col(level) - F.coalesce("_used", F.lit(0))).drop("_k", "_used"))
