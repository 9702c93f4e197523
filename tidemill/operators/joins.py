"""Join operators. Sides are reduced to one row per key before they meet, so no key multiplies rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import name_rules
from ..session import cut_lineage
from .ordering import medians

BROADCAST_GROUPS = 10_000


def lookup(df: DataFrame, key: str, mapping: DataFrame, map_key: str, map_value: str, name: str,
           default: Column | None = None) -> DataFrame:
    """``dict.get``: the mapped value, or ``default`` (or NULL). Duplicate keys keep their smallest value."""
    slim = mapping.groupBy(F.col(map_key).alias("_k")).agg(F.min(map_value).alias("_v"))
    value = F.col("_v") if default is None else F.coalesce("_v", default)
    return df.join(slim, df[key] == F.col("_k"), "left").withColumn(name, value).drop("_k", "_v")


def match_rounded(df: DataFrame, ref: DataFrame, pairs: Sequence[tuple[str, str]], ref_id: str, name: str,
                  digits: int = 7) -> DataFrame:
    """Match coordinates that agree after rounding; decimals, never raw doubles, are compared.

    Of several reference rows at one place the smallest id is taken.
    """
    kind = f"decimal(18,{digits})"
    keyed = ref.groupBy(*[F.round(b, digits).cast(kind).alias(f"_k{i}") for i, (_, b) in enumerate(pairs)]) \
               .agg(F.min(ref_id).alias(name))
    left = df.withColumns({f"_k{i}": F.round(a, digits).cast(kind) for i, (a, _) in enumerate(pairs)})
    keys = [f"_k{i}" for i in range(len(pairs))]
    return left.join(keyed, keys, "left").drop(*keys)


def keep_members(df: DataFrame, key: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return df.join(members.select(F.col(member_key).alias("_m")).distinct(), F.col(key) == F.col("_m"), "left_semi")


def unmatched_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Keys of either side that the other side lacks, tagged with their side."""
    a = left.select(F.col(left_key).alias("key")).distinct()
    b = right.select(F.col(right_key).alias("key")).distinct()
    return (a.join(b, "key", "left_anti").withColumn("side", F.lit("left"))
            .unionByName(b.join(a, "key", "left_anti").withColumn("side", F.lit("right"))))


def attach_groups(df: DataFrame, groups: DataFrame, by: Sequence[str], size: int | None = None) -> DataFrame:
    """Left join with a table of one row per group, NULL keys included, so that no row is lost.

    The groups are written out first and counted: up to ``BROADCAST_GROUPS`` they are sent to all tasks and the rows
    stay where they are, hot groups too. More groups are joined by a shuffle. ``size`` is given for groups
    that hold lists: the length of all of them.
    """
    groups = cut_lineage(groups.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[c for c in groups.columns if c not in by]))
    side = F.broadcast(groups) if (groups.count() if size is None else size) <= BROADCAST_GROUPS else groups
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return df.join(side, same, "left").drop(*[f"_by_{c}" for c in by])


def above_group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "above_median") -> DataFrame:
    """1 where the value exceeds the exact median of its group, else 0, also for a NULL value; NULL is a group."""
    return (attach_groups(df, medians(df, value, keys, name="group_median"), keys)
            .withColumn(name, F.when(F.col(value) > F.col("group_median"), 1).otherwise(0)))


def trailing_mean(df: DataFrame, key: Sequence[str], period: str, value: str, n: int = 3,
                  name: str = "trailing_mean") -> DataFrame:
    """Mean of the ``n`` periods before each period; NULL unless all of them are present.

    The input is one row per key and period; repeated rows are summed first, which
    also bounds every window by the number of periods.
    """
    series = df.groupBy(*key, period).agg(F.sum(value).alias(value))
    window = Window.partitionBy(*key).orderBy(period).rangeBetween(-n, -1)
    return series.withColumn(name, F.when(F.count(value).over(window) == n, F.avg(value).over(window)))


def reconcile_names(left: DataFrame, right: DataFrame, name: str, abbreviations: Mapping[str, str],
                    out: str = "match", rule: str = "rule") -> DataFrame:
    """Match names by their normal forms, strongest form first; NULL when no form agrees.

    Both sides are reduced to distinct names, and the right side to one name per
    normal form, so every form is an N:1 equi-join. Rule 0 is the exact name.
    """
    wanted = left.select(name).distinct()
    known = right.select(F.col(name).alias("_r")).distinct()
    left_forms, right_forms = name_rules(F.col(name), abbreviations), name_rules(F.col("_r"), abbreviations)
    # an apostrophe or 's is dropped on the left only; spaces and abbreviations on both sides
    right_forms = [right_forms[0], right_forms[0], right_forms[0], right_forms[3], right_forms[4]]
    keys = lambda forms: F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), f.alias("form"))
                                             for i, f in enumerate(forms)]))
    options = (known.select(keys(right_forms).alias("_f"), "_r").groupBy("_f.rule", "_f.form")
                    .agg(F.min("_r").alias("_r")))
    found = (wanted.select(name, keys(left_forms).alias("_f"))
                   .join(options, (F.col("_f.rule") == F.col("rule")) & (F.col("_f.form") == F.col("form")))
                   .groupBy(name).agg(F.min(F.struct("rule", "_r")).alias("_b")))
    return wanted.join(found, name, "left").select(name, F.col("_b._r").alias(out), F.col("_b.rule").alias(rule))
