"""Global positions, latest rows, top-k and exact order statistics.

Nothing here sorts a whole table, or a whole group, in one task: rows are placed by
a range shuffle on the complete sort key, so a hot value is spread by its tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import draw
from ..session import cut_lineage


GROUP_ROWS = 1_000_000   # a group up to this size may be sorted by one task
PART_ROWS = 1_000_000    # rows of a range, where they have been counted


def _groups_fit(df: DataFrame, by: Sequence[str], limit: int) -> bool:
    """Whether every group has at most ``limit`` rows; only the keys are read."""
    if not by:
        return False
    biggest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return (biggest or 0) <= limit


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _range_sorted(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Rows sorted across the cluster and kept in reliable storage, with their partition and place in it.

    Without ``parts``, the number of partitions is left to adaptive execution, which merges neighbours only, so
    partitions stay in sort order.
    """
    placed = (df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
                .withColumn("_slot", F.monotonically_increasing_id()))
    return cut_lineage(placed).withColumns({"_part": F.shiftright("_slot", 33).cast("int"),
                                            "_slot": F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))})


def global_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx", start: int = 0,
                 step: int = 1) -> DataFrame:
    """Number all rows ``start, start+step, ...`` along ``order`` without a one-partition sort.

    Every row is shifted by the sizes of the partitions before its own; the driver
    sees one count per partition. ``order`` should end in a unique key: equal sort keys
    cannot be spread over several partitions.
    """
    placed = _range_sorted(df, _columns(order))
    before = _offsets(placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    position = F.element_at(before, F.col("_part") + 1) + F.col("_slot")
    return placed.withColumn(name, (position * step + start).cast("bigint")).drop("_slot", "_part")


def index_within(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "pos",
                 group_rows: int = GROUP_ROWS) -> DataFrame:
    """0-based position of every row inside its group.

    Groups of checked size are numbered by a window. If one is larger, all rows are
    range-sorted and a hot group is many partitions throughout; their number grows with the rows.
    """
    by = list(by)
    if _groups_fit(df, by, group_rows):
        window = Window.partitionBy(*by).orderBy(*_columns(order))
        return df.withColumn(name, (F.row_number().over(window) - 1).cast("bigint"))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _range_sorted(df, [*_columns(by), *_columns(order)], max(least, -(-df.count() // PART_ROWS)))
    shares = _group_shares(placed.groupBy("_part", *by).agg(F.count("*").alias("_s"), F.min("_slot").alias("_at")), by, "_at")
    # stored, so that their real size counts: if there are few, the rows stay where they are
    return (_join_null_safe(placed, cut_lineage(shares.drop("_total")), ["_part", *by])
            .withColumn(name, (F.col("_before") + F.col("_slot") - F.col("_at")).cast("bigint"))
            .drop("_before", "_at", "_slot", "_part"))


def _group_shares(shares: DataFrame, by: Sequence[str], *keep: str) -> DataFrame:
    """From each group's size ``_s`` per partition: its ``_total``, and how much of it lies in partitions before."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return shares.select("_part", *by, *keep, F.sum("_s").over(group).alias("_total"),
                         (F.sum("_s").over(group.orderBy("_part")) - F.col("_s")).alias("_before"))


def _offsets(sizes: list) -> Column:
    """Literal array of the running totals before each partition, from (_part, n) rows."""
    by_part = {r["_part"]: r["n"] for r in sizes}
    offsets, total = [], 0
    for p in range(max(by_part, default=0) + 1):
        offsets.append(total)
        total += by_part.get(p, 0)
    return F.expr("array(" + ",".join(f"{o}L" for o in offsets) + ")")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` treating NULL as an ordinary key, keeping one copy of the keys."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def argsort(df: DataFrame, value: str, tie: str, name: str = "rank") -> DataFrame:
    """0-based rank of every row by ``value``, ties by ``tie``."""
    return global_index(df, [value, tie], name=name)


def surrogate_keys(df: DataFrame, order: Sequence[str], name: str, start: int = 200000, step: int = 10) -> DataFrame:
    """Sequence keys in the given order."""
    return global_index(df, order, name=name, start=start, step=step)


def padded_ids(df: DataFrame, order: Sequence[str], prefix: str = "doc_", width: int = 4,
               name: str = "padded_id") -> DataFrame:
    """Ids such as ``doc_0001``, numbered from 1."""
    return (global_index(df, order, name="_n", start=1)
            .withColumn(name, F.format_string(f"{prefix}%0{width}d", "_n")).drop("_n"))


def last_per_key(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of every key. A max over structs, so partial aggregation shrinks hot keys map-side."""
    rest = [c for c in df.columns if c not in by]
    best = F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_columns(order))], *rest)).alias("_best")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"_best.{c}").alias(c) for c in rest])


def first_per_key(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key along ascending ``order``."""
    rest = [c for c in df.columns if c not in by]
    best = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_columns(order))], *rest)).alias("_best")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"_best.{c}").alias(c) for c in rest])


def best_row(df: DataFrame, metric: str, tie: str, mode: str = "min") -> DataFrame:
    """The single best row of a result table, first by ``tie`` on equal metric."""
    order = F.col(metric).asc() if mode == "min" else F.col(metric).desc()
    return df.orderBy(order, F.col(tie).asc()).limit(1)


def top_terms(df: DataFrame, term: str, n: int = 10, count: str = "n") -> DataFrame:
    """The ``n`` most frequent terms, ties in term order."""
    return (df.groupBy(term).agg(F.count("*").alias(count))
              .orderBy(F.desc(count), F.asc(term)).limit(n))


def top_per_key(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` best rows of every key. ``rank <= n`` is applied before the shuffle as well as after it,

    so a hot key reaches its final task as at most ``n`` rows per map task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def side_by_side(tops: dict[str, DataFrame], term: str, order: Sequence[Column], n: int = 10) -> DataFrame:
    """Top lists next to each other, aligned by rank: (rank, one column per list); a short list leaves NULLs."""
    out = None
    for name, top in tops.items():
        best = top.orderBy(*order).limit(n)                 # n rows, so one task may number them
        ranked = best.select(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).alias("rank"),
                             F.col(term).alias(name))
        out = ranked if out is None else out.join(ranked, "rank", "full")
    return out


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """Exactly ``n`` rows without replacement: the smallest hashes of the key, of any type."""
    return df.orderBy(draw(F.lit("sample"), F.lit(seed), F.col(key)), F.col(key).asc()).limit(n)


def quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, weight: str | None = None,
              group_rows: int = GROUP_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation, one column (``p0, p1, ...``) per requested level.

    Groups of checked size use the built-in exact percentile. If one is larger, equal values are counted before anything moves, so a value that fills a third of the
    table is one row. The distinct (group, value) pairs are range-sorted across the
    cluster and given the positions their copies cover within the group; the pair covering
    each wanted position is picked by an ordinary aggregate. A hot group is many partitions. With ``weight``
    each row stands for that many copies of its value.
    """
    by, names = list(by), names or [f"p{i}" for i in range(len(qs))]
    kept = df.where(F.col(value).isNotNull()).select(
        *by, F.col(value).cast("double").alias("_v"), (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("_n"))
    if _groups_fit(kept, by, group_rows):
        levels = F.percentile("_v", [float(q) for q in qs], F.col("_n"))
        return (kept.groupBy(*by).agg(levels.alias("_q"))
                    .select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]))
    counts = kept.groupBy(*by, "_v").agg(F.sum("_n").alias("_n"))
    placed = _range_sorted(counts, _columns([*by, "_v"]))
    # at most one row per group and partition it touches
    shares = _group_shares(placed.groupBy("_part", *by).agg(F.sum("_n").alias("_s")), by)
    running = F.sum("_n").over(Window.partitionBy("_part", *by).orderBy("_slot"))
    spots = (_join_null_safe(placed, shares, ["_part", *by])
             .withColumn("_from", F.col("_before") + running - F.col("_n")))
    covers = lambda pos: (F.col("_from") <= pos) & (pos < F.col("_from") + F.col("_n"))
    at = [(F.col("_total") - 1) * float(q) for q in qs]
    picked = spots.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[F.max(F.when(covers(F.floor(p)), F.col("_v"))).alias(f"_l{i}") for i, p in enumerate(at)],
        *[F.max(F.when(covers(F.ceil(p)), F.col("_v"))).alias(f"_h{i}") for i, p in enumerate(at)])
    return picked.select(*by, *[(F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (p - F.floor(p))).alias(n)
                                for i, (p, n) in enumerate(zip(at, names))])


def medians(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median", **plan) -> DataFrame:
    return quantiles(df, value, [0.5], by, [name], **plan)


def rolling_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, n: int,
                 name: str = "rolling_mean", block: int = 100_000, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Centred mean of width ``n`` (odd), truncated at both ends of each series.

    Series of checked length use one window. If one is longer, series are cut in blocks; the ``n // 2`` rows next to a cut are sent to the
    neighbouring block too, so each window runs over a bounded block and is still exact.
    """
    half = n // 2
    if half >= block:
        raise ValueError("the block must be longer than half the window")
    if _groups_fit(df, by, group_rows):
        return df.withColumn(name, F.avg(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-half, half)))
    placed = index_within(df, by, order, name="_pos", group_rows=group_rows)
    home = F.floor(F.col("_pos") / block).cast("bigint")
    reach = F.array_distinct(F.array(F.floor((F.col("_pos") - half) / block).cast("bigint"), home,
                                     F.floor((F.col("_pos") + half) / block).cast("bigint")))
    spread = placed.withColumn("_home", home).withColumn("_block", F.explode(reach))
    window = Window.partitionBy(*by, "_block").orderBy("_pos").rowsBetween(-half, half)
    return (spread.withColumn(name, F.avg(value).over(window))
                  .where(F.col("_block") == F.col("_home")).drop("_pos", "_home", "_block"))
