"""Shards of nearly equal bytes by sampled splitters over a hash of the text.

Rows are ordered by (hash of the text, id, row), so equal texts are neighbours. A size-weighted sample of the
hashes gives the splitters of many ranges. Ranges that turn out overfull are subdivided: a single text with
more than a range's load is dealt out row by row, otherwise whole texts are dealt out. The exact bytes of
all cells then place every text, dealt out or not, into a shard by its middle in the global order; only a text with
more bytes than a shard should hold is split, by the middles of its rows. Everything is DataFrame code; the driver
sees the splitters alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import count_upto, packed, uniform

ROWS_PER_RANGE = 250_000
RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 32


def _splitters(light: DataFrame, load: float, ranges: int) -> list[int]:
    """First values of all ranges but the first: quantiles of a sample in which a row's chance grows with its load."""
    step = load / (ranges * SAMPLES_PER_RANGE)
    sample = light.filter(uniform("h", "id", "rid", F.lit("sample")) * step < F.col("load"))
    sample = sample.select("h", F.greatest(F.col("load"), F.lit(step)).alias("weight"))
    share = F.sum("weight").over(Window.orderBy("h")) / sample_total(sample)
    cells = sample.select("h", F.ceil(share * ranges - 1e-9).alias("cell")).filter(F.col("cell") < ranges)
    return sorted(r[0] for r in cells.groupBy("cell").agg(F.max("h")).select(F.col("max(h)") + 1).collect())


def sample_total(sample: DataFrame):
    return F.sum("weight").over(Window.partitionBy(F.lit(0)))


def _cells(light: DataFrame, n: int, ranges: int) -> DataFrame:
    """``light`` with ``cell = (range, hot text or null, piece)``, none much larger than a range should be."""
    load = 2.0 * n
    splitters = _splitters(light, load, ranges)
    bounds = F.split(F.lit(",".join(map(str, splitters or [0]))), ",").cast("array<bigint>")   # a constant
    ranged = light.withColumn("range", count_upto(bounds, F.col("h"), len(splitters)))
    most = load / ranges
    texts = cut_lineage(ranged.groupBy("range", "h").agg(F.sum("load").alias("load")))
    pieces = F.ceil(F.col("load") / most).cast("int")
    # by counting, fewer than ``ranges`` texts and ranges can be this large, so both lists have a bound
    hot = texts.filter(F.col("load") > most).select("h", pieces.alias("rows_dealt"))
    over = (texts.filter(F.col("load") <= most).groupBy("range").agg(F.sum("load").alias("load"))
            .filter(F.col("load") > 2 * most).select("range", pieces.alias("texts_dealt")))
    dealt = ranged.join(F.broadcast(hot), "h", "left").join(F.broadcast(over), "range", "left")
    piece = (F.when(F.col("rows_dealt").isNotNull(), F.pmod(F.xxhash64("id", "rid"), "rows_dealt"))
             .when(F.col("texts_dealt").isNotNull(), F.pmod(F.xxhash64("h"), "texts_dealt")).otherwise(0))
    hot_text = F.when(F.col("rows_dealt").isNotNull(), F.col("h")).alias("hot")
    return dealt.withColumn("cell", F.struct("range", hot_text, piece.cast("int").alias("piece")))


def _assigned(light: DataFrame, shards: int, rows_per_range: int) -> DataFrame:
    """``id, size, crc, rid, shard, slot`` for staged rows ``id, size, crc, h, rid``."""
    n, total = light.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(RANGES_PER_SHARD * shards, -(-n // rows_per_range))
    mean = max(total, 1) / max(n, 1)
    light = light.withColumn("load", F.floor(F.col("size") / mean) + 1)
    celled = _cells(light, max(n, 1), ranges)
    ordered = Window.partitionBy("cell").orderBy("h", "id", "rid")
    unit = Window.partitionBy("cell", "h", F.when(F.col("cell.hot").isNotNull(), F.col("rid")))
    placed = celled.withColumns({"pos": F.row_number().over(ordered),
                                 "ends": F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0))})
    placed = cut_lineage(placed.select(
        "id", "size", "crc", "rid", "cell", "pos",
        ((F.min(F.col("ends") - F.col("size")).over(unit) + F.max("ends").over(unit)) / 2).alias("middle")))
    # one row per cell, then one per cell and shard: bounded by the number of ranges
    cells = placed.groupBy("cell").agg(F.sum("size").alias("bytes"))
    cells = cells.select("cell", "bytes", (F.sum("bytes").over(Window.orderBy("cell")) - F.col("bytes")).alias("before"))
    # the pieces of a text that was dealt out follow each other; unless it is larger than a shard, they share its middle
    text = Window.partitionBy("cell.range", "cell.hot")
    whole = F.col("cell.hot").isNotNull() & (F.sum("bytes").over(text) * shards <= total)
    cells = cells.select("cell", "before", F.when(whole, F.min("before").over(text) + F.sum("bytes").over(text) / 2).alias("shared"))
    middle = F.coalesce("shared", F.col("before") + F.col("middle"))
    shard = F.floor(middle * shards / float(max(total, 1)))
    placed = (placed.join(F.broadcast(cells), "cell")
              .withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int")))
    parts = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"), F.min("pos").alias("first"))
    earlier = F.sum("rows").over(Window.partitionBy("shard").orderBy("cell")) - F.col("rows")
    parts = parts.select("shard", "cell", (earlier - F.col("first")).alias("shift"))
    return placed.join(F.broadcast(parts), ["shard", "cell"]).select(
        "id", "size", "crc", "rid", "shard", (F.col("pos") + F.col("shift")).cast("long").alias("slot"))


def _light(rows: DataFrame, text) -> DataFrame:
    text = F.coalesce(text, F.lit(""))
    return rows.select("id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("crc"), F.xxhash64(text).alias("h"), "rid")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per input row: ``id_col, size, text_crc32, shard, slot``; slots are gapless in each shard.

    Size is the UTF-8 bytes of the text (null: none) plus 1. Null and empty texts are equal texts; null ids,
    repeated ids and repeated rows are placed like any other row. An empty table gives an empty result.
    """
    rid = F.monotonically_increasing_id().alias("rid")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), rid)
    placed = _assigned(cut_lineage(_light(rows, F.col("text"))), shards, rows_per_range)
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the whole rows, with their columns, below ``path/shard=N``, each file a range of slots.

    The folders are named ``_shard=N`` if the rows have a column ``shard`` of their own, and so on.
    """
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), packed(docs),
                                   F.monotonically_increasing_id().alias("rid")))
    placed = _assigned(cut_lineage(_light(rows, F.col(f"row.`{text_col}`"))), shards, ROWS_PER_RANGE)
    folder = "shard"
    while folder in docs.columns:
        folder = f"_{folder}"
    (rows.select("rid", "row").join(placed.select("rid", "shard", "slot"), "rid")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("row.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path))
