"""Rows out of semi-structured text: record splitting, list items, typed fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import first_match


def split_records(df: DataFrame, text: str, delimiter: str, name: str = "record") -> DataFrame:
    """One row per non-empty record of ``text`` cut at the regex ``delimiter``, numbered from 0."""
    parts = F.filter(F.split(F.col(text), delimiter), lambda r: r != "")
    return df.select("*", F.posexplode(parts).alias("record_no", name)).drop(text)


def extract_items(df: DataFrame, html: str, item_regex: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per match of ``item_regex``; its capture groups become the columns ``names``."""
    groups = [F.regexp_extract_all(F.col(html), F.lit(item_regex), F.lit(i + 1)).alias(n)
              for i, n in enumerate(names)]
    return df.select(*keep, F.posexplode(F.arrays_zip(*groups)).alias("pos", "_e")) \
             .select(*keep, "pos", *[F.col(f"_e.{n}").alias(n) for n in names])


def extract_fields(df: DataFrame, text: str, fields: Mapping[str, tuple[str, str | None, str]],
                   keep: Sequence[str]) -> DataFrame:
    """Typed columns from a text: ``{name: (regex with one group, default, type)}``."""
    cols = []
    for name, (regex, default, kind) in fields.items():
        found = first_match(F.col(text), regex)
        if default is not None:
            found = F.coalesce(found, F.lit(default))
        cols.append((found if kind == "string" else found.try_cast(kind)).alias(name))
    return df.select(*keep, *cols)
