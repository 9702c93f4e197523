"""Secrets in texts, with weak candidates reported only where the parts of a credential meet.

Sure patterns (passwords in assignments, access identifiers, long hex strings) are always reported. Weak ones
(account identifiers, random-looking strings, endpoints) are common in clean text, so each is joined with
the parts of other roles in its scope, the text up to ``SCOPE`` characters around it: an identifier needs a
secret there, a random-looking string needs an identifier, an endpoint needs both.

Only SQL functions are used. The text is scanned in place; what is shuffled, by row, are the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SCOPE = 200

# fixed values: kind, pattern, group that is measured, characters it must have, role
KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     1, 6, "secret"),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20, "identifier"),
    ("hex", r"([0-9a-f]{24,})", 1, 24, "secret"),
    ("account", r"""(?:[Cc]lient_?[Ii]d|[Aa]ccess_?[Kk]ey_?[Ii]d|[Uu]ser(?:_?[Nn]ame)?|[Ll]ogin|[Aa]ccount)["']?\x20*"""
                r"""[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""", 1, 3, "identifier"),
    ("random", r"([A-Za-z0-9+/_-]{32,}=*)", 1, 32, "secret"),
    ("endpoint", r"""([a-z][a-z0-9+]*://[A-Za-z0-9._~:/?#@!&()*+,;=%-]+)""", 1, 10, "endpoint"),
]
SURE = 3    # the first kinds are reported by themselves


def _matches(text: Column, number: int) -> Column:
    """All matches of one kind in order: the gap before each, its length, and whether it is long enough."""
    _, pattern, group, least, _ = KINDS[number]
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
                         F.split(text, pattern, -1).alias("gap"))
    found = F.transform(found, lambda m: F.struct(
        F.lit(number).alias("kind"), F.length(m["gap"]).alias("gap"), F.length(m["all"]).alias("length"),
        m["value"].alias("value"), (F.length(m["value"]) >= least).alias("valid")))
    return F.when(text.rlike(pattern), F.filter(found, lambda m: m["length"].isNotNull()))


def _near(role: str, scoped: Window, start: Column, end: Column) -> Column:
    """Whether a part of ``role`` lies within the scope of the current row, before or after it in order."""
    before = F.max(F.when(F.col("role") == role, F.col("end"))).over(scoped.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("role") == role, F.col("start"))).over(scoped.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(before >= start - SCOPE, F.lit(False)) | F.coalesce(after <= end + SCOPE, F.lit(False))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``spans``, an array of ``start, kind_no, kind, end, value`` in order.

    Offsets count code points, the end is exclusive. A null text is empty; a text without secrets has an
    empty array; repeated ids and rows keep a row each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    nothing = F.array().cast("array<struct<kind:int,gap:int,length:int,value:string,valid:boolean>>")
    parts = F.concat(*[F.coalesce(_matches(text, i), nothing) for i in range(len(KINDS))])
    found = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"), parts.alias("parts"))
    found = found.select("id", "rid", F.posexplode_outer("parts").alias("pos", "part")).select(
        "id", "rid", "pos", "part.*").repartition("rid")
    sofar = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(sofar))
    found = found.withColumn("start", F.col("end") - F.col("length"))
    roles = F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col("kind") + 1)
    valid = F.coalesce("valid", F.lit(False))
    found = found.withColumns({"role": F.when(valid, roles),
                               "sure_end": F.when(valid & (F.col("kind") < SURE), F.col("end")),
                               "sure_start": F.when(valid & (F.col("kind") < SURE), F.col("start"))})
    scoped = Window.partitionBy("rid").orderBy("start", "kind")
    here = [F.col("start"), F.col("end")]
    covered = (F.coalesce(F.max("sure_end").over(scoped.rowsBetween(Window.unboundedPreceding, -1)) > here[0], F.lit(False))
               | F.coalesce(F.min("sure_start").over(scoped.rowsBetween(1, Window.unboundedFollowing)) < here[1], F.lit(False)))
    found = found.withColumns({"covered": covered} | {f"near_{r}": _near(r, scoped, *here)
                                                      for r in ("identifier", "secret")})
    meets = (F.when(F.col("role") == "identifier", F.col("near_secret"))
             .when(F.col("role") == "secret", F.col("near_identifier"))
             .otherwise(F.col("near_identifier") & F.col("near_secret")))
    reported = valid & ((F.col("kind") < SURE) | (~F.col("covered") & meets))
    names = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", F.col("kind").alias("kind_no"), names.alias("kind"), "end", "value")
    return (found.groupBy("rid", F.col("id").alias(id_col))
            .agg(F.sort_array(F.collect_list(F.when(reported, span))).alias("spans")).drop("rid"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
