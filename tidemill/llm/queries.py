"""The registered queries of the training-data operators and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from . import (bpe, credentials, exact, language, mixing, periodic, quality, repeats, roles, sharding, simhash, topk,
               wrapper)
from .common import WORD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its checking SQL if there is one."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn
    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op8_exact_dedup", r"""
    with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
    select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
           doc_id = min(doc_id) over g as kept, sha256(norm) as text_sha256
    from t window g as (partition by norm)""")
def op8_exact_dedup(spark, folder):
    """Every document with the row that stays of its exact copies."""
    return exact.exact_duplicates(documents(spark, folder))


@query("op1_sampled_shards")
def op1_sampled_shards(spark, folder):
    """Every document with its shard and slot; shards hold nearly equal bytes."""
    placed = sharding.shard_documents(documents(spark, folder), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op3_pivotal_mix")
def op3_pivotal_mix(spark, folder):
    """Every document with the words the mix takes of it."""
    units = mixing.mix(documents(spark, folder))
    return units.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"),
                        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("member")).drop("member")


def _secrets_sql() -> str:
    """The same spans in SQL: matches by position, then a correlated search of each weak one's scope."""
    kinds = ", ".join("({}, '{}', '{}', {}, '{}')".format(i, k[0], k[1].replace("'", "''"), k[3], k[4])
                      for i, k in enumerate(credentials.KINDS))
    return f"""
    with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
    kinds(kind_no, kind, pattern, least, role) as (values {kinds}),
    lists as (select rid, kind_no, kind, least, role, regexp_extract_all(t, pattern) as found,
                     regexp_extract_all(t, pattern, 1) as vals, string_split_regex(t, pattern) as gaps
              from d, kinds where regexp_matches(t, pattern)),
    one as (select rid, kind_no, kind, least, role, unnest(range(1, len(found) + 1)) as i, found, vals, gaps from lists),
    ends as (select rid, kind_no, kind, role, length(vals[i]) >= least as valid, length(found[i]) as n,
                    sum(length(gaps[i]) + length(found[i])) over (partition by rid, kind_no order by i)::bigint as e from one),
    parts as (select rid, kind_no, kind, role, e - n as s, e from ends where valid),
    kept as (select * from parts p where kind_no < {credentials.SURE} or (
        not exists (select 1 from parts q where q.rid = p.rid and q.kind_no < {credentials.SURE} and q.s < p.e and q.e > p.s)
        and (role = 'secret' or exists (select 1 from parts q where q.rid = p.rid and q.role = 'secret'
             and q.e >= p.s - {credentials.SCOPE} and q.s <= p.e + {credentials.SCOPE}))
        and (role = 'identifier' or exists (select 1 from parts q where q.rid = p.rid and q.role = 'identifier'
             and q.e >= p.s - {credentials.SCOPE} and q.s <= p.e + {credentials.SCOPE})))),
    digest as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, kind_no) filter (kind_no < {credentials.SURE}) as base,
        string_agg(kind || ':' || s || ':' || e, ',' order by s, kind_no) as spans from kept group by rid)
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join digest using (rid)"""


@query("op4_linked_secrets", _secrets_sql())
def op4_linked_secrets(spark, folder):
    """Every document with its secrets."""
    found = credentials.find_secrets(documents(spark, folder))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
             for k in ("assign", "access", "hex")]
    base = credentials.written(F.filter("spans", lambda s: s["kind_no"] < credentials.SURE))
    return found.select("doc_id", *count, F.sha2(base, 256).alias("base_sha256"),
                        credentials.written(F.col("spans")).alias("spans"))


def vocabulary(spark: SparkSession):
    """The public byte-level vocabulary and its pattern."""
    import public_tokenizers

    return bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@query("op7_bpe_transducer")
def op7_bpe_transducer(spark, folder):
    """Every document encoded and decoded again, as digests."""
    return bpe.round_trip(documents(spark, folder), *vocabulary(spark))


@query("op2_simhash_vantage")
def op2_simhash_vantage(spark, folder):
    """Every document with its fingerprint and the component of its near duplicates."""
    return simhash.simhash_groups(documents(spark, folder), shingle=4, max_bits=4)


@query("op9_norm_sorted_topk", """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
               where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as (select a.vec_id as query_id, b.vec_id,
                 list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
          from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
    r as (select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as k from p)
    select query_id, k::int as rank, vec_id, score from r where k <= 20""")
def op9_norm_sorted_topk(spark, folder):
    """The 20 best inner products of every twentieth vector with all others."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return topk.top_inner_products(vectors, F.col("vec_id") % 20 == 0, k=20)


@query("op10_language_centroids")
def op10_language_centroids(spark, folder):
    """Every document with its predicted language, learned from two thirds of the labelled ones."""
    docs = documents(spark, folder)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language.fit(docs.filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), language.predict(F.col("text"), model, spark).alias("p")
                       ).select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


@query("op5_wrapper_induction")
def op5_wrapper_induction(spark, folder):
    """The main text of every page."""
    texts = wrapper.main_texts(spark.read.parquet(f"{folder}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op6_repeated_passages")
def op6_repeated_passages(spark, folder):
    """What is left of every document without its repeated passages."""
    left = repeats.repeated_passages(documents(spark, folder), length=400, keep_bytes=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def damaged_turns(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults of the contract; rows that are gone stay as not ``present``, to name their conversation."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    damaged = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))))
    return damaged.drop("col")


def _role_repair_sql():
    """The same repair in SQL: CRC-32 by its table, and the cheapest edits row by row over the places in the role pattern."""
    moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}     # start, after s, after u, after a
    inserts = [(0, 0, ""), (0, 2, "I"), (0, 3, "II"), (1, 1, ""), (1, 2, "I"), (1, 3, "II"), (2, 2, ""), (2, 3, "I"), (3, 3, ""), (3, 2, "I")]
    steps = []
    for at, to, edits in inserts:
        cost = 2 * len(edits)
        steps.append((at, to, "*", cost + 3, edits + "D", 0))
        steps += [(at, after, role, cost, edits + "K", 1) for (place, role), after in moves.items() if place == to]
        steps += [(at, after, "*", cost + 2, edits + "R", 1) for (place, _), after in sorted(set(((p, ""), a) for (p, r), a in moves.items() if r in "ua")) if place == to]
    values = ", ".join(f"({a}, {b}, '{r}', {c}, '{e}', {s})" for a, b, r, c, e, s in steps)
    ends = ", ".join(f"({a}, '{e}')" for a, b, e in inserts if b in (0, 3))
    return f"""
    with recursive crc as (select list(list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t
                           from (select unnest(range(0, 256)) as i)),
    keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                     coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
    kinds as (select keyed.*, xor(list_reduce(list_transform(string_split(key, ''), lambda ch: ascii(ch)::bigint),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as kind from keyed, crc),
    damaged as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                       case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                       unnest(range(0, case when kind = 3 then 2 else 1 end)) from kinds where kind <> 0),
    ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
                       regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') as ink from damaged),
    marked as (select *, left(role, 1) as initial, case when ink = '' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd' when right(ink, 1) not in ('.', '!', '?') then 't' else '-' end as fault from ordered),
    steps(st, nxt, initial, cost, edits, stays) as (values {values}),
    ways as (select conv_id, 0::bigint as i, 0 as st, 0::bigint as cost, '' as audit from (select distinct conv_id from marked)
        union all
        select conv_id, i, st, w.cost, w.audit from (
            select ways.conv_id, marked.i, steps.nxt as st,
                   min(struct_pack(cost := ways.cost + steps.cost + steps.stays * (fault = 't')::int, audit := ways.audit || steps.edits)) as w
            from ways join marked on marked.conv_id is not distinct from ways.conv_id and marked.i = ways.i + 1
            join steps on steps.st = ways.st and (steps.initial = '*' or steps.initial = marked.initial) and (steps.stays = 0 or fault not in ('b', 'd'))
            group by 1, 2, 3)),
    ends(st, edits) as (values {ends}),
    best as (select ways.conv_id as conv_id, min(struct_pack(cost := cost + 2 * length(edits), audit := audit || edits)) as w
             from ways join ends using (st) join (select conv_id, max(i) as i from marked group by 1) m using (i)
             where ways.conv_id is not distinct from m.conv_id group by 1),
    edits as (select conv_id, p, audit[p] as e, length(regexp_replace(audit[1:p], 'I', '', 'g')) as i, length(regexp_replace(audit[1:p], 'D', '', 'g'))
                     - length(regexp_replace(audit, 'D', '', 'g')) % 2 as nth from (select conv_id, w.audit as audit, unnest(range(1, length(w.audit) + 1)) as p from best)),
    lines as (select edits.conv_id, p, case when e = 'K' then role when nth % 2 = 1 then 'user' else 'assistant' end || ':' || case when e = 'I' then '' else text end as line
              from edits left join marked on marked.conv_id is not distinct from edits.conv_id and marked.i = edits.i where e <> 'D'),
    texts as (select conv_id, string_agg(line, chr(10) order by p) as text from lines group by 1),
    pairs as (select *, left(lag(role) over (partition by conv_id order by i), 1) || initial as pair, lag(i) over (partition by conv_id order by i) as before from marked),
    counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
                      count(*) filter (fault = 't') as truncated, count(*) filter (before is not null and pair not in ('su', 'ua', 'au')) as illegal from pairs group by 1)
    select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
           coalesce(w.cost, 0)::bigint as cost, coalesce(w.audit, '') as audit, sha256(coalesce(texts.text, '')) as repaired_sha256
    from (select distinct conv_id from conversations) c left join counts on counts.conv_id is not distinct from c.conv_id
    left join best on best.conv_id is not distinct from c.conv_id left join texts on texts.conv_id is not distinct from c.conv_id"""


@query("op11_role_repair", _role_repair_sql())
def op11_role_repair(spark, folder):
    """Every damaged conversation with its faults and its cheapest repair."""
    rows = damaged_turns(spark.read.parquet(f"{folder}/conversations.parquet"))
    return roles.repair_conversations(rows, present=F.col("present"))


@query("op12_additive_quality")
def op12_additive_quality(spark, folder):
    """Every document with its quality score, learned from three quarters of the labelled ones."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    measured = cut_lineage(documents(spark, folder).select("doc_id", held_out.alias("held_out"), quality.measures(F.col("text")).alias("measures")))
    marks = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("label"))
    model = quality.fit(measured.filter(~F.col("held_out")).join(marks, "doc_id"))
    scored = measured.select("doc_id", "held_out", quality.predict(F.col("measures"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def looped_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in the texts of one id in ten, the words from some word on repeat."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when((h % 10 == 0) & F.col("text").rlike(WORD), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    looped = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    looped = looped.withColumn("n", F.size("words")).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    looped = looped.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    times, period = F.floor(rest / F.col("p")).cast("int"), F.slice("words", F.col("a") + 1, F.col("p"))
    parts = F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, times)),
                     F.slice("words", F.col("a") + 1, rest % F.col("p")))
    return looped.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(parts, " ")).alias("text"))


@query("op13_lyndon_runs")
def op13_lyndon_runs(spark, folder):
    """Every document, some with repetitions put in, with its runs and what is left without repetitions."""
    found = looped_texts(documents(spark, folder)).select("doc_id", periodic.periodic_runs(F.col("text"), keep_text=False).alias("r"))
    found = found.select("doc_id", "r.runs", "r.collapsed_sha256").withColumn("best", periodic.best_run(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                        F.sha2(periodic.written(F.col("runs")), 256).alias("runs_sha256"), "collapsed_sha256")
