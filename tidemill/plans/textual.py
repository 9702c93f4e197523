"""Text mining on documents, pages and conversations."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.stem import stem
from ..operators import textmine as T
from ..session import cut_lineage, scratch_path
from ..sources import readers, sinks
from ..sources.tables import documents, table
from .ordering import _WORDS, document_words
from .registry import query

# Short English stop list, the default of the registered queries.
STOP_WORDS = ("a an and are as at be but by for from had has have he her his i if in into is it its no not of on or "
              "she so such that the their then there these they this to was we were what when which who will with "
              "would you your").split()
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TOKEN_SQL = "regexp_extract_all(text, '([A-Za-z]\\w+(?:[-''?]\\w+)?)', 1)"
_TFIDF_TOKENS = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '(\\w\\w+)', 1)) AS term FROM documents"
_VOCAB_SQL = f"""
    SELECT w AS term, count(DISTINCT doc_id) AS df FROM ({_WORDS}) WHERE w <> '' GROUP BY 1
    HAVING count(DISTINCT doc_id) >= 0.03 * (SELECT count(*) FROM documents)
       AND count(DISTINCT doc_id) < 0.95 * (SELECT count(*) FROM documents)"""


@query("word_count", f"SELECT w AS word, count(*) AS n FROM ({_WORDS}) WHERE w <> '' GROUP BY 1")
def word_count(spark, sf):
    return T.count_words(documents(spark, sf), F.split(X.clean_line(F.translate("text", "\r\n", "  ")), " "))


@query("word_count_nostop", f"""
    SELECT w AS word, count(*) AS n FROM ({_WORDS}) WHERE w <> '' AND w NOT IN ({_STOP_SQL}) GROUP BY 1""")
def word_count_nostop(spark, sf):
    return T.drop_words(word_count(spark, sf), "word", STOP_WORDS)


@query("regex_tokens", f"""
    SELECT doc_id, CAST(len({_TOKEN_SQL}) AS BIGINT) AS n_tokens, md5(array_to_string({_TOKEN_SQL}, ' ')) AS tokens
    FROM documents""")
def regex_tokens(spark, sf):
    docs = documents(spark, sf).select("doc_id", X.regex_tokens(F.col("text")).alias("t"))
    return docs.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query("section_slice", """
    SELECT page_id, CAST(length(s) AS BIGINT) AS n_chars, md5(s) AS section FROM (
        SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</article>', 1) AS s FROM pages) WHERE s <> ''""")
def section_slice(spark, sf):
    cut = table(spark, sf, "pages").select("page_id", X.section_between(F.col("html"), "<h1>", "</article>").alias("s"))
    return cut.where(F.col("s").isNotNull()).select(
        "page_id", F.length("s").cast("bigint").alias("n_chars"), F.md5("s").alias("section"))


@query("dehyphenate", """
    SELECT doc_id, md5(regexp_replace(replace(text, 'tion', 'ti- on'), '(\\w)- (\\w)', '\\1\\2', 'g')) AS joined
    FROM documents""")
def dehyphenate(spark, sf):
    broken = F.replace("text", F.lit("tion"), F.lit("ti- on"))
    return documents(spark, sf).select("doc_id", F.md5(X.dehyphenate(broken)).alias("joined"))


@query("sentence_split", """
    SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, md5(lower(substr(parts[i], 1, 1)) || substr(parts[i], 2)) AS sentence
    FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+([A-Z])', '\\1' || chr(31) || '\\2', 'g'), chr(31)) AS parts
          FROM documents), unnest(generate_series(1, len(parts))) AS u(i)""")
def sentence_split(spark, sf):
    out = documents(spark, sf).select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "s"))
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.md5("s").alias("sentence"))


_BIGRAM_SQL = f"""
    WITH toks AS (SELECT doc_id, {_TOKEN_SQL.replace('text', 'lower(text)')} AS t FROM documents),
         pairs AS (SELECT t[i] AS a, t[i + 1] AS b FROM toks, unnest(generate_series(1, len(t) - 1)) AS u(i)),
         top AS (SELECT a, b, count(*) AS n FROM pairs WHERE a NOT IN ({_STOP_SQL}) AND b NOT IN ({_STOP_SQL})
                 GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY n DESC, a, b LIMIT 200)"""


def _lower_tokens():
    return X.regex_tokens(F.lower("text"))


@query("top_bigrams", f"{_BIGRAM_SQL} SELECT a, b, n FROM top")
def top_bigrams(spark, sf):
    return T.top_bigrams(documents(spark, sf), _lower_tokens(), STOP_WORDS)


@query("merge_bigrams", f"""{_BIGRAM_SQL},
    slots AS (SELECT doc_id, i, t[i] AS w, top.a IS NOT NULL AS hit
           FROM toks, unnest(generate_series(1, len(t))) AS u(i) LEFT JOIN top ON top.a = t[i] AND top.b = t[i + 1]),
    runs AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, hit ORDER BY i) AS run FROM slots),
    starts AS (SELECT *, hit AND (i - min(i) OVER (PARTITION BY doc_id, hit, run)) % 2 = 0 AS starts FROM runs),
    outs AS (SELECT doc_id, i, starts, w, lead(w) OVER o AS nxt, coalesce(lag(starts) OVER o, false) AS eaten FROM starts
             WINDOW o AS (PARTITION BY doc_id ORDER BY i))
    SELECT doc_id, count(*) AS n_tokens, md5(string_agg(CASE WHEN starts THEN w || '__' || nxt ELSE w END, ' ' ORDER BY i)) AS tokens
    FROM outs WHERE NOT eaten GROUP BY 1""")
def merge_bigrams(spark, sf):
    docs = documents(spark, sf)
    pairs = [(r["a"], r["b"]) for r in T.top_bigrams(docs, _lower_tokens(), STOP_WORDS).collect()]
    merged = T.merge_bigrams(docs.select("doc_id", _lower_tokens().alias("t")), F.col("t"), pairs, "t")
    return merged.where(F.size("t") > 0).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query("df_pruned_vocab", _VOCAB_SQL)
def df_pruned_vocab(spark, sf):
    return T.prune_vocab(_word_counts(spark, sf), "term", T.document_count(table(spark, sf, "documents")))


def _word_counts(spark, sf):
    return T.term_counts(document_words(spark, sf, "doc_id").withColumnRenamed("w", "term"), "doc_id", "term")


def _indexed_vocab(spark, sf):
    return T.vocab_index(df_pruned_vocab(spark, sf).select("term"), "term")


@query("vocab_index", f"SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM ({_VOCAB_SQL})")
def vocab_index(spark, sf):
    return _indexed_vocab(spark, sf)


_COUNTS_SQL = f"""
    WITH v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM ({_VOCAB_SQL}))
    SELECT doc_id, term_index, count(*) AS n FROM ({_WORDS}) JOIN v ON w = term GROUP BY 1, 2"""


@query("doc_term_counts", _COUNTS_SQL)
def doc_term_counts(spark, sf):
    counts = cut_lineage(_word_counts(spark, sf))      # the texts are read and counted once
    vocab = T.prune_vocab(counts, "term", T.document_count(table(spark, sf, "documents")))
    return T.doc_term_counts(counts, "doc_id", "term", T.vocab_index(vocab.select("term"), "term"))


@query("sparse_vector_text", f"""
    SELECT doc_id || coalesce(',' || pairs, '') AS value FROM documents LEFT JOIN (
        SELECT doc_id, string_agg(term_index || ':' || n, ',' ORDER BY term_index) AS pairs FROM ({_COUNTS_SQL}) GROUP BY doc_id) USING (doc_id)""")
def sparse_vector_text(spark, sf):
    path = scratch_path(spark, "vectors")
    sinks.write_lines(sinks.sparse_vector_lines(doc_term_counts(spark, sf), "doc_id", docs=documents(spark, sf)), path)
    return readers.read_lines(spark, path)


@query("vocabulary_text", f"""
    SELECT term || ':' || (row_number() OVER (ORDER BY term) - 1) AS value FROM ({_VOCAB_SQL})""")
def vocabulary_text(spark, sf):
    path = scratch_path(spark, "vocabulary")
    sinks.write_lines(sinks.vocabulary_lines(_indexed_vocab(spark, sf)), path)
    return readers.read_lines(spark, path)


@query("stemmed_vocab")
def stemmed_vocab(spark, sf):
    words = documents(spark, sf).select(F.explode(_lower_tokens()).alias("term"))
    return T.stem_vocab(words, "term", stem)


@query("tfidf_weights", f"""
    WITH tok AS ({_TFIDF_TOKENS}), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
         v AS (SELECT term, ln((1 + n.n) / (1 + df)) + 1 AS idf FROM (
             SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1), n WHERE df >= 8 AND df < 0.95 * n.n),
         raw AS (SELECT doc_id, term, (1 + ln(c)) * idf AS w FROM (SELECT doc_id, term, count(*) AS c FROM tok GROUP BY 1, 2)
                 JOIN v USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def tfidf_weights(spark, sf):
    return document_tfidf(spark, sf).withColumn("weight", F.round("weight", 6))


def document_tfidf(spark, sf, min_df=8):
    docs = documents(spark, sf)
    tokens = docs.select("doc_id", F.explode(X.regex_tokens(F.lower("text"), X.TFIDF_PATTERN)).alias("term"))
    n_docs = T.document_count(table(spark, sf, "documents"))
    return T.tfidf(T.term_counts(tokens, "doc_id", "term"), "doc_id", "term", n_docs, min_df)


@query("social_clean", """
    SELECT conv_id, turn, md5(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(
        '@user' || conv_id || ' hi ' || text || ' see https://x.example/' || turn || '?a=1',
        '@[^ \\n]* ', '', 'g'), 'https?://.+$', '', 'g'), '[^\\w\\s]', ' ', 'g')), '[0-9]', '', 'g')) AS cleaned
    FROM conversations""")
def social_clean(spark, sf):
    post = F.concat(F.lit("@user"), F.col("conv_id").cast("string"), F.lit(" hi "), F.col("text"),
                    F.lit(" see https://x.example/"), F.col("turn").cast("string"), F.lit("?a=1"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(X.clean_social(post)).alias("cleaned"))


@query("concat_by_owner", """
    SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS body FROM (
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS t FROM conversations GROUP BY 1)""")
def concat_by_owner(spark, sf):
    joined = T.concat_by(table(spark, sf, "conversations"), "conv_id", "turn", "text")
    return joined.select("conv_id", "part", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("body"))


@query("vocab_size", f"""
    SELECT d.doc_id, count(DISTINCT w) AS n_words FROM documents d
    LEFT JOIN (SELECT doc_id, w FROM ({_WORDS}) WHERE w <> '') x ON d.doc_id = x.doc_id GROUP BY 1""")
def vocab_size(spark, sf):
    return documents(spark, sf).select(
        "doc_id", X.vocab_size(F.translate("text", "\r\n", "  ")).cast("bigint").alias("n_words"))
