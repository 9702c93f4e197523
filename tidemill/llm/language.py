"""Language identification by the nearest of several TF-IDF centroids per language.

Texts are lower-cased, everything but letters is blank, and byte trigrams are hashed into a fixed number of
features. Document frequencies are counted over all training documents. The ``SAMPLE`` different texts per
language with the smallest hashes, all if there are fewer, are clustered by spherical k-means; copies of a text
count once, so a much-copied one moves neither centroids nor limits. A text gets the
language of the centroid with the highest cosine. It is rejected when that cosine is far below what
training texts with as many distinct trigrams reach, or when it has no letter at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, drop_stage
from .common import packed, uniform

FEATURES = 1 << 14
CLUSTERS = 4
SAMPLE = 1000           # different labelled texts per language the centroids are fitted on
ROUNDS = 8
CHUNK = 1 << 20         # bytes of a text that are counted at once
NEAREST = 200           # sample texts of about the same size that set its limit:
QUANTILE, SLACK = 0.01, 0.35    # texts below this share of their lowest hundredth are rejected
UNKNOWN = "und"

_BLANKED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def trigram_counts(text: str) -> np.ndarray:
    """How often each feature occurs in the whole text."""
    data = f" {text.lower()} ".encode("utf-8", "replace").translate(_BLANKED)
    counts = np.zeros(FEATURES, dtype=np.int64)
    for at in range(0, len(data) - 2, CHUNK):
        b = np.frombuffer(data[at:at + CHUNK + 2], dtype=np.uint8).astype(np.uint32)
        grams = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        grams = grams[grams != 0x202020]
        counts += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(18), minlength=FEATURES)
    return counts


def _weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that occur and their weights, of length 1."""
    found = np.flatnonzero(counts)
    w = (1 + np.log(counts[found])) * idf[found]
    return found, w / max(np.linalg.norm(w), 1e-12)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas: in how many documents each feature occurs; feature -1 counts the documents."""
    total, n = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            total += trigram_counts(text) > 0
        n += len(batch)
    yield pd.DataFrame({"feature": np.append(np.arange(FEATURES), -1), "n": np.append(total, n)})


def _cluster(idf: np.ndarray, clusters: int):
    """applyInPandas by language over its sample: centroids, and the cosine and size of every sample text."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("order")
        x, sizes = np.zeros((len(group), FEATURES), dtype=np.float32), []
        for i, text in enumerate(group["text"]):
            found, w = _weights(trigram_counts(text), idf)
            x[i, found] = w
            sizes.append(len(found))
        centroids = x[:clusters].copy()
        for _ in range(ROUNDS):
            nearest = (x @ centroids.T).argmax(axis=1)
            for j in range(len(centroids)):
                mean = x[nearest == j].sum(axis=0)
                if mean.any():
                    centroids[j] = mean / np.linalg.norm(mean)
        cosines = (x @ centroids.T).max(axis=1)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "centroids": [centroids.tobytes()],
                             "cosines": [cosines.astype(float).tolist()], "sizes": [sizes]})
    return run


def _limits(cosines: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least cosine accepted for each power of two of distinct trigrams.

    It follows from the sample texts nearest in size; what larger texts reach is scaled down by the square root.
    """
    limits, level = np.zeros(32), np.log2(np.maximum(sizes, 1))
    for i in range(32):
        near = np.argsort(np.abs(level - i), kind="stable")[:NEAREST]
        scaled = cosines[near] * np.minimum(1.0, np.sqrt(2.0 ** (i - level[near])))
        limits[i] = SLACK * np.quantile(scaled, QUANTILE)
    return limits


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        clusters: int = CLUSTERS) -> dict:
    """Centroids and rejection limits from the rows with a language and a letter in their text.

    The model is small whatever the input: features times clusters times languages.
    """
    letters = F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull()
    rows = labelled.filter(letters).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counted = rows.select("text").mapInPandas(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n"))
    df = np.zeros(FEATURES + 1, dtype=np.int64)
    for feature, n in counted.collect():        # one row per feature
        df[feature] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    keyed = rows.withColumn("order", uniform("text", "lang"))
    different = cut_lineage(keyed.select("lang", "order").distinct())
    sizes = different.groupBy("lang").count().collect()      # one row per language
    if not sizes:
        return {"langs": [], "centroids": np.zeros((0, FEATURES), np.float32), "idf": idf, "limits": np.zeros(32)}
    # about twice as many as needed are ranked; fewer than needed have a chance below exp(-25)
    rate = F.element_at(F.create_map(*[F.lit(v) for lang, n in sizes for v in (lang, (2 * sample + 100) / n)]), F.col("lang"))
    least = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = different.filter(F.col("order") < rate).withColumn("at", least).filter(F.col("at") <= sample).drop("at")
    drawn = keyed.join(F.broadcast(chosen), ["lang", "order"]).groupBy("lang", "order").agg(F.min("text").alias("text"))
    fitted = drawn.groupBy("lang").applyInPandas(
        _cluster(idf, clusters), "lang string, centroids binary, cosines array<double>, sizes array<int>").collect()
    drop_stage(different)
    langs, parts = [], []
    for row in sorted(fitted, key=lambda r: r["lang"]):
        parts.append(np.frombuffer(bytes(row["centroids"]), dtype=np.float32).reshape(-1, FEATURES))
        langs += [row["lang"]] * len(parts[-1])
    limits = _limits(np.concatenate([r["cosines"] for r in fitted]), np.concatenate([r["sizes"] for r in fitted]))
    return {"langs": langs, "centroids": np.concatenate(parts), "idf": idf, "limits": limits}


def predict(text: Column, model: dict, spark) -> Column:
    """``lang_pred, score, rejected`` for a text: language, cosine from 0 to 1, and whether it is too far.

    ``und`` with score 0, rejected, for null and for texts without a letter, or if no language was learned.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        by_feature = np.ascontiguousarray(m["centroids"].T)
        for batch in batches:
            out = []
            for t in batch:
                if not m["langs"] or not has_letter(t):
                    out.append((UNKNOWN, 0.0, True))
                    continue
                found, w = _weights(trigram_counts(t), m["idf"])
                cosines = w.astype(np.float32) @ by_feature[found]
                best = int(cosines.argmax())
                score = float(min(max(cosines[best], 0.0), 1.0))
                limit = m["limits"][int(np.log2(max(len(found), 1)))]
                out.append((m["langs"][best], score, bool(score < limit)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])
    return nearest(text)


def drop_rejected(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is close enough to a learned language, with all their columns."""
    judged = docs.select(packed(docs), predict(F.col(text_col), model, docs.sparkSession).alias("language"))
    return judged.filter(~F.col("language.rejected")).select("row.*")
