"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Severity has three ordered grades: 0 clean, 1 toxic, 2 strongly toxic. With one weight per feature and
one threshold per step, P(grade >= k) = sigmoid(x·w - t_k): the weights are shared across thresholds. The
expected severity is the sum of these probabilities.

Features are a text's lower-case words and their first bytes (so that an inflected insult is
known by its stem), as 64-bit hashes; their value is 1 + log(count). Chosen are those whose document
frequency differs most between toxic and clean labelled texts (by the root of the likelihood-ratio statistic).
The labels are binary, so the upper grade is set from them: a toxic text whose number of uses of toxic
features is above the median of toxic texts is grade 2.

The fit uses at most ``TRAIN_DOCUMENTS`` labelled documents, chosen by a hash of the id, equal texts once.
Document frequencies are counted by Spark; the driver gets at most ``MOST_FEATURES`` features and the
training rows reduced to them. Scoring covers the whole text of every row.

Defined cases: a null or empty text, or one without a known feature, has the base rate of such texts. Labels
without id or grade are left out; on contradicting labels toxic wins. Without both classes among the labels every
score is 0. Repeated rows are scored each. Other columns pass through. Empty tables stay empty.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm import textbytes
from basketlens.llm.ordered import bounded_sample
from basketlens.llm.registry import query, table

TRAIN_DOCUMENTS = 20_000
MOST_FEATURES = 20_000
STEM_BYTES = 5
LEAST_DOCUMENTS = 4
LEAST_GAIN = 4.5
STEPS = 600
RIDGE = 1e-5
REJECT_AT = 0.5  # probability of grade 1 or more


class OrdinalModel(NamedTuple):
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def probabilities(self, scores):
        """P(grade >= 1), P(grade >= 2) for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(scores)[:, None], -60, 60)))


# ---- features ---------------------------------------------------------------------------

def feature_hashes(data, offsets):
    """(hashes of words, of stems, text of each word) of a slice of texts."""
    starts, ends, first = textbytes.words(data, offsets)
    sums = textbytes.prefix_hash(textbytes.LOWER[data])
    whole = textbytes.span_hash(sums, starts, ends)
    stems = textbytes.span_hash(sums, starts, np.minimum(ends, starts + STEM_BYTES))
    stems = textbytes.mix(stems ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return whole, stems, np.repeat(np.arange(first.size - 1), np.diff(first))


def _document_features(batches):
    """(feature, toxic, n): in how many of a slice's texts a feature is."""
    for batch in batches:
        toxic = batch["toxic"].to_numpy(zero_copy_only=False)
        for low, data, offsets in textbytes.slices(batch["text"]):
            whole, stems, text = feature_hashes(data, offsets)
            for label in (0, 1):
                use = toxic[low:low + offsets.size - 1][text] == label
                pairs = np.stack([np.concatenate([whole[use], stems[use]]), np.concatenate([text[use]] * 2).astype(np.uint64)], axis=1)
                if not pairs.size:
                    continue
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs = pairs[order]
                new = np.ones(len(pairs), bool)
                new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
                found, n = np.unique(pairs[new, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(np.full(found.size, label, np.int32)), pa.array(n.astype(np.int64))],
                    ["feature", "toxic", "n"])


def _counts(column, features):
    """(text, place among the features, count) of the known features of each text."""
    for low, data, offsets in textbytes.slices(column):
        whole, stems, text = feature_hashes(data, offsets)
        both, texts = np.concatenate([whole, stems]), np.concatenate([text, text])
        at = np.minimum(np.searchsorted(features, both), features.size - 1)
        known = features[at] == both
        key, n = np.unique(texts[known] * features.size + at[known], return_counts=True)
        yield low, offsets.size - 1, key // features.size, key % features.size, n


def _training_rows(features):
    def run(batches):
        for batch in batches:
            for low, n, text, at, count in _counts(batch["text"], features):
                bounds = np.searchsorted(text, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch["toxic"].slice(low, n),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(count.astype(np.int32)))],
                    ["toxic", "at", "count"])
    return run


# ---- fit --------------------------------------------------------------------------------

def fit_ordinal(rows, columns, values, grades, n_features, steps=STEPS, ridge=RIDGE, rate=0.1):
    """(weights, thresholds) of the cumulative-link model, by full-batch Adam on sparse triples."""
    n, k = grades.size, int(grades.max())
    above = (grades[:, None] >= np.arange(1, k + 1)[None, :]).astype(float)
    base = np.clip(above.mean(axis=0), 1e-6, 1 - 1e-6)
    theta = np.concatenate([np.zeros(n_features), np.log((1 - base) / base)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, t = theta[:n_features], np.maximum.accumulate(theta[n_features:])
        score = np.bincount(rows, weights=w[columns] * values, minlength=n)
        p = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -60, 60)))
        # Probability of each grade is a difference of neighbouring steps.
        bounds = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        own = np.maximum(bounds[np.arange(n), grades] - bounds[np.arange(n), grades + 1], 1e-12)
        slope = bounds * (1 - bounds)
        upper, lower = slope[np.arange(n), grades] / own, slope[np.arange(n), grades + 1] / own
        by_score = (upper - lower) / n
        by_t = np.zeros(k)
        np.add.at(by_t, grades[grades > 0] - 1, -upper[grades > 0] / n)
        np.add.at(by_t, grades[grades < k], lower[grades < k] / n)
        slope_w = np.bincount(columns, weights=by_score[rows] * values, minlength=n_features) - ridge * w
        g = np.concatenate([slope_w, by_t])
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return theta[:n_features], np.maximum.accumulate(theta[n_features:])


def train(docs, labels, id_column="doc_id", text_column="text", most=TRAIN_DOCUMENTS):
    """The model, or None without labelled texts of both classes."""
    spark = docs.sparkSession
    # A bounded number of labels, so the broadcast has a fixed size.
    chosen = (labels.select(F.col(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")))
    chosen = bounded_sample(chosen, "id", most, 23)
    sample = (docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
              .join(F.broadcast(chosen), "id").select("text", "toxic")
              .groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("key"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None
    counted = (sample.mapInArrow(_document_features, "feature BIGINT, toxic INT, n BIGINT").groupBy("feature")
               .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                    F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")).where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS))
    # Signed root of the likelihood-ratio statistic, which also holds for rare features.
    seen, share = F.col("a") + F.col("b"), sizes[1] / (sizes[0] + sizes[1])
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    gain = F.sqrt(F.greatest(2 * (part(F.col("a"), seen * share) + part(F.col("b"), seen * (1 - share))), F.lit(0.0)))
    picked = (counted.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN)
              .orderBy(F.desc("gain"), "feature").limit(MOST_FEATURES).toPandas())
    if not len(picked):
        return None
    hashes = picked["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    features = hashes[order]
    toxic_only = (picked["a"] >= 9 * picked["b"]).to_numpy()[order]
    reduced = sample.mapInArrow(_training_rows(features), "toxic INT, at ARRAY<INT>, count ARRAY<INT>").toArrow()
    toxic = reduced["toxic"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    at, count = reduced["at"].combine_chunks(), reduced["count"].combine_chunks()
    rows = np.repeat(np.arange(toxic.size), np.diff(at.offsets.to_numpy()))
    columns, counts = at.flatten().to_numpy().astype(np.int64), count.flatten().to_numpy().astype(float)
    strong = np.bincount(rows, weights=counts * toxic_only[columns], minlength=toxic.size)
    grades = np.where(toxic == 1, 1 + (strong > np.median(strong[toxic == 1])), 0)
    weights, thresholds = fit_ordinal(rows, columns, 1 + np.log(counts), grades, features.size)
    return OrdinalModel(features, weights, thresholds)


def severity(text, model):
    """A column: struct(expected, at_least_1, at_least_2) of a text column."""
    kind = "STRUCT<expected: DOUBLE, at_least_1: DOUBLE, at_least_2: DOUBLE>"
    if model is None:
        return F.struct(*[F.lit(0.0).alias(c) for c in ("expected", "at_least_1", "at_least_2")])

    @F.arrow_udf(kind)
    def judge(column: pa.Array) -> pa.Array:
        scores = np.zeros(len(column))
        for low, n, texts, at, count in _counts(column, model.features):
            scores[low:low + n] = np.bincount(texts, weights=model.weights[at] * (1 + np.log(count)), minlength=n)
        p = model.probabilities(scores)
        p = np.concatenate([p, np.zeros((len(p), 2 - p.shape[1]))], axis=1)
        return pa.StructArray.from_arrays([pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, 1])],
                                          ["expected", "at_least_1", "at_least_2"])

    return judge(text)


def without_toxic(docs, model, text_column="text", at=REJECT_AT):
    """The rows that the model doesn't find toxic, all columns as they are."""
    name = "_severity"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, severity(F.col(text_column), model)).where(F.col(name)["at_least_1"] < at).drop(name)


@query("op5_toxicity")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    judged = docs.select("doc_id", severity(F.col("text"), model).alias("s"))
    return judged.select("doc_id", F.col("s.expected").alias("expected_severity"), F.col("s.at_least_1").alias("p_toxic"),
                         (F.col("s.at_least_1") >= REJECT_AT).alias("toxic"),
                         F.round("s.expected").cast("int").alias("grade"))
