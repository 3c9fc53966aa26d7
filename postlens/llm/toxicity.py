"""Toxicity by a classifier chain.

Categories are predicted one after another; a later linear model also gets the probabilities of the earlier categories. For
training these are out-of-fold predictions, so that a later model sees probabilities as unsure as those of new texts. Features are whether a
word, or a word's beginning, occurs: words of a language share stems, so beginnings recognise forms that no labelled text has.
Models are trained on a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import with_new
from .components import kept, tidy
from .words import Words, _CODES, extended, mix, pieces, powers

FEATURE_BITS = 20
#: Lengths of the beginnings in bytes, besides whole words.
BEGINNINGS = (4, 5, 6)
FOLDS = 3


@dataclass
class Link:
    """One category of the chain: weights of features (by number), of earlier categories' probabilities, the intercept, and
    the probability from which on the category is predicted."""

    category: str
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float
    threshold: float = 0.5


def feature_numbers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(number, document)`` of each feature of each word, repeats included."""
    up, down = powers(len(words.data) + 1)
    total = np.zeros(len(words.data) + 1, np.uint64)
    np.cumsum(_CODES[words.data] * up[:-1], out=total[1:])
    numbers, docs = [], []
    for length in (0, *BEGINNINGS):
        use = np.flatnonzero(words.end - words.begin >= length)
        begin = words.begin[use]
        end = begin + length if length else words.end[use]
        hashed = mix((total[end] - total[begin]) * down[begin] + np.uint64(length))
        numbers.append((hashed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        docs.append(words.doc[use])
    return np.concatenate(numbers), np.concatenate(docs)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the sorted distinct features of its text in place of the text, which is its last column."""
    for batch in pieces(batches):
        number, doc = feature_numbers(Words(batch.column("text")))
        both = np.unique((doc << FEATURE_BITS) | number)
        edges = np.searchsorted(both >> FEATURE_BITS, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array((both & ((1 << FEATURE_BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*batch.schema.names[:-1], "features"])


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str, text: str, rows: int) -> DataFrame:
    """``(id, fold, <categories>, text)`` of at most ``rows`` labelled ids, those of the least hash; an id has the largest of its labels."""
    own = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    own = own.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories]).dropna()
    own = own.orderBy(F.xxhash64("id"), "id").limit(rows).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int"))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    # A broadcast of at most ``rows`` rows of a few numbers each.
    return texts.join(F.broadcast(kept(own, "labelled")), F.col("doc") == F.col("id")).select("id", "fold", *categories, "text")


def select_features(sample: DataFrame, categories: list[str], most: int) -> dict[str, list[int]]:
    """For each category the ``most`` features with the largest chi-square, from five texts on; ties by number."""
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    each = sample.select(F.explode("features").alias("feature"), *categories)
    counts = each.groupBy("feature").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).where("n >= 5")
    counts = kept(counts, "features")
    found = {}
    for c in categories:
        share = (totals[c] or 0) / max(1, totals["n"])
        chi = (F.col(c) - F.col("n") * share) ** 2 / (F.col("n") * (1 - F.col("n") / (totals["n"] + 1)))
        found[c] = sorted(r["feature"] for r in counts.select("feature", chi.alias("chi")).orderBy(F.desc("chi"), "feature").limit(most).collect())
    return found


def best_threshold(probability: np.ndarray, label: np.ndarray) -> float:
    """The probability between two texts at which F1 is highest."""
    order = np.argsort(-probability, kind="stable")
    p, hits = probability[order], np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + label.sum())
    f1[:-1][p[:-1] == p[1:]] = 0  # texts of one probability stay together
    best = int(f1.argmax())
    return float((p[best] + p[min(best + 1, len(p) - 1)]) / 2)


@tidy
def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    id_col: str = "doc_id",
    text: str = "text",
    max_labelled: int = 20_000,
    max_features: int = 384,
) -> list[Link]:
    """The chain over ``categories``, in that order, trained on at most ``max_labelled`` labelled ids.

    A category is predicted from the probability on at which the out-of-fold predictions have the best F1. A category with one value only in the sample, or an empty sample, gets that constant probability (0.5 without rows).
    """
    rows = labelled_sample(docs, labels, categories, id_col, text, max_labelled)
    schema = extended(rows.drop("text").schema, "features array<int>")
    sample = kept(rows.mapInArrow(_featured, schema), "featured")
    selected = select_features(sample, categories, max_features)
    known = np.array(sorted({f for x in selected.values() for f in x}), np.int64)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat, edges = lists.flatten().to_numpy(), np.cumsum(np.append(0, lists.value_lengths().to_numpy()))
            at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
            hit = np.flatnonzero(known[at] == flat) if len(known) else np.zeros(0, np.int64)
            matrix = np.zeros((batch.num_rows, len(known)))
            matrix[np.searchsorted(edges, hit, "right") - 1, at[hit]] = 1
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, max(1, len(known)))[: batch.num_rows + 1], pa.int32()), pa.array(matrix.ravel())) if len(known) else pa.array([[]] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], vectors], [*batch.schema.names[:-1], "x"])

    matrix = kept(sample.mapInArrow(dense, extended(rows.drop("text").schema, "x array<double>")), "matrix")

    def fit(data: DataFrame, category: str):
        model = LogisticRegression(featuresCol="v", labelCol=category, regParam=0.0005, maxIter=30, tol=1e-4, standardization=False)
        return model.fit(data.withColumn("v", array_to_vector("x")))

    chain = []
    for i, category in enumerate(categories):
        n, positive = matrix.agg(F.count("*"), F.sum(category)).first()
        earlier = np.zeros(i)
        if not positive or positive == n:
            share = 0.5 if not n else float(min(max(positive / n, 1e-6), 1 - 1e-6))
            chain.append(Link(category, known[:0], np.zeros(0), earlier, float(np.log(share / (1 - share)))))
            matrix = matrix.withColumn("x", F.concat("x", F.array(F.lit(share))))
            continue
        model = fit(matrix, category)
        weights = model.coefficients.toArray()
        out_of_fold = None
        for fold in range(FOLDS):
            rest, own = matrix.where(F.col("fold") != fold), matrix.where(F.col("fold") == fold)
            if rest.agg(F.countDistinct(category)).first()[0] == 2:
                scored, probability = fit(rest, category).transform(own.withColumn("v", array_to_vector("x"))), vector_to_array("probability")[1]
            else:
                scored, probability = own, F.lit(float(positive / n))
            part = scored.withColumn("x", F.concat("x", F.array(probability))).select(matrix.columns)
            out_of_fold = part if out_of_fold is None else out_of_fold.unionByName(part)
        matrix = kept(out_of_fold, "chained")
        # At most ``max_labelled`` pairs of numbers.
        pairs = np.array([tuple(r) for r in matrix.select(F.element_at("x", -1), category).collect()])
        threshold = best_threshold(pairs[:, 0], pairs[:, 1])
        chain.append(Link(category, known, weights[: len(known)], weights[len(known) :], float(model.intercept), threshold))
    return chain


def score(docs: DataFrame, chain: list[Link], text: str = "text") -> DataFrame:
    """The rows of ``docs`` without ``text`` and with ``p_<category>`` and ``<category>_pred`` for each category of the chain.

    A null or empty text has no features and gets the probability that the intercepts give. Long texts are scored whole, equal ones alike.
    """
    return with_new(docs, (text,), lambda plain: _scored(plain, chain, text))


def _scored(docs: DataFrame, chain: list[Link], text: str) -> DataFrame:
    categories = [link.category for link in chain]
    names = [f"p_{c}" for c in categories] + [f"{c}_pred" for c in categories]
    others = [c for c in docs.columns if c.lower() != text.lower()]
    rows = docs.select(*others, F.col(text).alias("__text"))
    schema = extended(rows.drop("__text").schema, ", ".join([f"`p_{c}` double" for c in categories] + [f"`{c}_pred` boolean" for c in categories]))
    known = docs.sparkSession.sparkContext.broadcast(chain)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, used = [], np.zeros(1 << FEATURE_BITS, bool)
        for link in known.value:
            weights = np.zeros(1 << FEATURE_BITS)
            weights[link.features] = link.weights
            tables.append(weights)
            used[link.features] = True
        for batch in pieces(batches, "__text"):
            number, doc = feature_numbers(Words(batch.column("__text")))
            hit = used[number]
            both = np.unique((doc[hit] << FEATURE_BITS) | number[hit])
            number, doc = both & ((1 << FEATURE_BITS) - 1), both >> FEATURE_BITS
            found: list[np.ndarray] = []
            for link, weights in zip(known.value, tables, strict=True):
                value = link.intercept + np.bincount(doc, weights[number], minlength=batch.num_rows)
                for w, p in zip(link.earlier, found, strict=True):
                    value = value + w * p
                found.append(1 / (1 + np.exp(-np.clip(value, -500, 500))))
            found += [p >= link.threshold for p, link in zip(found, known.value, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], [*batch.schema.names[:-1], *names])

    return rows.mapInArrow(scored, schema)
