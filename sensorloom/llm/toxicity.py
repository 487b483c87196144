"""Toxicity scores from confirmed toxic texts and unlabelled texts: non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import staged, text_or_empty

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Word weights of averaged linear classifiers; a text's score looks at which words occur in it."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -np.inf

    def score(self, text: str) -> float:
        if self.bias == -np.inf:
            return 0.0
        words = self.weights.keys() & set(WORD.findall(text.lower()))
        z = self.bias + sum(self.weights[w] for w in sorted(words))
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def train_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05,
               decay: float = 1e-4, tolerance: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by the non-negative positive-unlabelled risk with logistic loss.

    The risk of the negatives is what the unlabelled texts show less the class prior's share of positives. Where this
    estimate falls below -`tolerance`, which only overfitting can do, the step goes the other way on it.
    """
    size = positive.shape[1]
    theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    p = np.hstack([positive, np.ones((len(positive), 1), positive.dtype)])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1), unlabelled.dtype)])
    for step in range(1, rounds + 1):
        zp, zu = p @ theta, u @ theta
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        negative_gradient = su @ u / len(u) - prior * (sp @ p) / len(p)
        gradient = prior * ((sp - 1) @ p) / len(p) + negative_gradient if negative >= -tolerance else -negative_gradient
        gradient[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def held_out(doc_id: str | Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is a multiple of 5. Null ids are not held out."""
    of = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(of.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          positives: int = 3000, unlabelled: int = 6000, vocabulary: int = 128, least: int = 5, members: int = 3) -> Model:
    """Learn from labelled toxic texts and unlabelled texts of the rows that are not held out.

    At most `positives` toxic rows, in order of a hash of their id, and about `unlabelled` rows of any kind, by the
    same hash, are the training sample; equal texts count once. The class prior is the share of toxic rows
    among all labelled rows not held out. Features are the `vocabulary` words in at least `least` sampled texts
    whose share of texts differs most, in standard errors, between the two sides; these counts are made by Spark,
    and only word numbers of the bounded sample reach the driver. `members` classifiers, each trained on a
    part of the sample, are averaged. A label given twice counts as toxic if one of them is; null labels and ids are
    passed over. Without a toxic row, or with an empty table, the model scores 0 everywhere.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).groupBy(
        F.col(doc_id).alias("id")).agg(F.max(F.col(label)).alias("toxic"))
    n, toxic = marks.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    total = docs.count()
    if not toxic or not total:
        return Model()
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    chosen = marks.where("toxic = 1").orderBy(chance, "id").limit(positives).select("id")
    rows = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text"))
    seen = rows.where(chance < int(min(1.0, unlabelled / total) * (1 << 30))).select("text", F.lit(0).alias("positive"))
    known = rows.join(F.broadcast(chosen), "id", "left_semi").select("text", F.lit(1).alias("positive"))

    @F.pandas_udf("array<string>")
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted(set(WORD.findall(t.lower()))) for t in texts])

    sample = staged(known.union(seen).select("positive", F.sha2("text", 256).alias("digest"), words("text").alias("words"))
                    .dropDuplicates(["positive", "digest"]))
    sides = dict(sample.groupBy("positive").count().collect())
    if not sides.get(0) or not sides.get(1):
        return Model()
    counts = sample.select("positive", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u")).where(F.col("p") + F.col("u") >= least)
    share_p, share_u = (F.col("p") + 0.5) / (sides[1] + 1), (F.col("u") + 0.5) / (sides[0] + 1)
    weight = F.abs(F.ln(share_p / share_u)) / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("u") + 0.5))
    top = [r.word for r in counts.orderBy(F.desc(F.round(weight, 6)), "word").limit(vocabulary).select("word").collect()]
    number = {w: i for i, w in enumerate(top)}

    @F.pandas_udf("array<int>")
    def numbers(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            yield pd.Series([[number[w] for w in ws if w in number] for ws in lists])

    found = sample.orderBy("digest").select("positive", numbers("words").alias("at")).toPandas()
    x = np.zeros((len(found), len(top)), np.float32)
    for i, at in enumerate(found["at"]):
        x[i, at] = 1
    side = found["positive"].to_numpy() == 1
    prior = float(np.clip(toxic / n, 0.001, 0.9))
    parts = [_fold(x[side], k, members) for k in range(members)], [_fold(x[~side], k, members) for k in range(members)]
    trained = [train_nnpu(a, b, prior) for a, b in zip(*parts, strict=True)]
    theta = np.mean([w for w, _ in trained], axis=0)
    return Model({w: float(t) for w, t in zip(top, theta, strict=True)}, float(np.mean([b for _, b in trained])))


def _fold(rows: np.ndarray, k: int, members: int) -> np.ndarray:
    """All rows but every `members`-th, if that leaves any."""
    kept = rows[np.arange(len(rows)) % members != k]
    return kept if len(kept) else rows


def score(model: Model, text: str | Column = "text") -> Column:
    """Score of a whole text from 0 to 1, higher for likelier toxic; null counts as empty, and empty texts get the bias alone."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return of(text_or_empty(text))
