"""Quality classifier: ordinal regression with a cumulative logit link on hashed text.

``P(grade <= k) = sigmoid(threshold_k - w . x)`` with one weight vector for all grades and ordered
thresholds. Features are hashed strings: each distinct word of the whole text (lower case), its
first five letters if it is longer, and bands of a few shares of the text (capitals, punctuation,
repeated words, one-word share, separators). Presence counts, so a long text does not dilute a word.

The model is fitted in the driver on at most ``MAX_LABELLED`` labelled rows, chosen by a hash of
their id, with FTRL (adaptive steps, L1), which leaves words without effect at weight 0. Scoring
reads every whole text in place, without a shuffle.

Cases: null text is scored like empty text; without any labelled row every text gets the top grade
with probability 1; a label row with unknown grade is ignored; of several labels the lowest counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.llm.frames import fresh, map_rows, sampled

MAX_LABELLED = 24_000
BITS = 18
EPOCHS = 8
STEP, L1, L2 = 0.3, 2.0, 1e-3
ACCEPT = 0.5
TOKEN = re.compile(r"\w+")


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one fewer than grades

    def below(self, latent: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each k but the last, one row per latent score."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - latent[:, None], -60, 60)))


def _band(name: str, share: float) -> str:
    return f"\x00{name}{min(9, int(share * 10))}"


def features(text: str | None) -> np.ndarray:
    """Sorted hashed feature numbers of a whole text."""
    text = text or ""
    tokens = TOKEN.findall(text.lower())
    distinct = set(tokens)
    names = distinct | {"\x01" + w[:5] for w in distinct if len(w) > 5}
    chunks = text.split()
    n, letters = max(1, len(chunks)), max(1, len(text) - text.count(" "))
    marks = sum(map(text.count, "!#$%&*|"))
    names.add(_band("capital", sum(map(str.isupper, chunks)) / n))
    names.add(_band("marks", marks / n))
    names.add(_band("bars", text.count("|") / n))
    names.add(_band("distinct", len(distinct) / max(1, len(tokens))))
    names.add(_band("runs", sum(a == b for a, b in zip(chunks, chunks[1:])) / n))
    names.add(_band("digits", sum(map(text.count, "0123456789")) / letters))
    names.add(f"\x00size{len(tokens).bit_length()}")
    mask = (1 << BITS) - 1
    return np.unique(np.fromiter((crc32(w.encode("utf-8", "replace")) & mask for w in names), np.int32, len(names)))


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 toxic, 1 poor, 2 good; null where the labels leave it open."""
    q, t = F.col(quality), F.col(toxic)
    return F.when(t == 1, 0).when(q == 0, 1).when((q == 1) & (t == 0), 2)


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_LABELLED) -> Model:
    """Fit on documents with a row ``(doc_id, grade)`` in ``ratings``; grades run from 0 to ``grades - 1``."""
    kind = dict(docs.dtypes)[doc_id]
    ratings = ratings.where(f"{doc_id} IS NOT NULL AND grade BETWEEN 0 AND {grades - 1}")
    ratings = ratings.groupBy(F.col(doc_id).alias("_id")).agg(F.min("grade").cast("int").alias("_grade"))
    ratings = sampled(ratings, max_rows, ratings.count(), "_id", salt=3)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    labelled = rows.join(F.broadcast(ratings), "_id")  # at most about max_rows short rows
    found = map_rows(
        labelled, lambda r: {"_id": r["_id"], "_grade": r["_grade"], "_x": [features(t).tobytes() for t in r["_text"]]}, f"_id {kind}, _grade int, _x binary"
    ).collect()
    found.sort(key=lambda r: (r["_id"], r["_grade"], r["_x"]))
    return train([np.frombuffer(r["_x"], np.int32) for r in found], np.array([r["_grade"] for r in found], np.int64), grades)


def train(xs: list[np.ndarray], ys: np.ndarray, grades: int) -> Model:
    """FTRL over the rows in a seeded order; thresholds take plain steps and stay ordered."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)
    if not len(ys):
        return Model(np.zeros(size), np.full(grades - 1, -60.0))
    share = np.clip(np.cumsum(np.bincount(ys, minlength=grades))[:-1] / len(ys), 0.01, 0.99)
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(grades - 1) * 1e-3)
    order = np.random.default_rng(5)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        w = -np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return w / ((1 + np.sqrt(n[at])) / STEP + L2)

    for epoch in range(EPOCHS):
        for i in order.permutation(len(ys)):
            x, y = xs[i], int(ys[i])
            w = weights(x)
            s = w.sum()
            cum = np.concatenate(([0.0], 1 / (1 + np.exp(-np.clip(thresholds - s, -60, 60))), [1.0]))
            g = 1 - cum[y] - cum[y + 1]  # derivative of -log P(y) by the latent score
            z[x] += g - (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / STEP * w
            n[x] += g * g
            p = max(cum[y + 1] - cum[y], 1e-9)
            rate = 0.02 / (1 + epoch)
            if y < grades - 1:
                thresholds[y] += rate * cum[y + 1] * (1 - cum[y + 1]) / p
            if y > 0:
                thresholds[y - 1] -= rate * cum[y] * (1 - cum[y]) / p
            thresholds = np.maximum.accumulate(thresholds)
    return Model(weights(slice(None)), thresholds)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (or ``keep``) with ``expected_grade`` and ``p_top``, the probability of the top grade."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.thresholds))
    source = fresh(docs, "_text")

    def run(rows: dict[str, list]) -> dict[str, list]:
        m = shared.value
        latent = np.array([float(m.weights[features(t)].sum()) for t in rows[source]])
        below = m.below(latent)
        return {**{c: rows[c] for c in keep}, "expected_grade": (1 - below).sum(axis=1), "p_top": 1 - below[:, -1]}

    schema = T.StructType(list(docs.select(*keep).schema.fields)).add("expected_grade", "double").add("p_top", "double")
    return map_rows(docs.select(*keep, F.col(text).alias(source)), run, schema)


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose probability of the top grade is at least ``accept``."""
    model = fit(docs, labels.select(doc_id, grade().alias("grade")), doc_id=doc_id, text=text)
    scored = score(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns}), model, f"_in_{text}")
    return scored.where(F.col("p_top") >= accept).select(*[F.col(f"_in_{c}").alias(c) for c in docs.columns])
