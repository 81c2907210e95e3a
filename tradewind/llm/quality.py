"""Quality classifier: naive Bayes support vectors.

A text is the set of its character 1- to 3-grams, its word pairs and whether a word stands two or
three times in a row, hashed into 2**bits buckets (indicators, not counts). Each indicator is
scaled by its log-count ratio between the classes; on the scaled indicators a linear hinge-loss
model is fitted by dual coordinate descent. A logistic curve fitted on held-back margins turns
margins into scores.

The model is fitted on a bounded sample (``per_class`` labelled documents of each class): tasks
send bucket sets, at most 2**bits numbers per document, never texts. Scoring goes over whole texts.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import vectext as V
from tradewind.llm.sampling import sample_by_label

PER_CLASS = 2500
BITS = 16
GRAMS = (1, 2, 3)
COST = 0.1
EPOCHS = 12
HELD_BACK = 5


@dataclass
class QualityModel:
    """``weight`` of each bucket (ratio times hinge-loss weight), and the score's curve."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int


def indicators(text: str, bits: int) -> np.ndarray:
    """Buckets of the text's n-grams and word pairs, each once, in order."""
    points, at = V.code_points([text])
    seen = np.zeros(1 << bits, dtype=bool)
    values = V.mixed(points)
    for n in GRAMS:
        seen[V.gram_buckets(values, n, bits, n)] = True
    start, end = V.runs(~V.is_blank(points), at)
    words = V.run_hashes(values, start, end)
    seen[V.gram_buckets(words, 2, bits, 101)] = True
    # runs of one word, whichever it is
    same = words[1:] == words[:-1]
    seen[1] |= same.any()
    seen[2] |= (same[1:] & same[:-1]).any()
    return np.flatnonzero(seen)


def _features(bits: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            yield pd.DataFrame(
                {
                    "label": frame["label"],
                    "bucket": [indicators(t, bits).astype("<i4").tobytes() for t in frame["text"]],
                }
            )

    return run


def log_count_ratios(sets: "list[np.ndarray]", label: np.ndarray, bits: int) -> np.ndarray:
    """log of (share of the positive documents' indicators / share of the negative ones')."""
    positive, negative = np.ones(1 << bits), np.ones(1 << bits)
    for used, y in zip(sets, label):
        (positive if y else negative)[used] += 1
    return np.log(positive / positive.sum()) - np.log(negative / negative.sum())


def dual_coordinate_descent(
    sets: "list[np.ndarray]", ratio: np.ndarray, label: np.ndarray, cost: np.ndarray, rng, epochs
) -> "tuple[np.ndarray, float]":
    """Weights and bias of the hinge-loss model; one dual variable per document is solved at a time."""
    weight, bias = np.zeros(len(ratio)), 0.0
    sign = np.where(label == 1, 1.0, -1.0)
    dual = np.zeros(len(sets))
    square = np.array([np.square(ratio[s]).sum() + 1 for s in sets])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(sets)):
            used = sets[i]
            scaled = ratio[used]
            slope = sign[i] * (weight[used] @ scaled + bias) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), cost[i])
            change = (new - dual[i]) * sign[i]
            if change:
                dual[i] = new
                weight[used] += change * scaled
                bias += change
                moved = max(moved, abs(change))
        if moved < 1e-6:
            break
    return weight, bias


def _curve(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> "tuple[float, float]":
    """Slope and shift of the logistic curve, by Newton steps on smoothed targets."""
    positive, negative = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * (beta - [1.0, 0.0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        change = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    seed: int = 23,
    **sizes,
) -> QualityModel:
    """A model of ``label`` (0 or 1) from documents (``key, text``) and labels (``key, label``).

    Other labels and null texts are passed over. With one class or none, every score is the
    class's share (a half for none). ``sizes``: per_class, bits, epochs. The sample is drawn from
    the labels alone; it has about ``per_class`` rows a class, which is why it may be broadcast.
    """
    per_class, bits = sizes.get("per_class", PER_CLASS), sizes.get("bits", BITS)
    usable = labels.filter(F.col(label).isin(0, 1)).select(
        F.col(key).alias("labelled"), F.col(label).alias("label")
    )
    shares = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    sample = F.broadcast(sample_by_label(usable, "labelled", "label", per_class))
    rows = (
        docs.select(F.col(key).alias("key"), "text")
        .filter(F.col("text").isNotNull())
        .join(sample, F.col("key") == F.col("labelled"))
        .select("label", "text")
        .mapInPandas(_features(bits), "label int, bucket binary")
        .collect()
    )
    # row order depends on the tasks; the fit must not
    rows = sorted(rows, key=lambda r: (r["label"], bytes(r["bucket"])))
    y = np.array([r["label"] for r in rows])
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        shift = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return QualityModel(np.zeros(1 << bits), 0.0, 1.0, shift, bits)
    sets = [np.frombuffer(bytes(r["bucket"]), dtype="<i4") for r in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    back, front = order[::HELD_BACK], np.setdiff1d(order, order[::HELD_BACK])

    def fitted(index: np.ndarray) -> "tuple[np.ndarray, float]":
        part, mine = [sets[i] for i in index], y[index]
        ratio = log_count_ratios(part, mine, bits)
        cost = np.full(len(part), COST)
        weight, bias = dual_coordinate_descent(
            part, ratio, mine, cost, rng, sizes.get("epochs", EPOCHS)
        )
        return weight * ratio, bias

    slope, shift = 1.0, 0.0
    if len(set(y[front].tolist())) == 2 and len(set(y[back].tolist())) == 2:
        weight, bias = fitted(front)
        margin = np.array([weight[sets[i]].sum() + bias for i in back])
        # the sample has its own class shares, the curve is for those of all labelled rows
        of_class = np.array([shares[k] / max((y == k).sum(), 1) for k in (0, 1)])
        slope, shift = _curve(margin, y[back], of_class[y[back]] / of_class.max())
    weight, bias = fitted(np.arange(len(rows)))
    return QualityModel(weight.astype(np.float32), bias, slope, shift, bits)


def score_texts(model: QualityModel, texts: "list[str]") -> np.ndarray:
    """Score of each text, 0 to 1."""
    margin = np.array(
        [model.weight[indicators(t, model.bits)].sum(dtype=np.float64) for t in texts]
    )
    z = model.slope * (margin + model.bias) + model.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with a column ``score``: how likely label 1 is. Null texts score like empty ones.

    A column already named ``score`` is replaced; the others stay, repeated rows too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: "Iterator[pd.Series]") -> "Iterator[pd.Series]":
        for column in texts:
            yield pd.Series(score_texts(shared.value, column.fillna("").tolist()))

    return docs.withColumn("score", scored(F.col(text)))
