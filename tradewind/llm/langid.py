"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords: the letter runs of the text in lower case,
each with a boundary mark on either side, give their marked 2- to 4-grams and the whole word,
hashed into 2**bits buckets. Embeddings and softmax are trained together by stochastic gradient
descent in numpy.

A softmax is sure of one of its languages on any text, so its probability is weighed with how
familiar the text's subwords are: the mean log frequency of their buckets in the language found,
as a deviation from what held-back documents of it show at the text's length. The score is the
product. A share of the sample is held back to fit the softmax's temperature, the deviations, and the
score below which a prediction is rejected: that which ``REJECT_SHARE`` of them fall below.

The model is fitted on a bounded sample (``per_language`` documents of every language): tasks write
bucket counts, at most 2**bits of them per document, never texts, and one task trains on them. The
driver gets the model alone. Scoring goes over whole texts.
"""

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import vectext as V
from tradewind.llm.sampling import sample_by_label
from tradewind.sinks.shared import shared_dir

UNDETERMINED = "und"
PER_LANGUAGE = 1200
BITS = 15
SIZE = 16
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
HELD_BACK = 5
# characters of the texts that a task looks at together: its arrays are some dozen times as large
TASK_CHARS = 1 << 17
# of documents like the sample's, at most this share is rejected
REJECT_SHARE = 0.001


@dataclass
class LanguageModel:
    """``table``: for every bucket its embedding times the softmax weights, one row a language.

    ``often`` has the log frequencies of the buckets. ``usual`` has for each language the mean of
    a document's mean log frequency, its variance between documents and that of single subwords.
    """

    languages: "list[str]"
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    bits: int
    often: np.ndarray
    usual: np.ndarray
    edge: float

    def familiarity(self, place: np.ndarray, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Deviations of texts of ``n`` subwords with these mean log frequencies."""
        middle, between, single = self.usual[place].T
        return (mean - middle) / np.sqrt(between + single / np.maximum(n, 1))

    def weight(self, deviation: np.ndarray) -> np.ndarray:
        """A half at the edge of what the language's documents show, nearly 1 well above it."""
        return 1 / (1 + np.exp(-np.clip(2 * (deviation - self.edge), -60, 60)))


def _unfitted(bits: int) -> LanguageModel:
    none = np.zeros((0, 1 << bits))
    return LanguageModel([], none, np.zeros(0), 1.0, 0.0, bits, none, np.zeros((0, 3)), 0.0)


def subwords(texts: "list[str]", bits: int) -> "list[tuple[np.ndarray, np.ndarray]]":
    """For each kind of subword: (buckets, the text of each), texts in order.

    Every text is followed by a mark, and one stands before the first, so a window whose inner
    places are letters never holds letters of two texts.
    """
    points, at = V.code_points([t + "\n" for t in texts])
    points = np.concatenate([np.zeros(1, dtype=np.uint32), points])
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))])
    letter, small = V.letters(points)
    values = V.mixed(np.where(letter, small, np.uint32(0)))
    kinds = []
    for n in GRAMS:
        total = len(values) - n + 1
        if n == 2:
            where = np.flatnonzero(letter[:-1] | letter[1:])
            mine = owner[where + ~letter[where]]
        else:
            inner = letter[1 : 1 + total].copy()
            for k in range(2, n - 1):
                inner &= letter[k : k + total]
            where = np.flatnonzero(inner)
            mine = owner[where + 1]
        kinds.append((V.gram_buckets(values, n, bits, n)[where], mine))
    start, end = V.runs(letter, np.array([0, len(letter)]))
    words = V.run_hashes(values, start, end)
    kinds.append(((words >> np.uint64(64 - bits)).astype(np.int64), owner[start]))
    return kinds


def _kind(bits: int) -> str:
    """The smallest numbers that hold a bucket."""
    return "<u2" if bits <= 16 else "<u4"


def _counts(bits: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            rows = []
            for text, label in zip(frame["text"], frame["label"]):
                bucket = np.concatenate([b for b, _ in subwords([text], bits)])
                if len(bucket):
                    used, count = np.unique(bucket, return_counts=True)
                    kind = _kind(bits)
                    rows.append((label, used.astype(kind).tobytes(), count.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["label", "bucket", "n"])

    return run


def fit(labelled: DataFrame, key: str = "doc_id", seed: int = 17, **sizes) -> LanguageModel:
    """A model of the languages in ``labelled`` (columns ``key, text, lang``).

    Null languages and texts without a letter are passed over. With no usable row the model knows
    no language and every prediction is undetermined. ``sizes``: per_language, bits, size, epochs.
    """
    per_language = sizes.get("per_language", PER_LANGUAGE)
    bits, size = sizes.get("bits", BITS), sizes.get("size", SIZE)
    sample = sample_by_label(
        labelled.filter(F.col("text").isNotNull()).select(key, "text", "lang"),
        key,
        "lang",
        per_language,
    ).select(F.col("lang").alias("label"), "text")
    spark = labelled.sparkSession
    written = shared_dir(spark, "language-sample")
    sample.mapInPandas(_counts(bits), "label string, bucket binary, n binary").write.parquet(written)
    epochs = sizes.get("epochs", EPOCHS)
    trained = (
        spark.read.parquet(written)
        .coalesce(1)
        .mapInPandas(_trainer(bits, size, epochs, seed), "model binary")
        .collect()
    )
    return pickle.loads(trained[0]["model"]) if trained else _unfitted(bits)


def _trainer(bits: int, size: int, epochs: int, seed: int):
    """A task that trains on the whole sample, in an order that does not depend on other tasks."""

    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        rows = [r for frame in frames for r in zip(frame["label"], frame["bucket"], frame["n"])]
        rows.sort()
        model = train(rows, bits, size, epochs, seed) if rows else _unfitted(bits)
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    return run


def train(
    rows: "list[tuple[str, bytes, bytes]]", bits: int, size: int, epochs: int, seed: int
) -> LanguageModel:
    """The model of (language, buckets, counts) of sampled documents."""
    languages = sorted({label for label, _, _ in rows})
    place = {name: i for i, name in enumerate(languages)}
    target = np.array([place[label] for label, _, _ in rows])
    used = [np.frombuffer(b, dtype=_kind(bits)) for _, b, _ in rows]
    count = [np.frombuffer(n, dtype="<u4") for _, _, n in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(used))
    back, front = order[::HELD_BACK], np.setdiff1d(order, order[::HELD_BACK])
    if not len(front):
        back, front = order, order
    embedding = rng.uniform(-1 / size, 1 / size, (1 << bits, size))
    weight, bias = np.zeros((size, len(languages))), np.zeros(len(languages))
    # long texts and short ones: the step is for a text, so a language with few rows is seen as often
    often = 1.0 / np.bincount(target[front], minlength=len(languages)).clip(1)
    often = often / often[target[front]].mean()
    steps, step = epochs * len(front), 0
    for _ in range(epochs):
        for i in rng.permutation(front):
            rate = RATE * (1 - step / steps) * often[target[i]]
            share = count[i] / np.float32(count[i].sum())
            hidden = share @ embedding[used[i]]
            z = hidden @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            back_hidden = weight @ p
            weight -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            # a mean of many buckets moves each of them little; scaled by the largest share
            embedding[used[i]] -= np.outer(rate * share / share.max(), back_hidden)
            step += 1
    table = np.ascontiguousarray((embedding @ weight).T)
    logits = np.array(
        [table[:, used[i]] @ (count[i] / np.float32(count[i].sum())) + bias for i in back]
    )
    temperature = _temperature(logits, target[back])
    known = np.ones((len(languages), 1 << bits))
    for i in front:
        known[target[i], used[i]] += count[i]
    known = np.log(known / known.sum(axis=1, keepdims=True))
    model = LanguageModel(
        languages, table.astype(np.float32), bias, temperature, 0.0, bits,
        known.astype(np.float32), _usual(known, used, count, target, back, len(languages)), 0.0,
    )
    p = _softmax(logits / temperature)
    best = p.argmax(axis=1)
    n = np.array([count[i].sum() for i in back])
    mean = np.array([known[k, used[i]] @ count[i] for k, i in zip(best, back)]) / n
    deviation = model.familiarity(best, mean, n)
    model.edge = float(np.quantile(deviation, REJECT_SHARE))
    scores = p[np.arange(len(back)), best] * model.weight(deviation)
    model.least = float(np.quantile(scores, REJECT_SHARE))
    return model


def _usual(known, used, count, target, back, languages: int) -> np.ndarray:
    """``LanguageModel.usual`` from the held-back documents; a language without any is like all."""
    total = np.array([count[i].sum() for i in back], dtype=float)
    sums = np.array([known[target[i], used[i]] @ count[i] for i in back])
    squares = np.array([np.square(known[target[i], used[i]]) @ count[i] for i in back])
    out = np.zeros((languages, 3))
    for k in range(languages):
        mine = target[back] == k
        if not mine.any():
            mine[:] = True
        n, mean = total[mine], sums[mine] / total[mine]
        middle = sums[mine].sum() / n.sum()
        single = squares[mine].sum() / n.sum() - middle**2
        # what the lengths don't explain of the spread between documents
        between = max(float(np.mean((mean - middle) ** 2 - single / n)), 1e-4)
        out[k] = middle, between, single
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature under which the held-back languages are likeliest."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.001, 100, 101):
        p = _softmax(logits / t)[np.arange(len(target)), target]
        best = min(best, (-np.log(np.maximum(p, 1e-12)).mean(), float(t)))
    return best[1]


def score_texts(model: LanguageModel, texts: "list[str]") -> "tuple[np.ndarray, np.ndarray]":
    """(place of the likeliest language or -1, its probability weighed with the text's familiarity)."""
    place = np.full(len(texts), -1)
    score = np.zeros(len(texts))
    for begin, end in V.batches(texts, TASK_CHARS):
        n = end - begin
        if not model.languages:
            break
        count = np.zeros(n)
        z = np.zeros((n, len(model.languages)))
        kinds = subwords(texts[begin:end], model.bits)
        for bucket, owner in kinds:
            if not len(owner):
                continue
            # texts are in order, so each text's part is one run
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            mine = owner[first]
            count[mine] += np.diff(np.append(first, len(owner)))
            for k, row in enumerate(model.table):
                z[mine, k] += np.add.reduceat(row[bucket], first, dtype=np.float64)
        known = count > 0
        z = z / np.maximum(count, 1)[:, None] + model.bias
        p = _softmax(z / model.temperature)
        best = p.argmax(axis=1)
        mean = np.zeros(n)
        for bucket, owner in kinds:
            mean += np.bincount(owner, model.often[best[owner], bucket], minlength=n)
        fits = model.weight(model.familiarity(best, mean / np.maximum(count, 1), count))
        place[begin:end] = np.where(known, best, -1)
        score[begin:end] = np.where(known, p[np.arange(n), best] * fits, 0.0)
    return place, score


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language"
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``code, score, rejected``.

    A null text, an empty one and one without a letter are ``und`` with score 0 and rejected. A
    text is rejected if its score is below the calibrated one. Ties go to the first code.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("code string, score double, rejected boolean")
    def language(texts: "Iterator[pd.Series]") -> "Iterator[pd.DataFrame]":
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], dtype=object)
        for column in texts:
            place, score = score_texts(known, column.fillna("").tolist())
            yield pd.DataFrame(
                {
                    "code": names[place],
                    "score": score,
                    "rejected": (place < 0) | (score < known.least),
                }
            )

    return docs.withColumn(out, language(F.col(text)))
