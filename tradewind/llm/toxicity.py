"""Toxic spans by a linear-chain conditional random field.

A text is the chain of its words (letter runs, lower case); each is ordinary or toxic. A word's
features are itself, its beginnings of 4 to 8 letters, its last 3, and its neighbours, hashed into
2**bits weights; neighbouring states are tied by transition weights. Forward-backward gives every
word's marginal; a document's score comes from its marginals, its offending offsets are the words
whose marginal is at least one half.

Labels are given for documents, the field needs them for words: a word of a toxic document is a
toxic token if itself or a beginning of it is found in many toxic documents of the sample and in
hardly any other. The field is then trained on those tokens and on all words of the others.

The model is fitted on a bounded sample (``per_class`` labelled documents of a class); scoring goes
over whole texts, in code that is vectorised over many chains.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import vectext as V
from tradewind.llm.sampling import sample_by_label

# by class: documents without toxic words tell which words are no signs, so there are more of them
PER_CLASS = {0: 1800, 1: 900}
BITS = 18
BEGINNINGS = (4, 5, 6, 7, 8)
# kinds of features of a word: itself, beginnings, ending, word before, word after
KINDS = 1 + len(BEGINNINGS) + 3
STEPS = 40
# a sign of toxicity is in so many toxic documents, and so much more often than in others; of the
# signs in a document, those count that are not much rarer than its most common one
SIGN_DOCS, SIGN_RATIO, SIGN_RARER = 3, 10.0, 4
_LIMIT = 30.0


@dataclass
class ToxicityModel:
    """``weight``: feature weights of the toxic state; ``bias``; ``tie``: log weights of
    (ordinary to toxic, toxic to ordinary, toxic to toxic, toxic at the start) against ordinary
    to ordinary; ``curve``: the score's logistic curve over a document's marginals."""

    weight: np.ndarray
    bias: float
    tie: np.ndarray
    curve: np.ndarray
    bits: int


@dataclass
class Words:
    """The words of some texts: place in the batch's characters, text, and feature buckets."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    feature: np.ndarray


def words_of(texts: "list[str]", bits: int) -> Words:
    points, at = V.code_points(texts)
    letter, small = V.letters(points)
    start, end = V.runs(letter, at)
    values = V.mixed(small)
    shift = np.uint64(64 - bits)
    feature = np.zeros((KINDS, len(start)), dtype=np.int32)
    whole = V.run_hashes(values, start, end)
    feature[0] = whole >> shift
    for k, n in enumerate(BEGINNINGS, 1):
        # a shorter word has its whole self as its beginning
        part = V.run_hashes(values, start, np.minimum(start + n, end))
        feature[k] = V.mix(part + np.uint64(n)) >> shift
    last = V.run_hashes(values, np.maximum(end - 3, start), end)
    feature[-3] = V.mix(last + np.uint64(50)) >> shift
    first = V.text_of_words(start, at)
    before = np.zeros(len(start), dtype=np.uint64)
    after = np.zeros(len(start), dtype=np.uint64)
    if len(start):
        before[1:], after[:-1] = whole[:-1], whole[1:]
        opens, closes = first[:-1], first[1:]
        some = closes > opens
        before[opens[some]] = 0
        after[closes[some] - 1] = 0
    feature[-2] = V.mix(before + np.uint64(60)) >> shift
    feature[-1] = V.mix(after + np.uint64(70)) >> shift
    return Words(start, end, first, feature)


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[i] = (a[i] * x[i-1] + b[i]) / (c[i] * x[i-1] + d[i]) with x[-1] = 1, in about 2 sqrt(n) steps.

    The chain is cut into parts that are gone through side by side: once to compose each part's
    steps into one, then, with every part's beginning known, to get the values.
    """
    n = len(a)
    if not n:
        return np.zeros(0)
    steps = max(1, int(np.sqrt(n)))
    parts = -(-n // steps)
    pad = parts * steps - n

    def laid(x: np.ndarray, fill: float) -> np.ndarray:
        return np.ascontiguousarray(np.append(x, np.full(pad, fill)).reshape(parts, steps).T)

    a, b, c, d = laid(a, 1.0), laid(b, 0.0), laid(c, 0.0), laid(d, 1.0)
    ca, cb, cc, cd = np.ones(parts), np.zeros(parts), np.zeros(parts), np.ones(parts)
    for i in range(steps):
        na, nb = a[i] * ca + b[i] * cc, a[i] * cb + b[i] * cd
        nc, nd = c[i] * ca + d[i] * cc, c[i] * cb + d[i] * cd
        scale = 1 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        ca, cb, cc, cd = na * scale, nb * scale, nc * scale, nd * scale
    begin, x = np.empty(parts), 1.0
    for p in range(parts):
        begin[p] = x
        x = (ca[p] * x + cb[p]) / max(cc[p] * x + cd[p], 1e-300)
        x = min(max(x, 1e-300), 1e300)
    out, x = np.empty((steps, parts)), begin
    for i in range(steps):
        x = np.clip((a[i] * x + b[i]) / np.maximum(c[i] * x + d[i], 1e-300), 1e-300, 1e300)
        out[i] = x
    return out.T.reshape(-1)[:n]


def forward_backward(
    odds: np.ndarray, first: np.ndarray, tie: np.ndarray
) -> "tuple[np.ndarray, np.ndarray]":
    """(forward, backward) ratios toxic : ordinary of every word.

    ``odds``: exp of a word's own score; ``first``: where each text's words begin (one more: the
    end). A word's marginal odds are forward times backward.
    """
    n = len(odds)
    to_toxic, to_plain, stay, begin = np.exp(tie)
    opens = np.zeros(n + 1, dtype=bool)
    opens[first] = True
    fresh = opens[:n]
    one = np.ones(n)
    forward = _scan(
        np.where(fresh, 0.0, stay * odds),
        odds * np.where(fresh, begin, to_toxic),
        np.where(fresh, 0.0, to_plain * one),
        one,
    )
    # backward: from the word after, whose own odds count; a text's last word begins at 1
    last = opens[1:]
    after = np.append(odds[1:], 1.0)[:n]
    backward = _scan(
        np.where(last, 0.0, stay * after)[::-1],
        np.where(last, 1.0, to_plain * one)[::-1],
        np.where(last, 0.0, to_toxic * after)[::-1],
        one,
    )[::-1]
    return forward, backward


def own_odds(model: ToxicityModel, feature: np.ndarray) -> np.ndarray:
    total = np.full(feature.shape[1], model.bias)
    for row in feature:
        total += model.weight[row]
    return np.exp(np.clip(total, -_LIMIT, _LIMIT))


def marginals(model: ToxicityModel, words: Words) -> np.ndarray:
    """Each word's probability to be toxic."""
    forward, backward = forward_backward(own_odds(model, words.feature), words.first, model.tie)
    odds = forward * backward
    return odds / (1 + odds)


def _document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: log odds of its likeliest word, log of one plus the expected toxic words, 1."""
    n = len(first) - 1
    most, total = np.zeros(n), np.zeros(n)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        most[some] = np.maximum.reduceat(p, first[:-1][some])
        total[some] = np.add.reduceat(p, first[:-1][some])
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.log(most / (1 - most)), np.log1p(total), np.ones(n)], axis=1)


def _features(bits: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            yield pd.DataFrame(
                {
                    "label": frame["label"],
                    "feature": [
                        words_of([t], bits).feature.astype("<i4").tobytes() for t in frame["text"]
                    ],
                }
            )

    return run


def toxic_tokens(features: "list[np.ndarray]", label: np.ndarray, bits: int) -> "list[np.ndarray]":
    """For every document, which of its words are toxic tokens."""
    kinds = slice(0, 1 + len(BEGINNINGS))
    counts = np.zeros((2, 1 << bits))
    for f, y in zip(features, label):
        counts[y, np.unique(f[kinds])] += 1
    toxic, plain = max((label == 1).sum(), 1), max((label == 0).sum(), 1)
    ratio = ((counts[1] + 0.25) / toxic) / ((counts[0] + 0.25) / plain)
    sign = np.where((counts[1] >= SIGN_DOCS) & (ratio >= SIGN_RATIO), counts[1], 0)
    out = []
    for f, y in zip(features, label):
        strength = sign[f[kinds]].max(axis=0, initial=0) if y else np.zeros(f.shape[1])
        most = strength.max(initial=0)
        out.append((strength > 0) & (strength * SIGN_RARER >= most))
    return out


def _train(feature: np.ndarray, first: np.ndarray, y: np.ndarray, bits: int) -> ToxicityModel:
    """Gradient steps with per-weight rates on the chains' log-likelihood."""
    size = 1 << bits
    model = ToxicityModel(np.zeros(size), -2.0, np.array([-1.0, 0.0, 0.0, -1.0]), np.zeros(3), bits)
    speed, bias_speed, tie_speed = np.full(size, 1e-8), 1e-8, np.full(4, 1e-8)
    n = len(y)
    y = y.astype(float)
    opens = np.zeros(n + 1, dtype=bool)
    opens[first] = True
    inside = ~opens[1:n]
    seen = np.zeros(4)
    pair_before, pair_after = y[:-1][inside], y[1:][inside]
    seen[0] = ((1 - pair_before) * pair_after).sum()
    seen[1] = (pair_before * (1 - pair_after)).sum()
    seen[2] = (pair_before * pair_after).sum()
    begins = first[:-1][np.diff(first) > 0]
    seen[3] = y[begins].sum()
    used = np.zeros(size, dtype=bool)
    for row in feature:
        used[row] = True
    used = np.flatnonzero(used)
    for _ in range(STEPS):
        odds = own_odds(model, feature)
        forward, backward = forward_backward(odds, first, model.tie)
        p = forward * backward
        p = p / (1 + p)
        off = p - y
        gradient = np.zeros(size)
        for row in feature:
            gradient += np.bincount(row, weights=off, minlength=size)
        gradient[used] += 0.02 * model.weight[used]
        speed += gradient**2
        model.weight -= 0.5 * gradient / np.sqrt(speed)
        bias_speed += off.sum() ** 2
        model.bias -= 0.2 * off.sum() / np.sqrt(bias_speed)
        to_toxic, to_plain, stay, _ = np.exp(model.tie)
        f, b = forward[:-1][inside], (odds * backward)[1:][inside]
        cells = np.stack([to_toxic * b, to_plain * f, stay * f * b])
        cells /= 1 + cells.sum(axis=0)
        expected = np.append(cells.sum(axis=1), p[begins].sum())
        move = expected - seen + 0.1 * model.tie
        tie_speed += move**2
        model.tie -= 0.2 * move / np.sqrt(tie_speed)
    return model


def _curve(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on a document's features, by Newton steps."""
    beta = np.array([0.5, 0.5, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + 0.05 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        change = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        beta = beta - change
        if np.abs(change).max() < 1e-8:
            break
    beta[:2] = np.maximum(beta[:2], 0)
    return beta


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", **sizes
) -> ToxicityModel:
    """A field from documents (``key, text``) and document labels (``key, label``, 0 or 1).

    Other labels and null texts are passed over; without rows of both classes every score is the
    toxic class's share (a half for none). ``sizes``: per_class, bits. The sample is drawn from the
    labels alone; it has about ``per_class`` rows a class, which is why it may be broadcast.
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
        .mapInPandas(_features(bits), "label int, feature binary")
        .collect()
    )
    # row order depends on the tasks; the fit must not. Each part is held once
    rows = [(r["label"], bytes(r["feature"])) for r in rows]
    rows.sort()
    y = np.array([label for label, _ in rows], dtype=int)
    none = ToxicityModel(np.zeros(1 << bits), -_LIMIT, np.zeros(4), np.zeros(3), bits)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        none.curve = np.array([0.0, 0.0, np.log((share + 1e-6) / (1 - share + 1e-6))])
        return none
    features = [np.frombuffer(bits, dtype="<i4").reshape(KINDS, -1) for _, bits in rows]
    tokens = toxic_tokens(features, y, bits)
    # a toxic document without a toxic token tells nothing about its words
    train = [i for i in range(len(rows)) if y[i] == 0 or tokens[i].any()]
    joined = np.concatenate([features[i] for i in train], axis=1)
    first = np.append(0, np.cumsum([features[i].shape[1] for i in train]))
    model = _train(joined, first, np.concatenate([tokens[i] for i in train]), bits)
    del joined
    first = np.append(0, np.cumsum([f.shape[1] for f in features]))
    odds = np.concatenate([own_odds(model, f) for f in features])
    forward, backward = forward_backward(odds, first, model.tie)
    p = forward * backward / (1 + forward * backward)
    of_class = np.array([shares.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)])
    model.curve = _curve(_document_features(p, first), y, of_class[y] / of_class.max())
    model.weight = model.weight.astype(np.float32)
    return model


def score_texts(
    model: ToxicityModel, texts: "list[str]"
) -> "tuple[np.ndarray, list[list[tuple[int, int]]]]":
    """(score of each text, its toxic spans as (start, end) in code points, neighbours joined)."""
    scores = np.empty(len(texts))
    spans: "list[list[tuple[int, int]]]" = [[] for _ in texts]
    for begin, end in V.batches(texts):
        part = texts[begin:end]
        words = words_of(part, model.bits)
        p = marginals(model, words)
        z = _document_features(p, words.first) @ model.curve
        scores[begin:end] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        hits = np.flatnonzero(p >= 0.5)
        if len(hits):
            at = np.append(0, np.cumsum([len(t) for t in part]))
            owner = np.searchsorted(words.first, hits, side="right") - 1
            previous = -2
            for w, t in zip(hits.tolist(), owner.tolist()):
                mine = spans[begin + t]
                s, e = int(words.start[w] - at[t]), int(words.end[w] - at[t])
                if mine and previous == w - 1:
                    mine[-1] = (mine[-1][0], e)
                else:
                    mine.append((s, e))
                previous = w
    return scores, spans


def tag(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``toxicity``: ``score, spans`` (array of start, end).

    Null and empty texts have no words: no span, and the score the curve gives to that. Words of a
    text form one chain, however long it is. A column already named ``toxicity`` is replaced; the
    others stay, repeated rows too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, spans array<struct<start:int,end:int>>")
    def tagged(texts: "Iterator[pd.Series]") -> "Iterator[pd.DataFrame]":
        for column in texts:
            scores, spans = score_texts(shared.value, column.fillna("").tolist())
            yield pd.DataFrame(
                {
                    "score": scores,
                    "spans": [[{"start": s, "end": e} for s, e in x] for x in spans],
                }
            )

    return docs.withColumn("toxicity", tagged(F.col(text)))
