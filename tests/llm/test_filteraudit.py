"""Filter audit against plain Python: the transducer on odd texts, every order on a small table."""

import random
import re
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewind.llm import filteraudit

WORD = "[^\x20\x09-\x0d]+"


def counts_by_force(text):
    words = re.findall(WORD, text)
    capitals, symbols = re.findall("[A-Z]", text), re.findall("[#$%&*|]", text)
    return len(words), len(set(words)), len(text), len(capitals), len(symbols)


def found_counts(array):
    found = filteraudit.measure(array)
    return list(zip(*[found[c].tolist() for c in filteraudit.COUNTS]))


@pytest.mark.parametrize("batch, block", [(50, 7), (1 << 22, 1 << 20)])
def test_the_pass_counts_what_plain_python_counts(monkeypatch, batch, block):
    monkeypatch.setattr(filteraudit, "BATCH", batch)
    monkeypatch.setattr(filteraudit, "BLOCK", block)
    rng = random.Random(2)
    texts = ["".join(rng.choices(" \n\tabAB#é中\U0001f600|%", k=rng.randint(0, 60))) for _ in range(500)]
    texts += ["", " ", "a", "ab" * 40, "", "\x0b\x0c"]
    for kind in (pa.string(), pa.large_string()):
        array = pa.array(texts, kind).slice(1)
        assert found_counts(array) == [counts_by_force(t) for t in texts[1:]]
    assert found_counts(pa.array([], pa.string())) == []


def test_long_texts():
    texts = ["ab" * 2_000_000, "q A " * 800_000, "x"]
    assert found_counts(pa.array(texts)) == [counts_by_force(t) for t in texts]


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    # all spans of a length share a hash: only the bytes tell them apart
    monkeypatch.setattr(
        filteraudit, "run_hashes", lambda v, s, e: (e - s).astype("uint64")
    )
    texts = ["aa bb aa cc a b a", "bb bb", "cc"]
    assert found_counts(pa.array(texts)) == [counts_by_force(t) for t in texts]


def failed_by_force(rows):
    """Letters of the filters each (doc_id, text, lang) fails."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words, distinct, points, capitals, symbols = counts_by_force(text)
        same = [d for d, t, _ in rows if (t or "") == text and d is not None]
        smaller = any(doc is None or d < doc for d in same)
        tests = (words < 200, 100 * distinct < 50 * words, 100 * capitals > 3 * points, symbols, smaller)
        out.append({f for f, failed in zip("ABCDE", tests) if failed})
    return out


def audit_by_force(rows, quality, toxic):
    fails, out = failed_by_force(rows), {}
    for part in {r[2] or "" for r in rows}:
        here = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = here
            for step, own in enumerate(order, 1):
                removed = [(d, f) for d, f in left if own in f]
                left = [(d, f) for d, f in left if own not in f]
                out[part, order, step] = [
                    len(left),
                    len(removed),
                    sum(own in f for _, f in here) - len(removed),
                    sum(f == {own} for _, f in here),
                    sum(d in quality for d, _ in removed),
                    sum(d in toxic for d, _ in removed),
                ]
        shapley = {own: 0 for own in "ABCDE"}
        for (p, order, step), row in out.items():
            if p == part:
                shapley[order[step - 1]] += row[1]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(spark, rows):
    # column names that the operator uses for its own
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(7) for c in ("key", "digest", "n", "pattern", "quality", "part")}
    )


def as_rows(found):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found.collect()}


def test_every_order_is_that_of_plain_python(spark):
    rng = random.Random(4)
    stock = [f"w{i}" for i in range(400)] + ["BIG", "a#b"]
    texts = [
        " ".join(rng.choices(stock[: rng.choice((30, 300, 402))], k=rng.choice((5, 150, 250))))
        for _ in range(25)
    ] + [None, "", "", " "]
    rows = [(rng.randrange(40), rng.choice(texts), rng.choice((None, "", "de", "en"))) for _ in range(150)]
    # repeated rows, rows without a key, and a text that a third of the rows share
    rows += rows[:10] + [(None, "only here", "de"), (None, texts[0], "en"), (None, None, None)]
    rows += [(1000 + i, texts[1], rng.choice(("de", "en"))) for i in range(80)]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1))) for i in range(0, 1100, 2)]
    labels += [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    found = filteraudit.audit(
        rows_of(spark, rows),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    quality = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    assert as_rows(found) == audit_by_force(rows, quality, toxic)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(rows_of(spark, [(1, "x", "de")]).limit(0), labels).collect() == []
    found = as_rows(filteraudit.audit(rows_of(spark, [(1, None, None)]), labels))
    assert len(found) == 600 and found["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
