"""Spelling variants against plain Python over all words and all pairs."""

import random
import re
from binascii import crc32
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_queries import SF_DIR
from tradewind.llm import spelling
from tradewind.llm.queries import LLM_QUERIES

SMALL = str.maketrans(spelling.CAPITALS, spelling.SMALL)


def words_by_force(rows):
    counted = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= 2}


def variants_by_force(rows):
    """All pairs meet at what is left of them when one letter is gone."""
    n = words_by_force(rows)
    near = {w: set() for w in n}
    gaps = {}
    for w in n:
        for p in range(len(w)):
            gaps.setdefault((p, w[:p] + w[p + 1 :]), set()).add(w)
            if (short := w[:p] + w[p + 1 :]) in n:
                near[w].add(short)
                near[short].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w] or "", n.get(form[w]), root(w)) for w in n)


def found(df):
    return sorted(
        (r["word"], r["n"], r["n_near"], r["form"] or "", r["form_n"], r["root"]) for r in df.collect()
    )


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = found(LLM_QUERIES["op13_spelling"](spark, SF_DIR))
    assert got == variants_by_force([tuple(r) for r in docs]) and len(got) > 100


def edited(rng, word):
    p, c = rng.randrange(len(word)), rng.choice("abehnté")
    return rng.choice((word[:p] + word[p + 1 :], word[:p] + c + word[p + 1 :], word[:p] + c + word[p:]))


def typos(rng, words):
    """A text in which every word and words one or two edits away stand in different numbers."""
    line = []
    for i, w in enumerate(words):
        line += [w] * (60 // (i + 1) + 2)
        for _ in range(4):
            near = edited(rng, w)
            line += [near] * rng.randint(1, 4) + [edited(rng, near)] * 2
    rng.shuffle(line)
    return " ".join(line)


@pytest.mark.parametrize("region", [1, 7, spelling.REGION])
def test_crowded_regions_give_the_same(spark, region, monkeypatch):
    monkeypatch.setattr(spelling, "STATES", 16 if region < 10 else spelling.STATES)
    monkeypatch.setattr(spelling, "LETTERS", 40 if region < 10 else spelling.LETTERS)
    rng = random.Random(6)
    # words of one vector, so that a leaf is dealt out, and words that differ in length
    words = ["".join(rng.sample("enatioe", 7)) for _ in range(12)] + ["Élève" * 2, "thanedble", "aaaaaaa", "a" * 8]
    rows = [(1, typos(rng, words)), (2, typos(rng, words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = variants_by_force(rows)
    assert any(w[3] for w in want) and found(spelling.variants(docs, region=region)) == want


def test_chains_of_forms_lead_to_the_last(spark):
    chain = ["abcdefgh", "abcdefg", "abcdefgx", "abcdefxx"]
    text = " ".join(" ".join([w] * 2 * 10**i) for i, w in enumerate(chain))
    rows = [(None, text), (None, None), (3, ""), (4, "short words only"), (5, "1234567 --")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("word", "n", "form", "name", "run", "region")}
    )
    got = found(spelling.variants(docs))
    assert got == variants_by_force(rows)
    assert [g[5] for g in got if g[0] == chain[0]] in ([chain[3]], [chain[2]], [chain[1]])
    assert spelling.variants(docs.limit(0)).collect() == []


def test_long_runs_and_repeated_rows(spark):
    long = "ab" * 700
    rows = [(1, long)] * 2 + [(2, long + "c")] * 2 + [(3, "É" * 800)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(spelling.variants(docs)) == variants_by_force(rows)
    long = "ab" * 50_000
    assert crc32(f"9:{long}".encode()) % 31 and crc32(f"9:{long}c".encode()) % 31
    docs = spark.createDataFrame([(9, f"{long} {long}c")] * 2, "doc_id long, text string")
    got = {r["word"]: r["n_near"] for r in spelling.variants(docs).collect()}
    assert got == {long: 1, long + "c": 1}
