"""Token counts against the libraries' own, on whole tables, odd characters and edge cases."""

import random

import pytest
import sentencepiece
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_queries import SF_DIR
from tradewind.llm import tokencount
from tradewind.llm.queries import LLM_QUERIES, vocabulary

# blanks, marks, letters with several normal forms, digits of three kinds, contractions,
# special strings whole and in parts
ODD = [
    *" \n\t\x0b\x0c\r\x85 ̸́​aEIBe5<|>.!",
    *["É", "İ", "Σ", "²", "½", "ｱ", "각", "ᄀ", "ᅡ"],
    *["'s", "'ll", "中", "\U0001f600", "\x00", "<|endoftext|>", "<|startoftext|>", "<|", "|>"],
]


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(vocabulary())
    return lambda texts: [
        len(e.ids) for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ]


def test_query_gives_the_librarys_counts(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in LLM_QUERIES["op12_token_counts"](spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for doc, n in zip(docs, library([d["text"] for d in docs])):
        assert tuple(found[doc["doc_id"]])[1:] == (len(doc["text"].encode()), n, n > 2048)


@pytest.mark.parametrize("size", [5, tokencount.BATCH])
def test_cut_texts_have_the_counts_of_whole_ones(library, monkeypatch, size):
    monkeypatch.setattr(tokencount, "BATCH", size)
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(3000)]
    assert tokencount.count_texts(texts, len(texts), vocabulary()).tolist() == library(texts)


def test_pieces_are_the_text_and_bounded_where_a_boundary_is_near():
    text = "word 12 " * 5000
    pieces = list(tokencount.safe_pieces(text, 1000))
    assert "".join(pieces) == text and max(map(len, pieces)) < 1010
    assert list(tokencount.safe_pieces("x" * 5000, 100)) == ["x" * 5000]


def test_edge_rows(spark, library):
    long = "Some words, 12 of them; and more. " * 60_000
    texts = [None, "", "   ", "twice", "twice", long, "x" * 300_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = tokencount.token_counts(rows, vocabulary(), limit=2048).collect()
    assert sorted((r["doc_id"], *r["tokens"]) for r in found) == [
        (i, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, library(texts)))
    ]
    assert tokencount.token_counts(rows.limit(0), vocabulary()).collect() == []
    clash = rows.selectExpr("doc_id", "text", "1 AS n_tokens", "2 AS over_limit", "3 AS _n_tokens")
    kept = tokencount.token_counts(clash.limit(3), vocabulary(), limit=9)
    assert kept.columns == [*clash.columns, "tokens"] and kept.count() == 3
    assert str(kept._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") == 1
    plan = str(kept._jdf.queryExecution().executedPlan())
    assert plan[plan.index("ArrowEvalPython"):].split("\n")[0].count("counted(") == 1
    with pytest.raises(ValueError):
        tokencount.token_counts(rows.withColumnRenamed("doc_id", "tokens"), vocabulary())


def test_a_vocabulary_of_the_other_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["Hello  World, again", "", None, "中文 x <s>"]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = tokencount.token_counts(rows, path, whole=True).collect()
    want = [len(model.encode(t or "")) for t in texts]
    assert [r["tokens"]["n_tokens"] for r in found] == want
