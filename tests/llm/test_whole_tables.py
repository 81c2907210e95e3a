"""The registered queries without SQL, over their whole tables, against plain Python."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.test_llm import components_by_force
from tests.llm.test_queries import SF_DIR
from tradewind.llm.queries import LLM_QUERIES, vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


def result(spark, name):
    return LLM_QUERIES[name](spark, SF_DIR).collect()


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op1_finds_nine_of_ten_nearest_with_exact_scores(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float64)
    at = {v: i for i, v in enumerate(ids.tolist())}
    found = defaultdict(list)
    for r in result(spark, "op1_ann"):
        found[r["query_id"]].append(r)
    assert set(found) == {v for v in ids.tolist() if v % 100 == 0}
    hits = 0
    for query, mine in found.items():
        distance = np.sqrt(np.square(vectors - vectors[at[query]]).sum(axis=1))
        distance[at[query]] = np.inf
        want = np.lexsort((ids, distance))[:10]
        mine.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        for r in mine:
            assert r["score"] == pytest.approx(distance[at[r["vec_id"]]], rel=1e-12)
        order = [(r["score"], r["vec_id"]) for r in mine]
        assert order == sorted(order)
        hits += len({r["vec_id"] for r in mine} & set(ids[want].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_op3_gives_the_components_of_all_pairs(spark, docs):
    want = components_by_force([d["text"] for d in docs], 4, 80)
    ids = [d["doc_id"] for d in docs]
    found = {r["doc_id"]: r for r in result(spark, "op3_neardup")}
    assert len(found) == len(docs)
    for doc_id, (n, root) in zip(ids, want):
        r = found[doc_id]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, ids[root], doc_id == ids[root])


def test_op4_packs_every_documents_ids_without_gaps(spark, docs):
    model = Tokenizer.from_file(vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result(spark, "op4_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for d in docs:
        ids = model.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        mine = sorted(pieces[d["doc_id"]], key=lambda r: r["piece"])
        cut = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in mine] == [
            (i, 4096 * i, len(c), zlib.crc32(struct.pack(f"<{len(c)}I", *c))) for i, c in enumerate(cut)
        ]
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 4096
    # minimum bin slack leaves hardly a sequence over the least possible number
    assert len(sequences) <= -(-total // 4096) + 1


@pytest.mark.parametrize(
    "name, label, bound", [("op2_toxicity", "toxic", 0.5), ("op6_quality", "quality", 0.3)]
)
def test_classifiers_tell_held_out_labels(spark, docs, labels, name, label, bound):
    rows = {r["doc_id"]: r for r in result(spark, name)}
    assert len(rows) == len(docs)
    right, held = defaultdict(int), defaultdict(int)
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (remainder(d["doc_id"], 5) == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= bound)
        known = labels.get(d["doc_id"])
        if known is not None and known[label] is not None:
            held[known[label]] += 1
            right[known[label]] += r["predicted"] == known[label]
    # each class by itself, as one is rare
    assert all(right[k] >= 0.8 * held[k] for k in held), (right, held)


def test_op10_tells_held_out_languages(spark, docs):
    rows = {r["doc_id"]: r for r in result(spark, "op10_language")}
    held = [d for d in docs if remainder(d["doc_id"], 4) == 2]
    assert len(rows) == len(docs) and all(rows[d["doc_id"]]["held_out"] for d in held)
    assert sum(r["held_out"] for r in rows.values()) == len(held)
    right = sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right >= 0.97 * len(held)
    for d in docs:
        if not any(c.isalpha() for c in d["text"] or ""):
            assert rows[d["doc_id"]]["lang_pred"] == "und"


def test_pipeline_keeps_one_of_each_group_and_every_clean_document(spark, docs, tmp_path):
    import corpus_pipeline

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    single = stages["near_duplicates"](spark, table, SF_DIR).select("doc_id").collect()
    want = components_by_force([d["text"] for d in docs], 5, 80)
    ids = [d["doc_id"] for d in docs]
    kept = {r["doc_id"] for r in single}
    groups = defaultdict(list)
    for doc_id, (n, root) in zip(ids, want):
        groups[root].append(doc_id)
    assert all(len(kept & set(g)) == 1 for g in groups.values()) and len(kept) == len(groups)
    clean = stages["secrets"](spark, table, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in clean) == ids
    text = {d["doc_id"]: d["text"] for d in docs}
    spans = {r["doc_id"]: r["spans"] for r in result(spark, "op8_secrets")}
    for r in clean:
        assert (r["text"] == text[r["doc_id"]]) == (spans[r["doc_id"]] == "")
