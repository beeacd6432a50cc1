"""The registered queries on the smallest tables, beside plain versions of what each must return."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from topicflow.llm import quality, simhash, tokens
from topicflow.llm.queries import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def rows_of(spark, name):
    return {r["doc_id"]: r for r in queries()[name](spark, DATA).collect()}


def test_token_files_in_order_of_ids(spark, documents):
    found, t, start = rows_of(spark, "op4_token_files"), tokens.load(public_tokenizers.path("byte_bpe_50k.json")), 0
    for i in sorted(documents):
        ids = [*t.encode(documents[i], add_special_tokens=False).ids, 0]
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_fingerprints_and_their_components(spark, documents):
    found = rows_of(spark, "op5_simhash")
    prints = {i: simhash.fingerprint(t) & (2**64 - 1) for i, t in documents.items()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    label = {i: i for i in prints}
    for i in sorted(prints):
        for j in sorted(prints):
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if x == high else x for k, x in label.items()}
    assert {i: r["component_id"] for i, r in found.items()} == label


def test_scores_of_quality(spark, documents):
    found = rows_of(spark, "op9_quality")
    assert found.keys() == documents.keys()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    right = []
    for i, r in found.items():
        held_out = zlib.crc32(str(i).encode()) % 3 == 1
        assert r["held_out"] == held_out and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
        if held_out and i in labels:
            right.append(r["predicted"] == labels[i])
    assert np.mean(right) > 0.8


def test_margins_are_sums_of_tables():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 5))
    model = quality.fit_additive(x, (x[:, 0] * x[:, 1] > 0).astype(float), rounds=20)
    for row, margin in zip(x[:60], model.margin(x[:60]), strict=True):
        fine = [sum(v >= e for e in edges) for v, edges in zip(row, model.edges, strict=True)]
        coarse = [sum(v >= e for e in edges) for v, edges in zip(row, model.coarse, strict=True)]
        want = model.intercept + sum(t[k] for t, k in zip(model.tables, fine, strict=True)) + sum(t[coarse[i], coarse[j]] for i, j, t in model.pairs)
        assert margin == pytest.approx(want)


def test_language_model_beats_its_base_on_held_out_texts(spark):
    """On a thousand texts; the two hundred of the smallest tables teach it less than their word counts."""
    found = {r["doc_id"]: r for r in queries()["op1_lm_score"](spark, "/root/testdata/sf0.01").collect()}
    held = [r for r in found.values() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found.values())
    score, base = (sum(r[c] for r in held) / sum(r["n_tokens"] for r in held) for c in ("score", "base_score"))
    assert score > base + 0.1
