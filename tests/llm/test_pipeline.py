"""The pipeline, stage by stage, on the smallest tables and on odd rows."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from topicflow.llm import common, line_dedup, mixing, tokens
from topicflow.llm.queries import oracle_sql, queries
from topicflow.llm.shingle_join import similar_components

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage put out, by name; the input under "documents"."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(root / name))
        out[name] = docs = spark.read.parquet(str(root / name))
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "mixing", "bpe"]
    for name in ("quality", "line_dedup", "simhash", "mixing"):
        assert stages[name].dtypes == stages["documents"].dtypes
    assert stages["bpe"].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_rejects_what_is_labelled_low(spark, stages):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = stages["quality"].join(labels, "doc_id").groupBy("quality").count().collect()
    n = {r["quality"]: r["count"] for r in kept}
    all_ = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert n[1] >= 0.98 * all_[1] and n.get(0, 0) <= 0.2 * all_[0]


def test_lines_are_those_of_the_operator(stages):
    cut = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(stages["quality"]).collect()}
    kept = {r["doc_id"]: r for r in stages["line_dedup"].collect()}
    assert all(r["text"] == cut[i] for i, r in kept.items())
    assert all(not cut[i].strip() for i in cut.keys() - kept.keys())
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())


def near_groups(texts, least=0.8):
    """Components of texts whose sets of five-word shingles are alike, by comparing all pairs."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if least * max(len(a), len(b)) <= min(len(a), len(b)) and len(a & b) >= least * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_one_of_each_near_group_stays(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages["line_dedup"].collect())
    label = near_groups([t for _, t in rows])
    want = sorted(rows[min(k for k, x in enumerate(label) if x == g)][0] for g in set(label))
    assert sorted(r["doc_id"] for r in stages["simhash"].collect()) == want


def test_near_copies_do_not_depend_on_what_is_broadcast(spark, stages):
    docs = stages["line_dedup"].select(F.col("doc_id").alias("id"), "text")
    few, all_ = (Counter(r["component_id"] for r in similar_components(docs, most_broadcast=n).collect()) for n in (0, 1 << 20))
    assert few == all_


def test_copies_are_those_of_the_mix(stages):
    want = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(stages["simhash"]).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in stages["mixing"].collect()) == want


def test_tokens_are_the_library_s(stages):
    t = tokens.load(public_tokenizers.path("word_bpe_49k.json"))
    import hashlib

    want = Counter((r["doc_id"], hashlib.sha256(np.array(t.encode(r["text"] or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for r in stages["mixing"].collect())
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in stages["bpe"].collect()) == want


def test_run_gives_the_last_stage(spark, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, DATA).collect())) == Counter(map(tuple, stages["bpe"].collect()))


def test_a_run_leaves_one_table_behind(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "workspace", lambda spark, name: f"file://{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}-{random.random()}")
    corpus_pipeline.run(spark, DATA).count()
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["mixing"]


def test_stages_on_odd_rows(spark, docs, none):
    docs = docs.withColumn("clash", F.lit(1))
    for stage in (corpus_pipeline.lines, corpus_pipeline.near_copies, corpus_pipeline.mix):
        assert stage(spark, docs, DATA).columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, docs, DATA).count() > 0
        assert stage(spark, none, DATA).count() == 0
    assert corpus_pipeline.quality(spark, docs, DATA).columns == list(corpus_pipeline.COLUMNS)
    assert corpus_pipeline.quality(spark, none, DATA).count() == 0 and corpus_pipeline.encode(spark, none, DATA).count() == 0
    assert corpus_pipeline.encode(spark, docs, DATA).count() == docs.count()
    mixed = mixing.mix_sources(docs).agg(F.sum("copies")).first()[0]
    assert corpus_pipeline.mix(spark, docs, DATA).count() == mixed


def test_texts_with_null_or_shared_ids_stay_apart(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (5, text(3)), (5, text(4)), (9, text(4)), (None, text(3))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, docs, DATA).collect())
    assert found == Counter(rows[:5])


def test_near_copies_are_found_in_every_band(spark):
    """Two texts of each pair as similar as a band says: one stays from 0.8 up, both below it."""
    rng, rows, pairs = random.Random(6), [], []
    for k in range(320):
        base = [f"w{rng.randrange(40_000)}" for _ in range(rng.choice([12, 90, 300]))]
        other = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 8])):
            other[rng.randrange(len(other))] = f"v{rng.randrange(40_000)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, other))
        pairs.append(len(a & b) / len(a | b))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, DATA).select("doc_id").collect()}
    for low, high in ((0.0, 0.7), (0.7, 0.8), (0.8, 0.85), (0.85, 0.9), (0.9, 0.95), (0.95, 1.01)):
        band = [k for k, j in enumerate(pairs) if low <= j < high]
        assert len(band) >= 5
        assert sum(2 * k + 1 in left for k in band) == (len(band) if high <= 0.8 else 0), (low, high)
    assert left >= {2 * k for k in range(320)}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_workspace_is_in_the_shared_folder(spark):
    first = common.workspace(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != common.workspace(spark, "x")


def test_near_copies_come_from_simhash_first(spark, stages, monkeypatch):
    """The stage takes SimHash's pairs, drops those that the shingles refuse, and has the join find the others: the result is the same."""
    given, join = [], corpus_pipeline.similar_components

    def seen(docs, **more):
        given.append(more["found"].count())
        return join(docs, **more)

    monkeypatch.setattr(corpus_pipeline, "similar_components", seen)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, stages["line_dedup"], DATA).collect())
    assert given[0] > 0 and kept == sorted(r["doc_id"] for r in stages["simhash"].collect())
    docs = stages["line_dedup"].select(F.col("doc_id").alias("id"), "text")
    ids = sorted(r["id"] for r in docs.collect())
    odd = spark.createDataFrame([(ids[0], i) for i in ids[1:40]] + [(ids[3], ids[0]), (ids[5], ids[5]), (ids[5], 10**12)], "a long, b long")
    groups = lambda **more: Counter((r["id"], r["component_id"]) for r in similar_components(docs, **more).collect())
    assert len(set(groups(found=odd).values())) == 1 and groups(found=odd).keys() == groups().keys()
