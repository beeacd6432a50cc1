"""Operators on documents beside plain versions of them, and on nulls, repeats and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicflow.llm import bpe, common, exact_dedup, line_dedup, lm_score, mixing, quality, simhash, token_files, tokens
from topicflow.llm.words import text_bytes, wide_hashes, words

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def lower(t):
    return (t or "").encode().lower()


def bag(rows):
    return Counter(tuple(r) for r in rows)


def components_of(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


# -- shared ----------------------------------------------------------------------------------


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 90)] + [(500, 500)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 90)}
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 10: exact dedup -------------------------------------------------------------------------


def test_exact_dedup(docs, none):
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r["text"])].append(r["doc_id"])
    want = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep) for i in ids)
    assert bag(exact_dedup.exact_dedup(docs).collect()) == want
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_tells_equal_lengths_and_prefixes_apart(spark):
    base = "p" * 400
    rows = spark.createDataFrame([(1, base + "a"), (2, base + "b"), (3, base + "A"), (4, "q" * 401)], "doc_id long, text string")
    found = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(rows).collect()}
    assert found == {1: 3, 2: 2, 3: 3, 4: 4}


# -- 3: mixing -------------------------------------------------------------------------------


def test_mixing_meets_targets(docs, none):
    rows = mixing.mix_sources(docs, carry=("source",)).collect()
    assert len(rows) == docs.count()
    sizes, targets, taken, largest = Counter(), {}, Counter(), Counter()
    for r in rows:
        s = r["source"]
        sizes[s] += r["size"]
        targets[s] = r["target"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1, 5], strict=False))
    total = sum(sizes.values())
    want = {s: 0.0 for s in sizes}
    left, open_ = float(total), set(sizes)
    while open_:
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > 3 * sizes[s]}
        for s in over or open_:
            want[s] = 3.0 * sizes[s] if over else share * weights[s]
        left -= sum(want[s] for s in over)
        open_ = open_ - over if over else set()
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1
    assert bag(mixing.mix_sources(docs.repartition(3), carry=("source",)).collect()) == bag(rows)
    assert mixing.mix_sources(none).count() == 0


def test_a_source_without_words(spark):
    rows = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "x y z", "b")], "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["source_size"], r["target"], r["taken"]) for r in mixing.mix_sources(rows).collect()}
    assert found[1] == (0, 0.0, 0) and found[3] == (3, 3.0, 3)


# -- 8: BPE ----------------------------------------------------------------------------------


def as_library(texts):
    t = tokens.load(WORD_BPE)
    found = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    return found, t.decode_batch(found, skip_special_tokens=False)


def test_bpe_equals_the_library(docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids, decoded = as_library([t for _, t in rows])
    want = bag((d, len(i), np.array(i, "<u4").tobytes(), x) for (d, _), i, x in zip(rows, ids, decoded, strict=True))
    for leaf in (32_768, 100):
        found = bpe.encode_documents(docs, WORD_BPE, decode=True, leaf_chars=leaf).collect()
        assert bag((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in found) == want
    alone = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE).collect()
    assert bag((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in alone) == want
    assert bpe.encode_documents(none, WORD_BPE).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'stre lmdvé!?0\n\t日J̌İ😀", max_size=80), st.integers(2, 20))
def test_halves_join_to_the_whole(text, leaf):
    normal = tokens.load(WORD_BPE).normalizer.normalize_str(text)

    def encode(t):
        x = bpe.library(WORD_BPE).encode(t, add_special_tokens=False)
        return np.array(x.ids, np.uint32), np.array(x.offsets, np.int64).reshape(-1, 2)

    found = bpe.join_tree([(h, *encode(h)) for h in bpe.halves(normal, leaf)], encode)
    want = encode(normal)
    assert found[1].tolist() == want[0].tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'stré !?0\n\t\x1c 日😀<|endoftext>", max_size=60))
def test_pieces_encode_as_the_whole(text):
    for path, keep in ((WORD_BPE, False), (BYTE_BPE, True)):
        want = tokens.load(path).encode(text, add_special_tokens=False).ids
        ids, sizes = tokens.encoder(path, keep).encode(*text_bytes(pa.array([text, "", text])))
        assert ids.tolist() == want + want and sizes.tolist() == [len(want), 0, len(want)]


def test_one_unsplit_word_of_many_leaves():
    rng = random.Random(2)
    text = "".join(rng.choice(["th", "an", "er", "ing", "e", "tion"]) for _ in range(8000))
    def encode(t):
        assert len(t) < 2000  # windows stay small
        x = bpe.library(WORD_BPE).encode(t, add_special_tokens=False)
        return np.array(x.ids, np.uint32), np.array(x.offsets, np.int64).reshape(-1, 2)

    found = bpe.join_tree([(h, *encode(h)) for h in bpe.halves(text, 500)], encode)[1].tolist()
    assert found == tokens.load(WORD_BPE).encode(text, add_special_tokens=False).ids


# -- 4: token files --------------------------------------------------------------------------


def test_token_files_round_trip(spark, docs, none, tmp_path):
    docs = docs.filter("doc_id is not null")
    token_files.write_tokens(docs, BYTE_BPE, str(tmp_path / "a"), frame_tokens=3000)
    t = tokens.load(BYTE_BPE)
    start, want = 0, Counter()
    for r in sorted(docs.collect(), key=lambda r: (r["doc_id"], r["text"] or "")):
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want[r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert spark.read.parquet(str(tmp_path / "a")).count() > 4
    assert bag(token_files.read_tokens(spark, str(tmp_path / "a"), {"c": F.crc32("ids")}).collect()) == want
    token_files.write_tokens(none, BYTE_BPE, str(tmp_path / "b"))
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1025, (1 << 18) + 5])
def test_frames(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_257).astype(np.uint32)
    frame = token_files.write_frame([None, 7], np.array([n // 2, n - n // 2]), ids)
    names, sizes, back = token_files.read_frame(frame)
    assert names == [None, 7] and sizes.tolist() == [n // 2, n - n // 2] and (back == ids).all()
    if n > 1 << 18:
        assert (token_files.read_frame(frame, range(1, 2))[2] == ids[1 << 18 :]).all()
    if n:
        damaged = bytearray(frame)
        damaged[-1] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            token_files.read_frame(bytes(damaged))


def test_frames_are_small():
    ids = np.random.default_rng(0).integers(0, 16, 1 << 18).astype(np.uint32)
    assert len(token_files.write_frame([1], np.array([len(ids)]), ids)) < len(ids) * 4 / 8 * 1.08


# -- 5: SimHash ------------------------------------------------------------------------------


def plain_fingerprint(t, n=4):
    w = lower(t).split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, none):
    docs = docs.filter("doc_id is not null")
    rows = sorted({(r["doc_id"], r["text"] or "") for r in docs.collect()})
    prints = [plain_fingerprint(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    label = components_of(len(rows), linked)
    want = {d: (p, rows[c][0]) for (d, _), p, c in zip(rows, prints, label, strict=True)}
    found = simhash.simhash_components(docs).collect()
    assert len(found) == docs.count()
    assert {r["doc_id"]: (r["fingerprint"] % (1 << 64), r["component_id"]) for r in found} == want
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("extra", [1, 2])
def test_links_in_chunked_nodes(spark, extra):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 60).tolist()
    for p in prints[:20]:
        for _ in range(6):
            for b in rng.integers(0, 63, rng.integers(1, 6)):
                p ^= 1 << int(b)
            prints.append(p)
    prints = list(dict.fromkeys(prints))
    rows = spark.createDataFrame(list(enumerate(prints)), "id long, print long")
    found = common.components(simhash.link_fingerprints(rows, extra=extra, group_rows=8)).collect()
    linked = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    label = components_of(len(prints), linked)
    assert {r["node"]: r["component"] for r in found} == {i: c for i, c in enumerate(label) if Counter(label)[c] > 1}


# -- 9: quality ------------------------------------------------------------------------------


def test_quality_learns_held_out_labels(spark, none):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["the", "house", "stands", "by", "a", "river", "and", "trees"]) for _ in range(60)) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "$$$", "click", "!!!"]) for _ in range(60))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0), 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    labels = docs.select("doc_id", "quality").filter("doc_id < 400").unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int"))
    model = quality.fit_quality(docs.select("doc_id", "text"), labels)
    scored = docs.filter("doc_id >= 400").select("quality", quality.quality_score(model, F.col("text")).alias("score")).collect()
    assert sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in scored) >= 0.98 * len(scored)
    odd = [r[0] for r in spark.createDataFrame([(None,), ("",), ("x" * 100_000,)], "text string").select(quality.quality_score(model, F.col("text"))).collect()]
    assert all(0 <= s <= 1 for s in odd) and odd[0] == odd[1]
    flat = quality.fit_quality(docs.select("doc_id", "text"), labels.filter("doc_id < 0"))
    assert flat.score(quality.features(["a", None])).tolist() == [0.5, 0.5]
    assert none.select(quality.quality_score(model, F.col("text"))).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == (y[3000:] == 1)).mean() > 0.95


# -- 7: line dedup ---------------------------------------------------------------------------


def prose(rng, n):
    return " ".join(("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) + ("." if k % 9 == 8 else "")) for k in range(n))


def test_planted_passages_go_and_clean_text_stays(spark, none):
    rng = random.Random(3)
    passage = prose(rng, 60)
    rows = []
    for i in range(12):
        own = prose(rng, 80), prose(rng, 80)
        rows.append((i, f"{own[0]} {passage} {own[1]}" if i % 3 == 0 else f"{own[0]}\n{own[1]}"))
    rows += [(50, rows[1][1]), (51, None), (52, ""), (53, " ")]
    found = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        if i in (3, 6, 9):
            assert passage[:200] not in found[i]["text"] and passage[-100:] not in found[i]["text"]
            assert abs(found[i]["removed_words"] - 60) <= 1 and found[i]["removed_runs"] == 1
        elif i == 50:
            assert found[i]["text"].strip() == "" and found[i]["removed_words"] == 160
        else:
            assert found[i]["text"] == (text or "") and found[i]["removed_words"] == 0
    assert line_dedup.line_dedup(none).count() == 0


def test_every_word_cut_stands_earlier(docs):
    docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    found = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    before: set[bytes] = set()
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        w = lower(r["text"]).split()
        seen_here = [b" ".join(w[i : i + 30]) for i in range(len(w) - 29)]
        covered: set[int] = set()
        for i, g in enumerate(seen_here):
            if g in before:
                covered.update(range(i, i + 30))
            before.add(g)
        assert found[r["doc_id"]]["removed_words"] <= len(covered)
        assert found[r["doc_id"]]["size"] == r["size"]


def prints_of(text):
    raw, bounds = text_bytes(pa.array([text]))
    return set(line_dedup.read_prints(raw, bounds)[2].tolist())


JOINS = {"one line": " ", "lines of one word": "\n", "commas": ", ", "sentences of one word": ". "}


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(sorted(JOINS)), st.integers(0, 2**32), st.integers(2, 60), st.integers(0, 40), st.integers(0, 40))
def test_a_run_of_the_guaranteed_length_shares_a_fingerprint(kind, seed, vocabulary, before, after):
    rng = random.Random(seed)
    run = [f"w{rng.randrange(vocabulary)}" for _ in range(line_dedup.GUARANTEED)]
    run = JOINS[kind].join(run)
    own = [" ".join(f"o{rng.randrange(1000)}" + rng.choice(["", "", "", ".", "\n"]) for _ in range(n)) for n in (before, after, after, before)]
    assert prints_of(f"{own[0]} {run} {own[1]}") & prints_of(f"{own[2]} {run} {own[3]}")


def test_most_runs_of_thirty_words_share_a_fingerprint():
    rng, found = random.Random(8), 0
    for i in range(400):
        run, own = prose(rng, 30), [prose(rng, rng.randint(5, 60)) for _ in range(4)]
        if i % 2:
            run = run.replace(".", "")
        found += bool(prints_of(f"{own[0]} {run} {own[1]}") & prints_of(f"{own[2]} {run} {own[3]}"))
    assert found >= 380


def repeats_of(rows, least):
    """The words of each text, in turn, that lie in a run of ``least`` words that also occurs earlier."""
    seen, out = set(), {}
    for i, text in rows:
        w = lower(text).split()
        grams = [tuple(w[k : k + least]) for k in range(len(w) - least + 1)]
        out[i] = set()
        for k, g in enumerate(grams):
            if g in seen:
                out[i].update(range(k, k + least))
            seen.add(g)
    return out


def test_repeated_runs_are_cut_in_full(spark, monkeypatch):
    """Passages of 50 words and more, in every kind of line, beside all runs that repeat by brute force."""
    rng = random.Random(5)
    lists = ["\n".join(f"{prose(rng, 1)} {prose(rng, 1)}" for _ in range(200)), "\n".join(prose(rng, 1) for _ in range(300))]
    passages = [*lists, *[prose(rng, n).replace(".", end) for n in (50, 70, 160) for end in (".", ",", "")], "\n".join(prose(rng, 1) for _ in range(60))]
    inner = prose(rng, 11) + "."  # also stands alone, before the passage that holds it
    passages.append(f"{prose(rng, 14).replace('.', '')} {inner} {prose(rng, 14).replace('.', '')}")
    rows = [(0, inner)]
    for i in range(3):
        for k, p in enumerate(passages):
            rows.append((len(rows), f"{prose(rng, 40)} {p} {prose(rng, 40)}" if (i + k) % 2 else f"{prose(rng, 12)}\n{p}\n{prose(rng, 33)}"))
    want = repeats_of(rows, 30)
    for most, hot in ((1 << 20, 2000), (0, 2000), (1 << 20, 1)):  # by a bitmap, by a join, all groups split
        monkeypatch.setattr(line_dedup, "HOT", hot)
        found = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), most_broadcast=most).collect()}
        cut = sum(r["removed_words"] for r in found.values())
        assert all(found[i]["removed_words"] <= len(want[i]) for i, _ in rows)
        assert cut >= 0.99 * sum(map(len, want.values())), (cut, sum(map(len, want.values())))
        for i, text in rows:
            kept = [w for k, w in enumerate(lower(text).split()) if k not in want[i]]
            if found[i]["removed_words"] == len(want[i]):
                assert lower(found[i]["text"]).split() == kept


def test_short_repeats_that_meet_stay(spark):
    """Two sentences from two texts, side by side, repeat nothing as one run."""
    rng = random.Random(9)
    sentence = [prose(rng, 19).replace(".", "") + "." for _ in range(3)]
    one, two = (f"{prose(rng, 30)}. {s} {prose(rng, 30)}" for s in sentence[:2])
    rows = [(1, one), (2, two), (3, f"{prose(rng, 20)}. {sentence[0]} {sentence[1]} {prose(rng, 20)}"), (4, f"{sentence[1]} {sentence[0]}")]
    for least in (20, 30):
        found = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=least).collect()
        assert {r["doc_id"]: (r["text"], r["removed_words"]) for r in found} == {i: (t, 0) for i, t in rows}
    spans = [(1, 0, 12), (2, 12, 31), (1, 12, 15)]
    cut = lambda s: line_dedup.cut_spans(" ".join(map(str, range(40))), tuple(np.array(s).T), 20)
    assert cut(spans)[1:] == (0, 0)
    assert cut([*spans, (1, 14, 22)]) == (" ".join(map(str, range(22, 40))), 22, 1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(-2, 2), st.integers(0, 50), st.integers(1, 20)), max_size=12), st.integers(1, 25))
def test_spans_are_put_together_within_a_run(spans, least):
    words = {g: {w for r, a, n in spans if r == g for w in range(a, a + n)} for g, _, _ in spans}
    cut = set()
    for g, held in words.items():
        for w in sorted(held):
            end = w
            while end in held:
                end += 1
            begin = w
            while begin - 1 in held:
                begin -= 1
            if end - begin >= least:
                cut |= set(range(begin, end))
    text = " ".join(map(str, range(80)))
    arrays = tuple(np.array([(r, a, a + n) for r, a, n in spans], np.int64).reshape(-1, 3).T)
    left, removed, _ = line_dedup.cut_spans(text, arrays, least)
    assert [int(w) for w in left.split()] == [w for w in range(80) if w not in cut] and removed == len(cut)


def test_many_texts_are_cut_at_once():
    """Each text loses its own runs, also where one ends with a run and the next begins with one."""
    spans = lambda *x: tuple(np.array(x, np.int64).reshape(-1, 3).T)
    texts = ["a b é d ", "e  f\ng h", "", "i j", "k l m n o"]
    given_ = [spans((1, 2, 4)), spans((1, 0, 1), (1, 1, 2)), spans(), spans((1, 0, 1), (2, 1, 2)), spans((5, 3, 5), (4, 0, 2))]
    left, words_cut, runs_cut = line_dedup.cut_texts(texts, given_, 2)
    assert left == ["a b ", "g h", "", "i j", "m "]
    assert (words_cut.tolist(), runs_cut.tolist()) == ([2, 2, 0, 0, 4], [1, 1, 0, 0, 2])


def test_no_document_loses_more_than_what_repeats(spark):
    """All documents of a whole table beside all runs of thirty words that repeat by brute force; and how many are found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = repeats_of(rows, 30)
    found = {r["doc_id"]: r["removed_words"] for r in line_dedup.line_dedup(docs).collect()}
    assert [i for i in want if found[i] > len(want[i])] == []
    assert sum(found.values()) >= 0.97 * sum(map(len, want.values()))


@pytest.mark.parametrize("n, least", [(30, 0.93), (40, 0.97), (52, 1.0)])
def test_recall_of_passages(spark, n, least):
    """Passages that occur twice in other text: the share that is cut, whole but for a few outer words."""
    rng = random.Random(n)
    rows, passages = [], [prose(rng, n) for _ in range(150)]
    for k in range(2):
        for i, p in enumerate(passages):
            rows.append((1000 * k + i, f"{prose(rng, rng.randint(5, 60))} {p if i % 2 else p.replace('.', '')} {prose(rng, rng.randint(5, 60))}"))
    found = {r["doc_id"]: r["removed_words"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), min_words=min(n, 30)).collect()}
    assert not any(found[i] for i in range(len(passages)))
    assert np.mean([found[1000 + i] >= 0.9 * n for i in range(len(passages))]) >= least


# -- 1: LM scoring ---------------------------------------------------------------------------


def test_base_scores_and_held_out_gain(spark, docs, none):
    held = common.id_remainder(F.col("doc_id"), 7) == 2
    rows = lm_score.lm_scores(docs, ~held, WORD_BPE, frequent=50).collect()
    given_ = docs.withColumn("held", held).collect()
    assert len(rows) == len(given_)
    counts = Counter(w for r in given_ if not r["held"] for w in lower(r["text"]).split())
    counts["\0end"] = sum(not r["held"] for r in given_)
    n, v = sum(counts.values()), len(counts)
    want = defaultdict(list)
    for r in given_:
        w = [*lower(r["text"]).split(), "\0end"]
        want[r["doc_id"]].append((len(w), sum(counts[x] > 0 for x in w), sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    for r in rows:
        assert any((r["n_tokens"], r["n_known"]) == x[:2] and r["base_score"] == pytest.approx(x[2]) for x in want[r["doc_id"]])
        assert r["train_tokens"] == n and np.isfinite(r["score"]) and r["score"] < 0
    assert lm_score.lm_scores(none, ~held, WORD_BPE).count() == 0
    nobody = lm_score.lm_scores(docs.limit(3), F.lit(False), WORD_BPE).collect()
    assert all(r["n_known"] == 0 and np.isfinite(r["score"]) for r in nobody)


def test_scores_do_not_depend_on_what_is_broadcast(spark, docs):
    held = common.id_remainder(F.col("doc_id"), 7) == 2
    few, all_ = ({(r["doc_id"], r["n_tokens"], r["n_known"]): r["score"] for r in lm_score.lm_scores(docs, ~held, WORD_BPE, frequent=n).collect()} for n in (50, 100_000))
    assert few == {k: pytest.approx(v) for k, v in all_.items()}


def test_scores_do_not_depend_on_partitions(spark, docs, monkeypatch):
    """Shards of few ids, so that there are several in a round."""
    monkeypatch.setattr(lm_score, "SHARD", 4000)
    held = common.id_remainder(F.col("doc_id"), 7) == 2
    rows = docs.select("doc_id", "text")
    one, four = ([r["score"] for r in lm_score.lm_scores(rows.repartition(n), ~held, WORD_BPE).orderBy("doc_id", "n_tokens", "score").collect()] for n in (1, 4))
    assert one == pytest.approx(four, rel=1e-6)


def test_ids_are_kept_as_they_are(spark, docs):
    found = lm_score.encode_ids(docs.select(F.lit(0).cast("long").alias("lot"), F.lit(1).cast("long").alias("order"), F.coalesce("text", F.lit("")).alias("text")), WORD_BPE).coalesce(1)
    end, t = lm_score.vocabulary_size(WORD_BPE), tokens.load(WORD_BPE)
    kept = Counter()
    for ids, heads, sizes in lm_score.coded(iter(found.toArrow().to_batches()), end):
        for x, h in zip(np.split(ids, np.cumsum(sizes)[:-1]), np.split(heads, np.cumsum(sizes)[:-1]), strict=True):
            assert x[-1] == end and h[-1]
            kept[tuple(x[:-1].tolist())] += 1
    want = Counter(tuple(i for w in lower(r["text"]).split() for i in t.encode(w.decode(), add_special_tokens=False).ids) for r in docs.collect())
    assert kept == want


def test_texts_are_encoded_with_the_places_of_their_words(spark, docs):
    """Scores need no second pass over the texts: which words are frequent ones, or have no ids, is kept beside the ids."""
    frequent = [b"the", b"on", b"er", b"end"]
    raw = np.frombuffer(b" ".join(frequent), np.uint8)
    hashes = wide_hashes(raw, words(raw, np.array([0, len(raw)])))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("text", F.lit("")).alias("whole"))
    found = lm_score.encode_ids(rows, WORD_BPE, hashes).collect()
    t, seen = tokens.load(WORD_BPE), 0
    assert len(found) == docs.count()
    for r in found:
        number = np.frombuffer(r["low"], "<u2") + (np.frombuffer(r["high"], "<u2").astype(int) << 16)
        want = lower(r["whole"]).split()
        assert (number >> 1).tolist() == [frequent.index(w) + 1 if w in frequent else 0 for w in want]
        assert (number & 1).tolist() == [bool(t.encode(w.decode(), add_special_tokens=False).ids) for w in want]
        assert len(r["a"]) == len(r["b"]) == sum(w not in frequent for w in want)
        seen += sum(w in frequent for w in want)
    assert seen


def small_model(rng, ids, sizes, n=50):
    of = lm_score.make_classes(np.bincount(ids, minlength=n + 1), rng.standard_normal((n + 1, 4)), singles=20)
    pairs, lefts = np.zeros((256, 256)), np.zeros((17, n + 1))
    np.add.at(pairs, (of[ids[:-1]], of[ids[1:]]), 1)
    lefts[16] = np.bincount(ids, minlength=n + 1)
    pair_group, pair_member, share = lm_score.from_counts(of, pairs, lefts)
    some = lambda *s: rng.standard_normal(s).astype(np.float32)
    return lm_score.AttentionModel(of, share, pair_group, pair_member, some(256, 4), some(256, 4), some(256, 4), some(6), some(4, 16), some(16, 4, 16))


def plain_score(m, ids, sizes, left=None):
    """One id after the other, in float64."""
    found, at = [], 0
    for size in sizes:
        seq = [int(m.of[-1]), *m.of[ids[at : at + size]]]
        for t in range(size):
            before = seq[max(0, t + 1 - m.context) : t + 1]
            a = m.key[before].astype(float) @ m.query[seq[t]] * m.query.shape[1] ** -0.5 + m.bias[::-1][-len(before) :]
            a = np.exp(a - a.max())
            z = (a / a.sum()) @ m.value[before].astype(float)
            g, k = divmod(seq[t + 1], 16)
            value = m.share[16 if left is None else left[at + t], ids[at + t]]
            for logits, pick in ((z @ m.out_group + m.pair_group[seq[t]], g), (z @ m.out_member[g] + m.pair_member[seq[t], g], k)):
                value += logits[pick] - np.log(np.exp(logits).sum())
            found.append(value)
        at += size
    return np.array(found)


def test_scores_equal_a_plain_pass(spark):
    """Every word's probability from its ids one by one in float64, mixed with its count, beside the query's operator."""
    rng = random.Random(12)
    some = [" ".join(rng.choice(["the", "thereafter", "unbelievable", "xqzv", "of", "Straße", "tion", "a"]) for _ in range(n)) for n in (1, 3, 17, 40, 64, 5, 9, 30)]
    rows = [*enumerate(some), (8, ""), (9, None), (10, some[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    training = F.col("doc_id") % 3 != 0
    found = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(docs, training, WORD_BPE, frequent=4).collect()}
    text = F.coalesce("text", F.lit(""))
    order = F.xxhash64("doc_id", text)
    m = lm_score.train_attention(docs.filter(training).select(F.pmod(F.xxhash64(order, F.lit(11)), F.lit(4)).alias("lot"), order.alias("order"), text.alias("text")), WORD_BPE)
    counts = Counter(w for i, t in rows if i % 3 for w in lower(t).split())
    counts["\0end"] = sum(i % 3 > 0 for i, _ in rows)
    total = sum(counts.values()) + len(counts) + 1
    end, t = lm_score.vocabulary_size(WORD_BPE), tokens.load(WORD_BPE)
    for i, text_here in rows:
        words_here = lower(text_here).split()
        pieces = [*[t.encode(w.decode(), add_special_tokens=False).ids for w in words_here], [end]]
        ids = np.array([x for p in pieces for x in p])
        left = [lm_score.GROUPS if k == 0 else int(m.of[p[k - 1]]) // lm_score.MEMBERS for p in pieces for k in range(len(p))]
        each = plain_score(m, ids, [len(ids)], left)
        want, at = 0.0, 0
        for w, p in zip([*words_here, "\0end"], pieces, strict=True):
            seen, base = each[at : at + len(p)].sum(), (counts[w] + 1) / total
            want += np.log10(0.6 * np.exp(seen) + 0.4 * base) if p else np.log10(base)
            at += len(p)
        assert found[i] == pytest.approx(want, rel=1e-4), i


def test_windows_score_as_one_pass():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 16, 17, 70])
    ids = rng.integers(0, 50, int(sizes.sum()))
    ids[np.cumsum(sizes) - 1] = 50
    m = small_model(rng, ids, sizes)
    assert m.score_ids(ids, np.full(len(ids), 16), sizes, batch=4) == pytest.approx(plain_score(m, ids, sizes), abs=1e-3)
    # all next ids together have probability one
    assert np.exp(m.share[16]) @ np.ones(51) == pytest.approx(len(np.unique(m.of)), rel=1e-4)


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(2)
    sizes = np.array([3, 40, 18])
    ids = rng.integers(0, 50, int(sizes.sum()))
    ids[np.cumsum(sizes) - 1] = 50
    m = small_model(rng, ids, sizes)
    first, seen = m.windows(sizes)
    last = np.repeat(np.cumsum(sizes), -(-sizes // m.stride))
    found = m.gradients(m.framed(m.of[ids]), first, seen, last)
    for name in lm_score.WEIGHTS:
        weight = getattr(m, name)
        at = np.unravel_index(np.abs(found[name]).argmax(), weight.shape)
        kept, loss = weight[at], []
        for step in (1e-2, -1e-2):
            weight[at] = kept + step
            loss.append(-plain_score(m, ids, sizes).mean())
        weight[at] = kept
        assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(found[name][at], rel=0.02), name


def test_prepared_windows_give_the_same_gradients():
    """A shard's windows are laid out once, not again in each step."""
    rng = np.random.default_rng(4)
    sizes = np.array([3, 40, 1, 18, 16])
    ids = rng.integers(0, 50, int(sizes.sum()))
    ids[np.cumsum(sizes) - 1] = 50
    m = small_model(rng, ids, sizes)
    first, seen = m.windows(sizes)
    last = np.repeat(np.cumsum(sizes), -(-sizes // m.stride))
    some = np.array([4, 0, 6, 2])
    want = m.gradients(m.framed(m.of[ids]), first[some], seen[some], last[some])
    found = m.slopes(*(x[some] for x in m.prepared(m.of[ids], sizes)), m.rows())
    assert all(np.array_equal(want[k], found[k]) for k in lm_score.WEIGHTS)


def test_ascii_pieces_skip_the_librarys_rules():
    e, t = tokens.PieceEncoder(WORD_BPE, keep_space=False), tokens.load(WORD_BPE)
    assert e.split is not None and tokens.PieceEncoder(BYTE_BPE, keep_space=True).split is None
    for text in ("It's 12,34 don't! a--b &'s x3y7Z AB_cd|E= 9 99 9a", "a<b <|endoftext|>, x<|endoftext|>y", "a\x7fb c\x1cd Straße,x Ȿq İx y\x85z", "a" * 1500 + " b1", "é", ""):
        ids, n = e.encode(*text_bytes(pa.array([text])))
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids and n.tolist() == [len(ids)]


def test_digest_of_known_text():
    assert hashlib.sha256(np.array([], "<u4").tobytes()).hexdigest().startswith("e3b0c442")
