"""URL rules and embedding links beside plain versions of them."""

from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicflow.llm import embed_dedup, url_rules

# -- 2: URL rules ----------------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:end]


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "https://a.example.org/es/1", "http://example.org/en/12?x=1", "http://example.org/en/2", "ftp://x.com/fr/a#b",
    "http://y.com/de/", "http://notexample.org/es/", "http://z.net?u=http://q.org/", "http://a.b#c/d", "x://h\n.org/p\nq?r", "http://ÉCOLE.org/Ä", "http://com/de/", "://org/", "http://a.org",
]


def test_parts_and_given_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    none = spark.createDataFrame([], "rule_id long, tokens array<string>, anchor string, pages long, confidence double")
    found = {r["page_id"]: r for r in url_rules.judge_urls(rows, none).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_parts(url)
        fits = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "allow")
        assert tuple(found[i]) == (i, host, path, rule, verdict), url
    assert url_rules.judge_urls(rows.limit(0), none).count() == 0


def labelled(spark):
    """Pages of which those at spam.example/win are bad, and some of the others."""
    rows = []
    for i in range(900):
        host, word = ("spam", "good")[i % 2], ("win", "news", "blog")[i % 3]
        bad = int((host == "spam" and word == "win") or i % 25 == 0)
        rows.append((i, f"http://{host}.example.net/{word}/{i}?{quote('ref')}=x", 1 - bad, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string, quality int, toxic int")
    return pages.select("page_id", "url"), pages.select(F.col("page_id").alias("doc_id"), "quality", "toxic").filter("doc_id < 600")


def test_mined_rules_equal_brute_force(spark):
    pages, labels = labelled(spark)
    mined = url_rules.mine_rules(pages, labels, min_support=0.05, min_confidence=0.6, min_pages=10, common=0.9)
    rules = {tuple(r["tokens"]): (r["pages"], round(r["confidence"], 9)) for r in mined.collect()}
    tokens = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    bad = {r["doc_id"]: int(r["quality"] == 0 or r["toxic"] == 1) for r in labels.collect()}
    seen = Counter(t for i in bad for t in tokens[i])
    useful = sorted(t for t, n in seen.items() if 30 <= n <= 0.9 * len(bad))
    sure, share = {}, sum(bad.values()) / len(bad)
    for mask in range(1, 1 << len(useful)):
        s = frozenset(t for k, t in enumerate(useful) if mask >> k & 1)
        held = [bad[i] for i in bad if s <= tokens[i]]
        if len(held) < 30:
            continue
        p, n = sum(held) / len(held), len(held)
        bound = (p + 1 / (2 * n) - np.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)
        if p >= 0.6 and bound > share:
            sure[s] = (len(held), round(sum(held) / len(held), 9))
    want = {tuple(sorted(s)): v for s, v in sure.items() if not any(s - {t} in sure and sure[s - {t}][1] >= v[1] for t in s)}
    assert rules == want and rules
    verdicts = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(pages, mined).collect()}
    assert verdicts == {i: "block" if any(set(r) <= t for r in rules) else "allow" for i, t in tokens.items()}


def test_long_urls_are_read_to_their_end(spark):
    long = "http://a.example.net/" + "/".join("deep" + c * 2 for c in "abcdefghijklmnopqrstuvwxyz")
    names = "&".join(f"n{c}=1" for c in "abcdefghijklmnopqrstuvwxyz")
    rows = [(i, f"{long}?{names}&casino=1" if i % 4 == 0 else f"{long}?ok=1", int(i % 4 > 0), 0) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, quality int, toxic int")
    mined = url_rules.mine_rules(pages, pages.select(F.col("page_id").alias("doc_id"), "quality", "toxic"), min_pages=10)
    rules = {tuple(r["tokens"]): r["pages"] for r in mined.collect()}
    assert rules == {("q:casino",): 100} | {(f"q:n{c}",): 100 for c in "abcdefghijklmnopqrstuvwxyz"}
    assert {r["page_id"] for r in url_rules.judge_urls(pages, mined).collect() if r["verdict"] == "block"} == set(range(0, 400, 4))


@pytest.mark.parametrize("share, pure", [(0.97, True), (0.8, False)])
def test_names_that_nearly_always_stand_together(spark, share, pure):
    """22 names, each dropped at random from some pages: their combinations double with each. Every name is a rule by itself."""
    import random
    import time

    rng = random.Random(7)
    rows = []
    for i in range(600):
        spam = i % 2 == 0
        names = [f"n{c}" for c in "abcdefghijklmnopqrstuv" if spam and rng.random() < share]
        rows.append((i, f"http://h{i % 7}.example.net/p?" + "&".join(f"{n}=1" for n in names), int(not spam or (not pure and i % 10 == 0)), 0))
    pages = spark.createDataFrame(rows, "page_id long, url string, quality int, toxic int")
    start = time.time()
    mined = url_rules.mine_rules(pages, pages.select(F.col("page_id").alias("doc_id"), "quality", "toxic")).collect()
    assert time.time() - start < 240  # all combinations of 22 would take hours
    assert {f"q:n{c}" for c in "abcdefghijklmnopqrstuv"} <= {r["tokens"][0] for r in mined if len(r["tokens"]) == 1}
    tokens = [set(r["t"]) for r in pages.select(url_rules.url_tokens(F.col("url")).alias("t")).collect()]
    for r in mined[:200]:
        assert r["pages"] == sum(set(r["tokens"]) <= t for t in tokens)


def test_no_labels_no_rules(spark):
    pages, labels = labelled(spark)
    assert url_rules.mine_rules(pages, labels.limit(0)).count() == 0
    assert url_rules.mine_rules(pages.limit(0), labels).count() == 0
    good = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(None).cast("int"))
    assert url_rules.mine_rules(pages, good).count() == 0


# -- 6: embeddings ---------------------------------------------------------------------------


def near(rng, v, cosine):
    u = rng.standard_normal(v.shape)
    u -= (u @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * u / np.linalg.norm(u)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    base = rng.standard_normal((600, 64))
    rows = [*base]
    for v in base[:120]:
        rows += [near(rng, v, rng.choice([0.93, 0.955, 0.97, 0.999])) for _ in range(3)]
    rows += [near(rng, base[0], 0.99) for _ in range(90)] + [base[1]] * 40 + [base[2] * 3.0]
    return [np.asarray(v, np.float32).tolist() for v in rows]


def brute(vectors, least=0.95):
    x = np.array(vectors, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= least
    np.fill_diagonal(hit, False)
    return hit


def test_links_against_brute_force(spark, vectors):
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [1.0, None] + [0.0] * 62, [1.0, 2.0, 3.0]]
    rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors + odd)], "vec_id long, embedding array<float>, kept string").repartition(6)
    hit = brute(vectors)
    found = {r["vec_id"]: r for r in embed_dedup.embedding_dedup(rows).collect()}
    assert len(found) == len(vectors) + len(odd)
    links = np.array([found[i]["n_links"] for i in range(len(vectors))])
    assert (links <= hit.sum(1)).all()
    assert links.sum() >= 0.99 * hit.sum()
    for i in range(len(vectors), len(found)):
        assert tuple(found[i]) == (i, 0, i, True)
    for i in range(600, len(vectors)):
        if links[i] == hit[i].sum():
            assert found[i]["component_id"] <= min([i, *np.flatnonzero(hit[i])])
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_chunked_filters_count_each_pair_once(spark, vectors):
    few = vectors[:40] + vectors[-131:]
    unique = [list(v) for v in dict.fromkeys(map(tuple, few))]
    rows = spark.createDataFrame([(i, 1, v) for i, v in enumerate(unique)], "id long, copies long, vector array<float>")
    hit = brute(unique)
    for group_rows in (4096, 16):
        found = embed_dedup.link_vectors(rows, len(unique), tables=8, group_rows=group_rows).groupBy("id").agg(F.sum("links").alias("n")).collect()
        got = np.zeros(len(unique), int)
        for r in found:
            got[r["id"]] = r["n"]
        assert (got == hit.sum(1)).all()


def filters_of(x, *args):
    row, name = embed_dedup.cap_filters(x, *args)
    return [set(v.tolist()) for v in np.split(name, np.searchsorted(row, np.arange(1, len(x))))]


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    for dim, words in ((64, 64), (64, 256), (64, 1024), (384, 256)):
        a = rng.standard_normal((1000, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = np.array([near(rng, v, 0.951) for v in a])
        pairs = list(zip(filters_of(a, words, 8, 3), filters_of(b, words, 8, 3), strict=True))
        assert np.mean([bool(f & g) for f, g in pairs]) > 0.985
        assert 18 < np.mean([len(f) for f, _ in pairs]) < 32


def test_list_decoding_finds_all_filters_over_the_height():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((40, 15))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    turn, halves = embed_dedup._code(16, 8, 0, 1)
    t = np.concatenate([v, np.zeros((40, 1))], axis=1) @ turn
    score = ((t[:, :8] @ halves[0].T)[:, :, None] + (t[:, 8:] @ halves[1].T)[:, None, :]).reshape(40, -1)
    height, alone = embed_dedup.cap_height(16, 8, 2, 0, 1), 0
    for found, s in zip(filters_of(v, 8, 1, 2), score, strict=True):
        over = set(np.flatnonzero(s >= height).tolist())
        alone += not over
        assert found == (over or {int(s.argmax())})
    assert 0 < alone < 20


def test_empty_table(spark):
    assert embed_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_no_rule_is_lost_on_wide_pages(spark):
    """Pages of up to nine tokens: with three of each in FP-growth the rules are those with all of them in it."""
    import random

    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        words = sorted(w for w in "abcdefghi" if rng.random() < 0.55)
        bad = {"a", "e", "h"} <= set(words) or {"b", "c", "i"} <= set(words) or rng.random() < 0.25
        rows.append((i, "http://x.org/" + "/".join(words)))
        labels.append((i, int(not bad), 0))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = lambda widest: sorted((tuple(r["tokens"]), r["pages"], round(r["confidence"], 9)) for r in url_rules.mine_rules(pages, labels, widest=widest, exact=True).collect())
    every = rules(99)
    assert rules(3) == every and max(len(t) for t, _, _ in every) >= 3
