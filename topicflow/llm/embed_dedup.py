"""Embedding near-duplicates: spherical-cap filters from random product codes, then a check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lean, stored


@lru_cache(maxsize=64)
def _code(dim: int, words: int, table: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation, and unit code words for either half of the rotated coordinates."""
    rng = np.random.default_rng([seed, dim, words, table])
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = rng.standard_normal((2, words, dim // 2))
    return turn, halves / np.linalg.norm(halves, axis=2, keepdims=True)


@lru_cache(maxsize=64)
def cap_height(dim: int, words: int, caps: float, table: int, seed: int) -> float:
    """The score that random unit vectors exceed in ``caps`` directions of a code on average.

    It depends on the code alone, and not on any data: the rotation makes all vectors alike.
    """
    v = np.random.default_rng([seed, dim, words, table, 1]).standard_normal((64, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    turn, halves = _code(dim, words, table, seed)
    first, second = ((v @ turn)[:, h * dim // 2 : (h + 1) * dim // 2] @ halves[h].T for h in range(2))
    second = np.sort(second, axis=1)
    low, high = -2.0, 2.0
    for _ in range(30):
        middle = (low + high) / 2
        listed = sum(words * words - int(np.searchsorted(s, middle - f).sum()) for f, s in zip(first, second, strict=True))
        low, high = (middle, high) if listed > caps * len(v) else (low, middle)
    return high


def cap_filters(unit: np.ndarray, words: int, tables: int, caps: float, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The filters of unit vectors in ``tables`` product codes: (row, filter), by row and filter.

    A filter's direction is a code word for the first half joined with one for the second, so
    words**2 directions need 2 * words products. A vector is listed under every direction whose
    score exceeds the cap's height; under its best one in a code where none does. List
    decoding looks at the words of a half that reach the height with the other half's best.
    """
    n, dim = unit.shape
    if dim % 2:
        unit, dim = np.concatenate([unit, np.zeros((n, 1))], axis=1), dim + 1
    rows, names = [], []
    for t in range(tables):
        height = cap_height(dim, words, caps, t, seed)
        turn, halves = _code(dim, words, t, seed)
        turned = unit @ turn
        score = [turned[:, h * dim // 2 : (h + 1) * dim // 2] @ halves[h].T for h in range(2)]
        best = [s.argmax(1) for s in score]
        top = [np.take_along_axis(s, k[:, None], 1)[:, 0] for s, k in zip(score, best, strict=True)]
        (r1, w1), (r2, w2) = (np.nonzero(s >= (height - other)[:, None]) for s, other in zip(score, top[::-1], strict=True))
        count = np.bincount(r2, minlength=n)
        times = count[r1]  # every word of the first half with every one of the second
        at = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat((np.cumsum(count) - count)[r1], times)
        row, first, second = np.repeat(r1, times), np.repeat(w1, times), w2[at]
        over = score[0][row, first] + score[1][row, second] >= height
        row, name = row[over], first[over] * words + second[over]
        none = np.flatnonzero(np.bincount(row, minlength=n) == 0)
        rows += [row, none]
        names += [name + t * words * words, best[0][none] * words + best[1][none] + t * words * words]
    row, name = np.concatenate(rows), np.concatenate(names)
    order = np.lexsort((name, row))
    return row[order], name[order]


def unit_rows(vectors: list) -> np.ndarray:
    return unit(np.array([np.asarray(v, np.float64) for v in vectors]))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_GROUP = ("dim", "filter", "pair")


def _pairs(x: np.ndarray, f: np.ndarray, here: np.ndarray, edges: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a group (from one edge to the next) with a product of ``least`` or more, in parts.

    Only pairs whose first shared filter (``f``: each row's, -1 for none) is the group's own: in
    groups of many alike, whose filters are alike too, all but one group pass over a pair.
    """
    sizes = np.diff(edges)
    large = sizes > 128
    later = np.where(~np.repeat(large, sizes), np.repeat(edges[1:], sizes) - np.arange(len(x)) - 1, 0)
    total = np.cumsum(later)
    i = 0
    while i < len(x):  # about so many pairs at a time
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 100_000, "right")))
        p = np.repeat(np.arange(i, j), later[i:j])
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(later[i:j]) - later[i:j], later[i:j])
        hit = np.einsum("ij,ij->i", x[p], x[q]) >= least
        p, q = p[hit], q[hit]
        for c in range(0, len(p), 4096):
            a, b = p[c : c + 4096], q[c : c + 4096]
            seen = ((f[a][:, :, None] == f[b][:, None, :]) & ((f[a] >= 0) & (f[a] < here[a][:, None]))[:, :, None]).any((1, 2))
            yield a[~seen], b[~seen]
        i = j
    for k in np.flatnonzero(large).tolist():
        low, high = int(edges[k]), int(edges[k + 1])
        earlier = np.where((f[low:high] >= 0) & (f[low:high] < here[low]), f[low:high], -1)
        for s in range(0, high - low, 64):
            known = np.unique(earlier[s : s + 64])
            known = known[known >= 0]
            rest = earlier[s:]
            shared = np.zeros((len(rest), len(known)), np.float32)
            if len(known):
                at = np.minimum(np.searchsorted(known, rest), len(known) - 1)
                row, column = np.nonzero(known[at] == rest)
                shared[row, at[row, column]] = 1
            hit = x[low + s : min(low + s + 64, high)] @ x[low + s : high].T >= least
            hit &= shared[: len(hit)] @ shared.T == 0
            p, q = np.nonzero(np.triu(hit, 1))
            yield p + low + s, q + low + s


def compared(t: pa.Table, least: float) -> Iterator[pa.RecordBatch]:
    """Links inside whole groups of rows (dim, filter, pair, chunk, chunks, id, copies, vector, filters): id, links, root."""
    dims = t.column("dim").to_numpy()
    for same in np.split(np.arange(len(dims)), np.flatnonzero(np.diff(dims)) + 1):
        part = t.slice(int(same[0]), len(same)).combine_chunks()
        here, pair, chunk, chunks, ids, copies = (part.column(c).to_numpy() for c in ("filter", "pair", "chunk", "chunks", "id", "copies"))
        x = unit(part.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(same), -1))
        lists = part.column("filters").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        f = np.full((len(same), int(lengths.max())), -1, np.int32)
        f[np.arange(f.shape[1])[None] < lengths[:, None]] = lists.flatten().to_numpy()
        edges = np.concatenate([[0], np.flatnonzero((here[1:] != here[:-1]) | (pair[1:] != pair[:-1])) + 1, [len(same)]])
        across = pair // chunks != pair % chunks
        links, root = np.zeros(len(same), np.int64), np.arange(len(same))
        for p, q in _pairs(x, f, here, edges, least):
            new = ~across[p] | (chunk[p] != chunk[q])
            a, b = p[new], q[new]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            while True:  # hook and jump until every pair has one root
                ra, rb = root[a], root[b]
                if (ra == rb).all():
                    break
                np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
                while (root != root[root]).any():
                    root = root[root]
        low = np.full(len(same), np.iinfo(np.int64).max)
        np.minimum.at(low, root, ids)
        low = low[root]
        keep = (links > 0) | (low != ids)
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(links[keep]), pa.array(low[keep])], names=["id", "links", "root"])


def link_vectors(rows: DataFrame, n_rows: int, least: float = 0.95, tables: int = 8, caps: float = 3.0, group_rows: int = 4096) -> DataFrame:
    """(id, links, root) for each vector of ``rows(id, copies, vector)`` and filter that gives it links.

    Vectors that share a filter are compared there; a pair that shares several is counted in
    the first of them. ``links`` counts the copies of linked vectors, ``root`` is the smallest
    id that links within the group reach. So a group gives a row per member at most, never its
    pairs. A vector is under ``caps`` filters of each code on average. Filters are about as many as vectors, so groups stay small; one of over
    ``group_rows`` members is dealt into chunks and each pair of chunks is compared apart.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = int(2 ** np.clip(np.ceil(np.log2(max(1, n_rows)) / 2), 5, 12))

    @lean
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = b["vector"].map(len)
            for _, same in b.groupby(sizes, sort=False):
                for i in range(0, len(same), 1000):
                    part = same.iloc[i : i + 1000]
                    row, name = cap_filters(unit_rows(part["vector"].tolist()), words, tables, caps)
                    yield part.assign(filters=np.split(name.astype(np.int32), np.searchsorted(row, np.arange(1, len(part)))))

    decoded = rows.mapInPandas(decode, "id long, copies long, vector array<double>, filters array<int>")
    decoded = stored(decoded.withColumn("vector", F.col("vector").cast(rows.schema["vector"].dataType)), "filters")
    placed = decoded.select("id", "copies", "vector", "filters", F.size("vector").alias("dim"), F.explode("filters").alias("filter"))
    large = stored(decoded.select(F.size("vector").alias("dim"), F.explode("filters").alias("filter")).groupBy("dim", "filter").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows), "large-filters")
    placed = placed.join(large, ["dim", "filter"], "left").withColumn("chunks", F.coalesce(F.ceil(F.col("n") * 2 / group_rows), F.lit(1)))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: F.least(k, F.col("chunk")) * F.col("chunks") + F.greatest(k, F.col("chunk")))
    dealt = placed.withColumn("pair", F.explode(pairs)).select("dim", "filter", "pair", "chunk", "chunks", "id", "copies", "vector", "filters")

    @lean
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(map(len, held)) < 4 * group_rows:
                continue
            t = pa.Table.from_batches(held)
            key = np.stack([t.column(c).to_numpy() for c in _GROUP], axis=1)
            edge = int(np.flatnonzero((key[1:] != key[:-1]).any(1))[-1] + 1) if (key[0] != key[-1]).any() else 0
            if edge:  # the last group may go on
                yield from compared(t.slice(0, edge), least)
                held = t.slice(edge).combine_chunks().to_batches()
        if held:
            yield from compared(pa.Table.from_batches(held), least)

    return dealt.repartition(n, "dim", "filter", "pair").sortWithinPartitions("dim", "filter", "pair").mapInArrow(groups, "id long, links long, root long")


def embedding_dedup(vectors: DataFrame, least: float = 0.95, tables: int = 8, caps: float = 3.0) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Links are pairs with cosine ``least`` or more, in double precision, among those that share
    a filter; none below it is linked, and what filters miss is measured in the tests. Equal
    vectors are compared once and link with each other. A vector that is null, empty or zero,
    or holds a null or non-finite component, links with nothing; so do vectors of different
    lengths. Rows with a null vec_id link with nothing. An empty table gives no rows.
    """
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad & F.exists("embedding", lambda v: v != 0) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", F.when(F.coalesce(good, F.lit(False)), F.transform("embedding", lambda v: v + F.lit(0).cast("float"))).alias("vector"))
    nodes = stored(rows.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vectors")
    found = stored(link_vectors(nodes.select("id", "copies", "vector"), nodes.count(), least, tables, caps), "links")
    classes = components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    nodes = nodes.join(links, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left")
    nodes = stored(nodes.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "classes")
    out = rows.filter("vector is not null").join(nodes, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
