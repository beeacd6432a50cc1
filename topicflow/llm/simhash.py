"""SimHash near-duplicates: fingerprints linked through Gray-ordered hierarchical indexes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, lean, stored

LEAF, FAN = 32, 8


def shingle_hashes(text: str | None, words: int = 4) -> np.ndarray:
    """XXH64 of every shingle in turn; fewer words make one shingle, none no shingle."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    whole, digest = b" ".join(w), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(w))
    return np.array([digest(whole[a:b], 42) for a, b in zip(starts[: len(w) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64; signed for Spark."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        counts += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: Column, words: int = 4) -> Column:
    @F.pandas_udf("long")
    @lean
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return prints(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a code word in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From leaves of LEAF neighbours up: the bits all fingerprints of a node share, and their values."""
    at = np.arange(0, len(x), LEAF)
    both, any_ = np.bitwise_and.reduceat(x, at), np.bitwise_or.reduceat(x, at)
    out = [(~(both ^ any_), both)]
    while len(both) > FAN:
        at = np.arange(0, len(both), FAN)
        both, any_ = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(any_, at)
        out.append((~(both ^ any_), both))
    return out


def near_groups(prints: np.ndarray, most: int) -> np.ndarray:
    """A label per distinct fingerprint: equal if a chain of links of ``most`` bits joins them.

    Sorted by Gray rank, neighbours share bits; a node keeps the mask and values of the bits
    that all its fingerprints share. Pairs of nodes are followed down from the top, and left as
    soon as the shared bits alone differ in more than ``most`` places.
    """
    order = np.argsort(gray_rank(prints), kind="stable")
    x, n = prints[order], len(prints)
    label = np.arange(n)

    def merge(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        while len(a):
            la, lb = label[a], label[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            parent = np.arange(n)
            np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
            while (parent != parent[parent]).any():
                parent = parent[parent]
            label = parent[label]

    levels = _levels(x)
    top = len(levels[-1][0])
    i, j = np.triu_indices(top)
    for depth in range(len(levels) - 1, -1, -1):
        mask, value = levels[depth]
        near = np.bitwise_count((value[i] ^ value[j]) & mask[i] & mask[j]) <= most
        i, j = i[near], j[near]
        if depth:
            size = len(levels[depth - 1][0])
            a = (i[:, None, None] * FAN + np.arange(FAN)[None, :, None] + np.zeros((1, 1, FAN), np.int64)).ravel()
            b = (j[:, None, None] * FAN + np.arange(FAN)[None, None, :] + np.zeros((1, FAN, 1), np.int64)).ravel()
            good = (a <= b) & (b < size) & (a < size)
            i, j = a[good], b[good]
    padded = np.concatenate([x, np.zeros(-n % LEAF, np.uint64)]).reshape(-1, LEAF)
    for s in range(0, len(i), 512):
        a, b = i[s : s + 512], j[s : s + 512]
        hit, p, q = np.nonzero(np.bitwise_count(padded[a][:, :, None] ^ padded[b][:, None, :]) <= most)
        p, q = a[hit] * LEAF + p, b[hit] * LEAF + q
        real = (p < q) & (q < n)
        merge(p[real], q[real])
    out = np.empty(n, np.int64)
    out[order] = label
    return out


def _masks(most: int, extra: int) -> list[int]:
    """Masks of which two fingerprints that differ in ``most`` bits agree on one at least.

    64 bits in most + extra blocks; a mask joins ``extra`` of them.
    """
    edges = np.linspace(0, 64, most + extra + 1).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(c)) for c in combinations(blocks, extra)]


def link_fingerprints(rows: DataFrame, most: int = 4, extra: int = 1, group_rows: int = 8192) -> DataFrame:
    """Edges (a, b) between ids whose fingerprints ``rows(id, print)`` a chain of links joins.

    The top nodes of the index are the shared patterns under each of a few masks: fingerprints
    within ``most`` bits agree under one of them, so only members of one node are compared, each
    node by its Gray-ordered index. ``extra`` above 1 makes more and smaller nodes for more
    fingerprints. A node of over ``group_rows`` members is dealt into chunks, and each pair of
    its chunks is a node of its own. A task gives a spanning forest, never all pairs.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masks = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("print").bitwiseAND(F.lit(m)).alias("value")) for k, m in enumerate(_masks(most, extra))])
    placed = rows.select("id", "print", F.explode(masks).alias("m")).select("id", "print", "m.mask", "m.value")
    large = stored(placed.groupBy("mask", "value").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows), "large-nodes")
    placed = placed.join(large, ["mask", "value"], "left").withColumn("chunks", F.coalesce(F.ceil(F.col("n") * 2 / group_rows), F.lit(1)))
    chunk = F.pmod(F.xxhash64("print"), F.col("chunks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: F.least(k, chunk) * F.col("chunks") + F.greatest(k, chunk))
    dealt = placed.withColumn("pair", F.explode(pairs)).select("mask", "value", "pair", "id", "print")

    def forest(ids: np.ndarray, prints: np.ndarray) -> pd.DataFrame | None:
        label = near_groups(prints, most)
        root = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(root, label, ids)
        root = root[label]
        linked = root != ids
        return pd.DataFrame({"a": ids[linked], "b": root[linked]}) if linked.any() else None

    @lean
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def groups(b: pd.DataFrame, last: bool) -> Iterator[pd.DataFrame]:
            nonlocal held
            k = b[["mask", "value", "pair"]].to_numpy()
            edges = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(b)]
            ids, prints = b["id"].to_numpy(), b["print"].to_numpy().view(np.uint64)
            found = []
            for s, e in zip(edges[:-1], edges[1:] if last else edges[1:-1], strict=last):
                if e - s > 1 and (f := forest(ids[s:e], prints[s:e])) is not None:
                    found.append(f)
            held = None if last else b.iloc[edges[-2] :]
            if found:
                yield pd.concat(found)

        for b in batches:
            if len(b):
                yield from groups(b if held is None else pd.concat([held, b], ignore_index=True), False)
        if held is not None:
            yield from groups(held.reset_index(drop=True), True)

    return dealt.repartition(n, "mask", "value", "pair").sortWithinPartitions("mask", "value", "pair").mapInPandas(link, "a long, b long")


def _extra(n: int, most: int, group_rows: int = 2048) -> int:
    """The fewest blocks to a mask that leave nodes of about ``group_rows`` evenly spread fingerprints."""
    extra = 1
    while extra < 6 and n / 2 ** (64 * extra / (most + extra)) > group_rows:
        extra += 1
    return extra


def simhash_components(docs: DataFrame, words: int = 4, most: int = 4, extra: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (long), component_id (and ``carry``).

    component_id is the smallest doc_id that links of at most ``most`` differing bits reach,
    itself included. Texts are lower-cased A-Z, cut into words at ASCII white space and into
    shingles of ``words`` words; fewer words make one shingle, none the fingerprint zero, which
    links like any other. Equal fingerprints are one node. ``extra`` changes the work, never the
    links; by default it follows the number of nodes. A null text is empty; rows with a
    null doc_id link nothing and have a null component unless others share their fingerprint;
    an empty table gives no rows.
    """
    prints = stored(docs.select("doc_id", *carry, simhash(F.col("text"), words).alias("fingerprint")), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "nodes")
    extra = _extra(nodes.count(), most) if extra is None else extra
    edges = link_fingerprints(nodes.filter("id is not null").select("id", F.col("fingerprint").alias("print")), most, extra)
    found = components(edges)
    classes = nodes.join(found, nodes["id"] == found["node"], "left").select("fingerprint", F.coalesce("component", "id").alias("component_id"))
    return prints.join(stored(classes, "classes"), "fingerprint").select("doc_id", *carry, "fingerprint", "component_id")
