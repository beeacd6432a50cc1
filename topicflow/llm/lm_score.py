"""LM scoring: a causal self-attention model over subword ids, trained on the whole corpus, beside a unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from .common import discard, give_back, lean, stored
from .tokens import PieceEncoder, encoder
from .words import HashTable, binary, distinct, lower, parts, text_bytes, wide_hashes, words

#: Classes are in groups of so many; both numbers are fixed, whatever the corpus.
GROUPS, MEMBERS = 16, 16
CLASSES, SHIFT = GROUPS * MEMBERS, MEMBERS.bit_length() - 1
#: Ids of a shard, which is trained in turn; ids that are mixed; and parts of one in which weights are averaged.
SHARD, CHUNK, FINE = 1 << 20, 1 << 17, 1 << 24
#: The weights that are trained, in the order in which they are sent.
WEIGHTS = ("query", "key", "value", "bias", "out_group", "out_member")


@lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    size = Tokenizer.from_file(path).get_vocab_size()
    give_back()  # the driver keeps no tokenizer
    return size


def rows_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """x[at], by a call that is several times as fast on short rows; ``at`` must lie inside."""
    return x.take(at, 0, mode="clip")


def exponents(x: np.ndarray) -> np.ndarray:
    """exp of the rows in place, each shifted to at most 0 unless all are small; and the rows' sums."""
    if x.max(initial=0) > 60:
        x -= x.max(-1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[-1], np.float32)


@dataclass
class AttentionModel:
    """Next-class probabilities from the classes before, and each id's share of its class.

    An id's class is its own for the most frequent ids (the end of text has one), else that of
    a cluster; classes lie in groups. The logits of a group, and of a class in its group, are
    a row of counts for the last class, and causal self-attention over the last ``context``
    classes with a bias for each distance. An id's share of its class depends on the group to
    its left inside its word, or on its being a word's first.
    """

    of: np.ndarray  # class of each id; the last id is the end of a text
    share: np.ndarray  # log of each id's share of its class, by the group to its left (the last row: none)
    pair_group: np.ndarray
    pair_member: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    bias: np.ndarray
    out_group: np.ndarray
    out_member: np.ndarray
    stride: int = 16

    @property
    def context(self) -> int:
        return len(self.bias)

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in WEIGHTS]).astype(np.float32)

    def set_weights(self, flat: np.ndarray) -> None:
        """The weights become views of ``flat``."""
        at = 0
        for k in WEIGHTS:
            x = getattr(self, k)
            setattr(self, k, flat[at : at + x.size].reshape(x.shape).astype(np.float32, copy=False))
            at += x.size

    def windows(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For texts of so many ids in turn: each window's first id and how many of its text come before it.

        Windows of context + stride ids overlap by the context; each scores its last stride
        ids, so every id is scored once.
        """
        n = -(-sizes // self.stride)
        text = np.repeat(np.arange(len(sizes)), n)
        inside = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * self.stride
        return (np.cumsum(sizes) - sizes)[text] + inside, inside

    def by_class(self) -> tuple[np.ndarray, np.ndarray]:
        """Log of what each class gives each class before it (none at CLASSES), and of what each distance adds, the farthest first.

        A weight depends on two classes and their distance only, so this table stands for all products
        of queries and keys. Rows are shifted to at most 0 unless all are small; below -60 counts as -60.
        """
        table = np.empty((CLASSES, CLASSES + 1), np.float32)
        given, query = table[:, :CLASSES], self.query * np.float32(self.query.shape[1] ** -0.5)
        np.matmul(query, self.key.T, out=given)
        one = np.ones(query.shape[1], np.float32)
        if not (query * query @ one).max() * (self.key * self.key @ one).max() <= 900 and np.abs(given).max() > 30:
            given -= given.max(1, keepdims=True)
            np.maximum(given, np.float32(-60), out=given)
        table[:, CLASSES] = -np.inf
        return table, np.ascontiguousarray(np.maximum(self.bias - self.bias.max(), np.float32(-20))[::-1])

    def banded(self, x: np.ndarray) -> np.ndarray:
        """Of [windows, targets, inputs] the inputs that each target sees, itself and context - 1 before it, as [targets, those inputs, windows]."""
        return as_strided(x, (self.stride, self.context, len(x)), (x.strides[1] + x.strides[2], x.strides[2], x.strides[0]))

    def attend(self, c: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray], logs: bool = False):
        """c: classes [windows, context + stride - 1 inputs], CLASSES before a text's first. Pairs of classes, weights (banded, and whole), values, and their means.

        tables: of pairs of classes and of distances, or with ``logs`` their logs; and values, with zeros for none.
        """
        given, far, value = tables
        by_place = np.ascontiguousarray(c.T)  # windows last, as numpy is fast on long rows
        row, one = by_place.strides
        pairs = as_strided(by_place, (self.stride, self.context, len(c)), (row, row, one)) + (by_place[self.context - 1 :] * (CLASSES + 1))[:, None, :]
        w = rows_at(given, pairs)
        if logs:
            w += far[:, None]
            np.exp(w, out=w)
        else:
            w *= far[:, None]
        w *= (1 / w.sum(1))[:, None]
        a = self.room(len(c), c.shape[1])
        self.banded(a)[...] = w
        v = rows_at(value, c)
        return pairs, w, a, v, a @ v

    def room(self, windows: int, inputs: int) -> np.ndarray:
        """Weights of that many windows, all zero outside the band, for the next call to fill."""
        kept = self.__dict__.get("_room")
        if kept is None or kept.shape != (windows, self.stride, inputs):
            kept = self.__dict__["_room"] = np.zeros((windows, self.stride, inputs), np.float32)
        return kept

    def framed(self, classes: np.ndarray) -> np.ndarray:
        """Classes with ends before and after, so that every window lies inside."""
        edge = np.full(self.context + self.stride, int(self.of[-1]), classes.dtype)
        return np.concatenate([edge, classes, edge])

    def inputs(self, framed: np.ndarray, first: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input classes of each window (CLASSES where the text has none), the classes it scores, and where these stand."""
        width, end = self.context + self.stride - 1, int(self.of[-1])
        at = first[:, None] + np.arange(-(width - self.stride) - 1, self.stride)[None, :]
        c = rows_at(framed, at + (self.context + self.stride))
        early = np.flatnonzero(seen <= width - self.stride)
        start = (width - self.stride - seen[early])[:, None]  # the input before the text's first target
        place = np.arange(width + 1)[None, :]
        c[early] = np.where(place > start, c[early], np.where(place == start, end, CLASSES))
        return c[:, :-1], c[:, -self.stride :], at[:, -self.stride :]

    def prepared(self, classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows of these texts what ``slopes`` takes: input classes, targets and their groups."""
        first, seen = self.windows(sizes)
        c, target, at = self.inputs(self.framed(classes), first, seen)
        return np.ascontiguousarray(c), np.ascontiguousarray(target), self.targets(target, at, np.repeat(np.cumsum(sizes), -(-sizes // self.stride)))

    def targets(self, target: np.ndarray, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The group of each target; GROUPS beyond its text's last id."""
        return np.where(at < last[:, None], target // MEMBERS, GROUPS).astype(np.uint8)  # small numbers are sorted fast

    @staticmethod
    def by_group(groups: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Which of the targets are real, in the order of their groups; and where each group of them begins and ends."""
        n = np.bincount(groups.ravel(), minlength=GROUPS + 1)[:GROUPS]
        edges = np.concatenate([[0], np.cumsum(n)]).tolist()
        held = [(g, a, b) for g, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        return np.argsort(groups.ravel(), kind="stable")[: edges[-1]], held

    def rows(self) -> np.ndarray:
        """For each class and group the logits from counts: of the groups, and of that group's members."""
        return np.concatenate([np.broadcast_to(self.pair_group[:, None], self.pair_member.shape), self.pair_member], axis=2).reshape(-1, GROUPS + MEMBERS)

    def heads(self) -> np.ndarray:
        """For each group the weights of such a row's logits."""
        return np.concatenate([np.broadcast_to(self.out_group[None], self.out_member.shape), self.out_member], axis=2)

    @staticmethod
    def logits(z: np.ndarray, now: np.ndarray, target: np.ndarray, held: list[tuple[int, int, int]], rows: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of groups and of the target group's members; rows must be in the order of their targets' groups. And where the target's two stand."""
        found, more = rows_at(rows, now * GROUPS + (target >> SHIFT)), np.empty((len(z), heads.shape[2]), np.float32)
        for g, a, b in held:
            np.matmul(z[a:b], heads[g], out=more[a:b])
        found += more
        pick = np.empty((len(z), 2), np.int64)
        pick[:, 0], pick[:, 1] = target >> SHIFT, (target & (MEMBERS - 1)) + GROUPS
        pick += np.arange(0, found.size, found.shape[1])[:, None]
        return found.reshape(-1, MEMBERS), pick.ravel()

    def score_ids(self, ids: np.ndarray, left: np.ndarray, sizes: np.ndarray, batch: int = 512) -> np.ndarray:
        """The natural log probability of each id; left: the row of ``share``. Ids of all texts in turn, each with its end."""
        classes = self.of[ids]
        framed = self.framed(classes)
        first, seen = self.windows(sizes)
        last = np.repeat(np.cumsum(sizes), -(-sizes // self.stride))
        found, rows, heads = np.zeros(len(ids), np.float32), self.rows(), self.heads()
        given, far = self.by_class()
        tables = np.exp(given).ravel(), np.exp(far), padded(self.value)
        for i in range(0, len(first), batch):
            c, target, at = self.inputs(framed, first[i : i + batch], seen[i : i + batch])
            z = self.attend(c, tables)[-1].reshape(-1, self.value.shape[1])
            real, held = self.by_group(self.targets(target, at, last[i : i + batch]))
            logits, pick = self.logits(rows_at(z, real), c[:, -self.stride :].ravel()[real], target.ravel()[real], held, rows, heads)
            whole = exponents(logits)
            value = np.log(np.maximum(rows_at(logits.reshape(-1), pick), np.float32(1e-35)) / whole)
            found[at.ravel()[real]] = value[::2] + value[1::2]
        return found.astype(np.float64) + rows_at(self.share.reshape(-1), left * self.share.shape[1] + ids)

    def gradients(self, framed: np.ndarray, first: np.ndarray, seen: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over a batch of windows, by weight."""
        c, target, at = self.inputs(framed, first, seen)
        return self.slopes(c, target, self.targets(target, at, last), self.rows())

    def slopes(self, c: np.ndarray, target: np.ndarray, groups: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss, by weight, over windows of these input classes, targets, and groups of targets."""
        s, dim = self.stride, self.query.shape[1]
        given, far = self.by_class()
        pairs, w, a, v, z = self.attend(c, (given.reshape(-1), far, padded(self.value)), logs=True)
        real, held = self.by_group(groups)
        heads, zr = self.heads(), rows_at(z.reshape(-1, dim), real)
        logits, pick = self.logits(zr, c[:, -s:].ravel()[real], target.ravel()[real], held, rows, heads)
        part = np.float32(1 / max(1, len(zr)))
        logits *= (part / exponents(logits))[:, None]
        logits.reshape(-1)[pick] -= part
        logits = logits.reshape(-1, GROUPS + MEMBERS)
        dzr, out = np.zeros((len(zr) + 1, dim), np.float32), np.zeros_like(heads)
        for g, x, y in held:
            np.matmul(logits[x:y], heads[g].T, out=dzr[x:y])
            np.matmul(zr[x:y].T, logits[x:y], out=out[g])
        place = np.full(groups.size, len(zr))  # the others' are the last row, which is zero
        place[real] = np.arange(len(zr))
        dz = rows_at(dzr, place).reshape(z.shape)
        mean = (dz * z).reshape(-1, dim).dot(np.ones(dim, np.float32)).reshape(z.shape[:2])
        ds = self.banded(dz @ v.transpose(0, 2, 1)) - np.ascontiguousarray(mean.T)[:, None, :]
        ds = np.multiply(ds, w, order="C")
        by_class = np.zeros((CLASSES, CLASSES + 1), np.float32)
        np.add.at(by_class.reshape(-1), pairs.reshape(-1), ds.reshape(-1))
        by_class *= np.float32(dim**-0.5)
        return {
            "out_group": out[:, :, :GROUPS].sum(0), "out_member": out[:, :, GROUPS:],
            "value": summed(c.ravel(), (a.transpose(0, 2, 1) @ dz).reshape(-1, dim)),
            "query": by_class[:, :CLASSES] @ self.key,
            "key": by_class[:, :CLASSES].T @ self.query,
            "bias": ds.sum(2).sum(0)[::-1],
        }


def padded(value: np.ndarray) -> np.ndarray:
    """With a row of zeros for no class."""
    return np.concatenate([value, np.zeros((1, value.shape[1]), value.dtype)])


def summed(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the rows of each class; those at CLASSES are left out."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # small numbers are sorted fast
    at = at[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out, kind = np.zeros((CLASSES + 1, rows.shape[1]), np.float32), np.float32 if rows.shape[1] % 2 else np.complex64  # two numbers in one addition
    out.view(kind)[at[begin]] = np.add.reduceat(rows_at(rows, order).view(kind), begin)
    return out[:CLASSES]


class Adam:
    """Steps down gradients from the model's weights."""

    def __init__(self, model: AttentionModel, rate: float):
        self.rate, self.step, self.flat = rate, 0, model.weights()
        model.set_weights(self.flat)
        self.mean, self.square = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def down(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        g = np.concatenate([gradients[k].ravel() for k in WEIGHTS])
        self.mean *= 0.9
        self.mean += 0.1 * g
        self.square *= 0.99
        g *= g
        g *= 0.01
        self.square += g
        np.sqrt(self.square, out=g)
        g *= (1 - 0.99**self.step) ** -0.5
        g += 1e-8
        np.divide(self.mean, g, out=g)
        g *= self.rate * min(1.0, self.step / 20) / (1 - 0.9**self.step)
        self.flat -= g


def make_classes(counts: np.ndarray, near: np.ndarray, singles: int = CLASSES // 2, seed: int = 3) -> np.ndarray:
    """The class of each id; the last id is the end of a text.

    By ``counts`` the most frequent ids and the end are classes of their own. The others are
    clustered by ``near``, sums of random vectors of their neighbours (k-means). Classes are
    then dealt into groups along the main direction of their neighbours.
    """
    rng = np.random.default_rng(seed)
    order = np.argsort(-counts[:-1], kind="stable")[: singles - 1]
    of = np.full(len(counts), -1, np.int64)
    of[order], of[-1] = np.arange(len(order)), len(order)
    x = near / np.sqrt((near * near).sum(1, keepdims=True) + 1e-9)
    rest = np.flatnonzero((of < 0) & (counts > 0))
    centres = x[rng.choice(rest, min(CLASSES - singles, len(rest)), replace=False)] if len(rest) else np.zeros((1, x.shape[1]))
    for _ in range(8 if len(rest) else 0):
        nearest = ((centres * centres).sum(1)[None] - 2 * x[rest] @ centres.T).argmin(1)
        n = np.bincount(nearest, minlength=len(centres))
        sums = np.stack([np.bincount(nearest, column, len(centres)) for column in x[rest].T], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        of[rest] = singles + nearest
    of[of < 0] = singles + int((centres * centres).sum(1).argmin())  # not seen
    middle = np.zeros((CLASSES, x.shape[1]))
    weight = np.bincount(of, counts, CLASSES)
    for j, column in enumerate(x.T):
        middle[:, j] = np.bincount(of, column * counts, CLASSES)
    middle = middle / np.maximum(weight, 1)[:, None]
    middle -= middle.mean(0)
    along = middle @ np.linalg.svd(middle, full_matrices=False)[2][0]
    place = np.empty(CLASSES, np.int64)
    place[np.argsort(along, kind="stable")] = np.arange(CLASSES)
    return place[of]


def from_counts(of: np.ndarray, pairs: np.ndarray, lefts: np.ndarray, weight: float = 4.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log rows for the last class (of groups, of members), and log shares, from counts of neighbours.

    ``pairs`` counts (class before, class), ``lefts`` (group to the left or none, id). Rows with
    few counts lean on those of all rows.
    """
    every = pairs.sum(0) + 0.1
    mixed = pairs + 5 * every / every.sum()
    grouped = mixed.reshape(CLASSES, GROUPS, MEMBERS)
    whole = grouped.sum(2)
    ids = lefts.sum(0) + 0.05
    base = ids / np.bincount(of, ids, CLASSES)[of]
    share = np.empty(lefts.shape, np.float32)
    for left, row in enumerate(lefts):
        share[left] = np.log((row + weight * base) / (np.bincount(of, row, CLASSES)[of] + weight))
    return np.log(whole / whole.sum(1, keepdims=True)).astype(np.float32), np.log(grouped / whole[:, :, None]).astype(np.float32), share


@dataclass
class Ids:
    """Subword ids of texts in turn, each text with its end."""

    ids: np.ndarray
    heads: np.ndarray  # which ids begin a word, the ends among them
    sizes: np.ndarray  # ids of each text
    shown: np.ndarray  # of each word, and end: whether it has any ids
    hashes: tuple[np.ndarray, np.ndarray]  # of each word
    n_words: np.ndarray

    @classmethod
    def of(cls, e: PieceEncoder, raw: np.ndarray, bounds: np.ndarray, end: int) -> Ids:
        raw = lower(raw)
        s = words(raw, bounds)
        hashes = wide_hashes(raw, s)
        take, lengths, ends = e.ids_at(e.numbers(raw, s, hashes))
        heads = np.zeros(len(take) + 1, bool)
        heads[(ends - lengths)[lengths > 0]] = True
        edge = np.concatenate([[0], ends])[s.first]
        return cls(np.insert(e.ids[take].astype(np.int64), edge[1:], end), np.insert(heads[: len(take)], edge[1:], True), np.diff(edge) + 1, np.insert(lengths > 0, s.first[1:], True), hashes, np.diff(s.first))


def left_of(ids: np.ndarray, heads: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The group to the left of each id inside its word; GROUPS for a word's first."""
    groups = of[ids] // MEMBERS
    return np.where(heads, GROUPS, np.concatenate([[0], groups[:-1]]))


def count_words(rows: DataFrame, held: int = 1_000_000) -> DataFrame:
    """(a, b, c): how often each word of ``rows(text)`` occurs, A-Z lower-cased, by its 128-bit hash."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n, keys = HashTable(), np.zeros(1 << 12, np.int64), []

        def made() -> pa.RecordBatch:
            a, b = (np.concatenate([k[i] for k in keys]).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n[: len(a)])], names=["a", "b", "n"])

        for batch in batches:
            for _, raw, bounds in parts(batch.column("text")):
                raw = lower(raw)
                a, b = wide_hashes(raw, words(raw, bounds))
                where = table.find(a, b)
                np.add.at(n, where[where >= 0], 1)
                left = np.flatnonzero(where < 0)
                at, times = distinct(a[left], b[left])
                a, b = a[left[at]], b[left[at]]
                table.add(a, b)
                keys.append((a, b))
                while len(n) < table.size:
                    n = np.concatenate([n, np.zeros_like(n)])
                n[table.size - len(at) : table.size] = times
                if table.size > held:
                    yield made()
                    table, n, keys = HashTable(), np.zeros(1 << 12, np.int64), []
        if table.size:
            yield made()

    counted = rows.select("text").mapInArrow(count, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("c"))


def encode_ids(rows: DataFrame, path: str, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``rows``, which have a column text, with (ids, heads) instead: each text's subword ids with its end, and bits that say which begin a word.

    With ``frequent``, the hashes of words: ``low`` and ``high`` too, halves of a number for each word of the
    text, which is odd if the word has any ids, and half of it one more than the word's place in ``frequent``
    (0: it has none); ``a`` and ``b`` are the hashes of those words that have none.
    """
    end = vocabulary_size(path)
    carried = [c for c in rows.columns if c != "text"]
    shared = None if frequent is None else rows.sparkSession.sparkContext.broadcast(frequent)

    @lean
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, keep_space=False)
        table = None if shared is None else table_of(*shared.value)
        for b in batches:
            for s, raw, bounds in parts(b.column("text"), 1 << 19):
                x = Ids.of(e, raw, bounds, end)
                edge, at = np.concatenate([[0], np.cumsum(x.sizes)]), np.concatenate([[0], np.cumsum(-(-x.sizes // 8))])
                bits = np.zeros(8 * at[-1], bool)
                bits[np.repeat(8 * at[:-1] - edge[:-1], x.sizes) + np.arange(len(x.ids))] = x.heads
                kind = _width(end)
                found = [*(b.column(c)[s] for c in carried), binary(x.ids.astype(kind).tobytes(), np.dtype(kind).itemsize * edge), binary(np.packbits(bits).tobytes(), at)]
                if table is not None:
                    place, first = table.find(*x.hashes), np.concatenate([[0], np.cumsum(x.n_words)])
                    inside = np.ones(len(x.shown), bool)
                    inside[first[1:] + np.arange(len(x.n_words))] = False  # the ends
                    number = 2 * (place.astype(np.int64) + 1) + x.shown[inside]
                    found += [binary(half.astype("<u2").tobytes(), 2 * first) for half in (number & 0xFFFF, number >> 16)]
                    rare = place < 0
                    some = pa.array(np.concatenate([[0], np.cumsum(rare)])[first].astype(np.int32))
                    found += [pa.ListArray.from_arrays(some, pa.array(h[rare].view(np.int64))) for h in x.hashes]
                yield pa.RecordBatch.from_arrays(found, names=columns.names)

    columns = StructType([StructField(c, rows.schema[c].dataType) for c in carried])
    for name, kind in (("ids", BinaryType()), ("heads", BinaryType()), *[(c, BinaryType()) for c in ("low", "high") if shared], *[(c, ArrayType(LongType())) for c in ("a", "b") if shared]):
        columns.add(name, kind)
    return stored(rows.select(*carried, "text").mapInArrow(code, columns), "ids")


def table_of(a: np.ndarray, b: np.ndarray) -> HashTable:
    table = HashTable(len(a))
    table.add(a, b)
    return table


def _width(end: int) -> str:
    return "<u2" if end < 1 << 16 else "<u4"


def decoded(b: pa.RecordBatch, end: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, heads and sizes of many texts at a time, from ``encode_ids``' columns; which rows these are."""
    kind = np.dtype(_width(end))
    for s, raw, bounds in parts(b.column("ids"), 1 << 19):
        sizes = np.diff(bounds) // kind.itemsize
        bits = np.unpackbits(text_bytes(b.column("heads")[s])[0]).astype(bool)
        edge, at = np.cumsum(sizes) - sizes, np.cumsum(-(-sizes // 8)) - -(-sizes // 8)
        yield s, raw.view(kind).astype(np.int64), bits[np.repeat(8 * at - edge, sizes) + np.arange(int(sizes.sum()))], sizes


def coded(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, heads and sizes of many texts at a time, from ``encode_ids``' columns."""
    for b in batches:
        for _, *found in decoded(b, end):
            yield tuple(found)


def lots(batches: Iterator[pa.RecordBatch], end: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts of one shard at a time, ``most`` ids or the last of them: shard, ids and sizes. What goes together depends on the shard alone."""
    kind, held, total, now = np.dtype(_width(end)), [], 0, None
    made = lambda: (now, np.concatenate(held).astype(np.int64), np.array([len(x) for x in held]))
    for b in batches:
        raw, bounds = text_bytes(b.column("ids"))
        for shard, x, y in zip(b.column("shard").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if held and (shard != now or total >= most):
                yield made()
                held, total = [], 0
            now = shard
            held.append(np.frombuffer(raw[x:y].tobytes(), kind))
            total += len(held[-1])
    if held:
        yield made()


def train_attention(rows: DataFrame, path: str, dim: int = 16, context: int = 16, rounds: int = 4, rate: float = 0.01, batch: int = 128, seed: int = 5) -> AttentionModel:
    """Learns the model from all texts of ``rows(lot, order, text)``, in tasks; the driver holds tables of fixed size.

    Texts are encoded once, unless ``encode_ids`` has made the rows. Three steps go over all of their ids. First, how often each id
    occurs, and what stands beside it (sums of a vector of whole numbers for each neighbour), which give the
    classes. Then counts of neighbouring classes, and of ids by the group to their left. Last the
    weights: each of ``rounds`` takes the texts whose ``lot`` is the round's (0 to rounds - 1; every
    text has one), dealt into shards of about SHARD ids by ``order``, a hash. Each shard, in the order of that
    hash, goes down its gradients from the same weights, every id a target once; the mean of what they
    reach, weighted by ids, begins the next round. All sums are of whole numbers, so neither
    partitions nor the order in which tasks end change the model.
    """
    spark = rows.sparkSession
    end = vocabulary_size(path)
    rng = np.random.default_rng(seed)
    signs, half = rng.integers(-64, 65, (4, end + 1)).astype(float), 4
    paired = signs[::2] + signs[1::2] * 2.0**26  # two whole numbers in one
    texts = rows if "ids" in rows.columns else encode_ids(rows, path)

    @lean
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, near = np.zeros(end + 1, np.int64), np.zeros((2 * half, end + 1))
        for ids, _, sizes in coded(batches, end):
            n += np.bincount(ids, minlength=end + 1)
            inside = np.ones(len(ids), bool)  # what follows an end is another text's
            inside[np.cumsum(sizes) - 1] = False
            one, two = ids[:-1][inside[:-1]], ids[1:][inside[:-1]]
            for i in range(0, len(one), 1 << 18):  # sums of so many are less than 2**25
                x, y = one[i : i + (1 << 18)], two[i : i + (1 << 18)]
                for j in range(0, half, 2):
                    for k, at, by in ((j, y, x), (half + j, x, y)):
                        both = np.bincount(at, paired[j // 2][by], end + 1)
                        high = np.rint(both * 2.0**-26)
                        near[k] += both - high * 2.0**26
                        near[k + 1] += high
        at = np.flatnonzero(n)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), *[pa.array(row[at]) for row in near]], names=["id", "n", *_NEAR])

    found = texts.select("ids", "heads").mapInArrow(neighbours, "id long, n long, " + ", ".join(f"{c} double" for c in _NEAR))
    found = found.groupBy("id").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _NEAR]).toPandas()
    counts, near = np.zeros(end + 1), np.zeros((end + 1, 2 * half))
    counts[found["id"]], near[found["id"]] = found["n"], found[_NEAR].to_numpy()
    of = make_classes(counts, near)
    del found, near
    give_back()

    @lean
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, lefts = np.zeros(CLASSES * CLASSES, np.int64), np.zeros((GROUPS + 1) * (end + 1), np.int32)
        last = int(of[-1])
        for ids, heads, _ in coded(batches, end):
            c = of[ids]
            pairs += np.bincount(np.concatenate([[last], c[:-1]]) * CLASSES + c, minlength=len(pairs))  # an end stands before each text
            np.add.at(lefts, left_of(ids, heads, of) * (end + 1) + ids, np.int32(1))
        table = np.concatenate([pairs, lefts])
        at = np.flatnonzero(table)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["at", "n"])

    # at most a row for each two classes, and for each id and group
    found = texts.select("ids", "heads").mapInArrow(tables, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(CLASSES * CLASSES + (GROUPS + 1) * (end + 1))
    table[found["at"]] = found["n"]
    del found
    give_back()
    pair_group, pair_member, share = from_counts(of, table[: CLASSES * CLASSES].reshape(CLASSES, CLASSES), table[CLASSES * CLASSES :].reshape(GROUPS + 1, end + 1))
    del table
    small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    model = AttentionModel(of, share, pair_group, pair_member, small(CLASSES, dim), small(CLASSES, dim), small(CLASSES, dim), np.zeros(context, np.float32), np.zeros((dim, GROUPS), np.float32), np.zeros((GROUPS, dim, MEMBERS), np.float32))
    shards = max(1, round(float(counts.sum()) / rounds / SHARD))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((of, pair_group, pair_member, model.weights()))
        pace = rate * (1 - turn / rounds)

        @lean
        def train(batches: Iterator[pa.RecordBatch], shared=shared, pace=pace, turn=turn) -> Iterator[pa.RecordBatch]:
            of, pair_group, pair_member, flat = shared.value
            shapes = [(CLASSES, dim)] * 3 + [(context,), (dim, GROUPS), (GROUPS, dim, MEMBERS)]
            m = AttentionModel(of, np.zeros((0, 0)), pair_group, pair_member, *[np.zeros(x, np.float32) for x in shapes])
            rows, total, reached, now, here = m.rows(), 0, np.zeros(len(flat), np.int64), None, 0
            for shard, ids, sizes in lots(batches, end, CHUNK):
                if shard != now:
                    reached += here * np.rint(m.weights().astype(float) * FINE).astype(np.int64)
                    m.set_weights(flat)
                    adam, order, now, here = Adam(m, pace), np.random.default_rng([seed, turn, shard]), shard, 0
                windows = m.prepared(of[ids], sizes)
                mixed = order.permutation(len(windows[0]))
                for i in range(0, len(mixed), batch):
                    adam.down(m.slopes(*(rows_at(x, mixed[i : i + batch]) for x in windows), rows))
                here, total = here + len(ids), total + len(ids)
            if total:
                reached += here * np.rint(m.weights().astype(float) * FINE).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([reached.tolist()], pa.list_(pa.int64()))], names=["ids", "weights"])

        shard = F.pmod(F.xxhash64("order", F.lit(seed)), F.lit(shards))
        dealt = texts.filter(F.col("lot") == turn).select("order", "ids", shard.alias("shard")).repartition("shard").sortWithinPartitions("shard", "order", "ids")
        reached = dealt.mapInArrow(train, "ids long, weights array<long>")
        # a row of weights for each task
        whole = "decimal(38,0)"
        mean = reached.select("ids", F.posexplode("weights")).groupBy("pos").agg((F.sum(F.col("col").cast(whole)).cast("double") / F.sum("ids") / FINE).alias("w")).toPandas()
        shared.unpersist()
        if len(mean):
            flat = np.zeros(len(mean), np.float32)
            flat[mean["pos"]] = mean["w"]
            model.set_weights(flat)
        give_back()
    if texts is not rows:
        discard(texts)
    return model


_NEAR = [f"v{i}" for i in range(8)]


def lm_scores(docs: DataFrame, training: Column, path: str, frequent: int = 1 << 18, attention: float = 0.6, rounds: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, training, n_tokens, n_known, train_tokens, base_score, score.

    Words are counted over all rows where ``training`` holds, each text with one end. The
    base is the sum of log10((c + 1) / (N + V + 1)) over a text's words and end; the score is the
    log10 probability of its words and end, each from its subword ids under an attention model
    (``train_attention``, on all training texts) with weight ``attention``, and by its count
    with the rest. Counts of at most ``frequent`` words, the commonest, are broadcast; the
    other words join theirs by a shuffle, each occurrence with what the attention model says
    of it, and are mixed there: the result is the same.

    Null and empty texts hold only the end. Without training rows every word is unknown. Rows
    that repeat an id have a result each; an empty table gives none.
    """
    spark = docs.sparkSession
    pa.set_memory_pool(pa.system_memory_pool())  # the driver too gives back what it has read
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(training, F.lit(False)).alias("training"), text.alias("text"))
    learned = rows.filter("training")
    counts = stored(count_words(learned), "words")
    n_ends = learned.count()
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_all, v_all = n_words + n_ends, v_words + (1 if n_ends else 0)
    total = float(n_all + v_all + 1)
    of_end = float(np.log10((n_ends + 1) / total))
    end = vocabulary_size(path)
    order = F.xxhash64("doc_id", "text")
    lot = F.pmod(F.xxhash64(order, F.lit(11)), F.lit(rounds))
    # the words above a count that at most ``frequent`` reach, by steps of an eighth of a power of two
    step = F.floor(F.log2("c") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).toPandas().sort_values("step", ascending=False)
    enough = steps["step"][steps["n"].cumsum() <= frequent]
    top = counts.filter(step >= int(enough.min()) if len(enough) else F.lit(False)).toPandas()
    hashes = tuple(top[k].to_numpy(np.int64).view(np.uint64) for k in "ab")
    logs = np.log10((top["c"].to_numpy(np.float64) + 1) / total)
    del top, steps
    give_back()
    # one pass over the texts: what follows reads their ids, and the places of their words in ``logs``
    texts = encode_ids(rows.select("doc_id", "training", lot.alias("lot"), order.alias("order"), "text"), path, hashes)
    model = train_attention(texts.filter("training").select("lot", "order", "ids", "heads"), path, rounds=rounds)
    shared = spark.sparkContext.broadcast((model, logs))
    give_back()

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value
        known = np.append(known, np.nan)
        weighed = (1 - attention) * 10.0**known
        for batch in batches:
            for s, ids, heads, sizes in decoded(batch, end):
                (low, edge), high = text_bytes(batch.column("low")[s]), text_bytes(batch.column("high")[s])[0]
                number, n = low.view("<u2") + (high.view("<u2").astype(np.int64) << 16), np.diff(edge) // 2
                place, text = (number >> 1) - 1, np.repeat(np.arange(len(n)), n)  # -1 has no count here
                base, ends = known[place], np.cumsum(n)
                rare, kept = np.isnan(base), np.ones(len(place) + len(n), bool)
                kept[ends + np.arange(len(n))] = False  # the ends
                shown, plain = np.ones(len(kept), bool), np.full(len(kept), (1 - attention) * 10.0**of_end)
                shown[kept], plain[kept] = number & 1, weighed[place]
                seen = np.full(len(plain), np.nan)
                seen[shown] = np.add.reduceat(m.score_ids(ids, left_of(ids, heads, m.of), sizes), np.flatnonzero(heads))
                mixed = np.exp(seen)
                mixed *= attention
                mixed += plain
                np.log(mixed, out=mixed)
                mixed /= np.log(10)
                seen /= np.log(10)
                bare = np.flatnonzero(~shown)
                mixed[bare] = np.log10(plain[bare] / (1 - attention))
                later = np.flatnonzero(rare) + text[rare]  # these are mixed once their counts have joined
                mixed[later] = 0
                at = pa.array(np.searchsorted(text[rare], np.arange(len(n) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[s], batch.column("training")[s], pa.array(n + 1), pa.array(n - np.bincount(text[rare], minlength=len(n))),
                    pa.array(np.bincount(text, np.where(rare, 0, base), len(n))), pa.array(np.add.reduceat(mixed, ends - n + np.arange(len(n)))),
                    batch.column("a")[s], batch.column("b")[s], pa.ListArray.from_arrays(at, pa.array(seen[later])),
                ], names=["doc_id", "training", "n_tokens", "n_known", "base", "score", "a", "b", "part"])

    columns = "doc_id long, training boolean, n_tokens long, n_known long, base double, score double, a array<long>, b array<long>, part array<double>"
    told = texts.select("doc_id", "training", "ids", "heads", "low", "high", "a", "b")
    scored = stored(told.mapInArrow(score, columns).withColumn("row", F.monotonically_increasing_id()), "scores")
    discard(texts)
    rest = scored.select("row", F.explode(F.arrays_zip("a", "b", "part")).alias("r")).select("row", "r.*")
    each = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(total))
    both = F.log10(F.lit(attention) * F.pow(F.lit(10.0), "part") + F.lit(1 - attention) * F.pow(F.lit(10.0), each))
    rest = rest.join(counts.hint("shuffle_hash"), ["a", "b"], "left").groupBy("row").agg(
        F.sum(each).alias("more"), F.count(F.when(F.col("c") > 0, 1)).alias("more_known"), F.sum(F.when(F.isnan("part"), each).otherwise(both)).alias("more_score")
    )
    return scored.drop("a", "b", "part").join(rest, "row", "left").select(
        "doc_id", "training", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if n_ends else 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(of_end)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
