"""BPE encoding and decoding; long texts are encoded in parallel halves joined exactly."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import lean
from .tokens import encoder, load
from .words import binary, parts

#: Pieces that a worker keeps with their ids, and leaves that are encoded at a time.
PIECES, LEAVES = 1 << 18, 32
#: One leaf of a long text: ids, and the characters each id stands for.
Leaf = tuple[str, np.ndarray, np.ndarray]


def halves(text: str, leaf_chars: int) -> list[str]:
    """The text cut in halves until none is longer than a leaf; cuts fall anywhere."""
    if len(text) <= leaf_chars:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf_chars) + halves(text[middle:], leaf_chars)


def join_pair(left: Leaf, right: Leaf, encode) -> Leaf:
    """The encoding of both texts as one.

    Ids around the join are encoded again in a window that doubles until its first id is the
    left side's own there and one of its inner ids is the right side's own. BPE ids are right
    if every two neighbours are, and each pair of neighbours then comes from one of the three
    encodings. Ids may share a character; a window starts and ends between characters.
    """
    (lt, li, ls), (rt, ri, rs) = left, right
    text, shift = lt + rt, len(lt)
    if not len(li) and not lt.strip(" "):
        return text, ri, rs + shift
    if not len(ri) and not rt.strip(" "):
        return text, li, ls
    k = 4
    while True:
        i, j = max(0, len(li) - k), min(len(ri), k)
        while i > 0 and ls[i - 1, 1] > ls[i, 0]:
            i -= 1
        while 0 < j < len(ri) and rs[j, 0] < rs[j - 1, 1]:
            j += 1
        first = int(ls[i, 0]) if i else 0
        last = shift + (int(rs[j - 1, 1]) if 0 < j < len(ri) else len(rt))
        wi, ws = encode(text[first:last])
        ws = ws + first
        agreed_left = not i or (len(wi) and wi[0] == li[i] and (ws[0] == ls[i]).all())
        q, r = len(wi), len(ri)
        agreed_right = j == len(ri)
        if not agreed_right:
            at = {(int(a), int(b), int(c)): n for n, (a, (b, c)) in enumerate(zip(wi[:-1], ws[:-1], strict=True))}
            for n in range(j - 2, -1, -1):
                key = (int(ri[n]), int(rs[n, 0]) + shift, int(rs[n, 1]) + shift)
                if key in at and (n + 1 >= len(ri) or rs[n + 1, 0] >= rs[n, 1]):
                    q, r, agreed_right = at[key] + 1, n + 1, True
                    break
        if agreed_left and agreed_right:
            return text, np.concatenate([li[:i], wi[:q], ri[r:]]), np.concatenate([ls[:i], ws[:q], rs[r:] + shift])
        k *= 2


def join_tree(leaves: list[Leaf], encode) -> Leaf:
    while len(leaves) > 1:
        pairs = [join_pair(leaves[i], leaves[i + 1], encode) for i in range(0, len(leaves) - 1, 2)]
        leaves = pairs + leaves[len(pairs) * 2 :]
    return leaves[0]


@lru_cache(maxsize=4)
def _splitter(path: str):
    """The tokenizer's normalizer, and a pattern for its special tokens."""
    t = load(path)
    special = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
    return t.normalizer, special, re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None


def _units(text: str, path: str) -> list[tuple[str, int]]:
    """Normalised runs of ordinary text, and special tokens as (string, id); ids of runs are -1."""
    normalizer, special, pattern = _splitter(path)
    parts = pattern.split(text) if pattern else [text]
    return [(p, special[p]) if p in special else (normalizer.normalize_str(p) if normalizer else p, -1) for p in parts if p]


class Decoder:
    """The library's decode(ids, skip_special_tokens=False), by a table where the file has no decoder."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.names = None
        if self.tokenizer.decoder is None:  # the library then puts a space between the tokens' strings
            self.names = np.array([self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())], object)

    def __call__(self, ids: np.ndarray) -> str:
        return " ".join(self.names[ids]) if self.names is not None else self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def library(path: str) -> Tokenizer:
    return load(path, plain=True)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode_documents(docs: DataFrame, path: str, decode: bool = False, leaf_chars: int = 32_768) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every row.

    With ``decode`` also ``decoded``, the text the ids decode to, made in the same tasks.

    As the tokenizers library encodes with this file (one that drops white space) and
    add_special_tokens=False. A text of more than ``leaf_chars`` characters is normalised, cut
    in halves down to leaves, its leaves are encoded in parallel tasks, and the parts are
    joined pairwise in one task per text (``join_pair``). Null and empty texts have no ids.
    Rows that repeat a doc_id and text come out as often as they went in.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))
    out = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode

    def result(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        edges = np.concatenate([[0], np.cumsum(sizes)])
        made = [doc_ids, pa.array(sizes.astype(np.int64)), binary(ids.astype("<u4").tobytes(), 4 * edges)]
        if decode:
            made.append(pa.array([decoder(path)(ids[x:y]) for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], "string"))
        return pa.RecordBatch.from_arrays(made, names=["doc_id", "n_tokens", "ids", "decoded"][: len(made)])

    @lean
    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, keep_space=False, most=PIECES)
        for b in batches:
            for s, raw, bounds in parts(b.column("text")):
                ids, sizes = e.encode(raw, bounds)
                yield result(b.column("doc_id")[s], sizes, ids)

    @lean
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, key, t in zip(b["doc_id"], b["key"], b["text"], strict=True):
                rows = [(u, n, leaf, i) for u, (part, i) in enumerate(_units(t, path)) for n, leaf in enumerate(halves(part, leaf_chars) if i < 0 else [part])]
                yield pd.DataFrame({"doc_id": pd.array([d] * len(rows), "Int64"), "key": key, "unit": [r[0] for r in rows], "leaf": [r[1] for r in rows], "text": [r[2] for r in rows], "special": [r[3] for r in rows]})

    def encode(t: str) -> tuple[np.ndarray, np.ndarray]:
        x = library(path).encode(t, add_special_tokens=False)
        return np.array(x.ids, np.uint32), np.array(x.offsets, np.int64).reshape(-1, 2)

    @lean
    def encode_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (whole.iloc[i : i + LEAVES] for whole in batches for i in range(0, len(whole), LEAVES)):
            found = [encode(t) if i < 0 else (np.array([i], np.uint32), np.zeros((1, 2), np.int64)) for t, i in zip(b["text"], b["special"], strict=True)]
            yield b.assign(ids=[x[0].astype("<u4").tobytes() for x in found], spans=[x[1].astype("<i4").tobytes() for x in found])

    def join_up(table: pa.Table) -> pa.Table:
        b = table.to_pandas()
        copies = int(((b["unit"] == 0) & (b["leaf"] == 0)).sum())
        doc_id = table.column("doc_id")[0].as_py()
        b = b.drop_duplicates(["unit", "leaf"]).sort_values(["unit", "leaf"])
        parts = [(t, np.frombuffer(i, "<u4"), np.frombuffer(s, "<i4").reshape(-1, 2).astype(np.int64)) for t, i, s in zip(b["text"], b["ids"], b["spans"], strict=True)]
        units = b["unit"].to_numpy()
        ids = np.concatenate([join_tree([parts[k] for k in np.flatnonzero(units == u)], encode)[1] for u in np.unique(units)])
        return pa.Table.from_batches([result(pa.array([doc_id] * copies, "int64"), np.full(copies, len(ids)), np.tile(ids, copies))])

    is_long = F.char_length("text") > leaf_chars
    leaves = docs.filter(is_long).withColumn("key", F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"), 256)).mapInPandas(cut, "doc_id long, key string, unit int, leaf int, text string, special int")
    encoded = leaves.repartition("key", "unit", "leaf").mapInPandas(encode_leaves, "doc_id long, key string, unit int, leaf int, text string, special int, ids binary, spans binary")
    return docs.filter(~is_long).mapInArrow(short, out).union(encoded.groupBy("key").applyInArrow(join_up, out))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``: the library's decode(ids, skip_special_tokens=False). No ids: the empty string."""

    @lean
    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i : i + 500]
                yield part.assign(decoded=[decoder(path)(np.frombuffer(x, "<u4")) for x in part["ids"]])

    return encoded.mapInPandas(decoded, encoded.schema.simpleString()[7:-1].replace(":", " ") + ", decoded string")
