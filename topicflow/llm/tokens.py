"""Exact encoding with a public tokenizer, one library call per distinct piece of text."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from .words import HashTable, Spans, distinct, lower, spans_of, wide_hashes

#: Bytes of characters that the lower-casing normalizer leaves as long as they are, and that are no white space: ! to ~, and those of two bytes up to U+017F.
_SIMPLE = np.isin(np.arange(256), [*range(33, 127), *range(0x80, 0xC0), *range(0xC2, 0xC6)])
#: What such pieces are normalized and split by where ``split`` does the same: runs of letters, single digits, runs of others.
_NORMALIZER = b'{"type":"Sequence","normalizers":[{"type":"NFC"},{"type":"Replace","pattern":{"Regex":"\\\\s+"},"content":" "},{"type":"Lowercase"}]}'
_PRE_TOKENIZER = (
    b'{"type":"Sequence","pretokenizers":[{"type":"Split","pattern":{"Regex":"\'s|\'t|\'re|\'ve|\'m|\'ll|\'d|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+"},'
    b'"behavior":"Removed","invert":true},{"type":"ByteLevel","add_prefix_space":false,"trim_offsets":true,"use_regex":false}]}'
)
#: ASCII letters, digits and others; and what ``split`` doesn't do: characters beyond ASCII, contractions, special tokens.
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(97, 123)]], _KIND[[*range(48, 58)]], _KIND[32] = 1, 2, 0
_NOT_SPLIT = np.isin(np.arange(256), [*b"'<", *range(128, 256)])
#: White space and its kin among ASCII.
_WIDE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])


def _odd(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to other characters than _SIMPLE's, or spaces: U+0080 to U+00A0 and U+0130 do too."""
    odd = ~_SIMPLE[data]
    odd[data == 32] = False
    after = data[1:]
    odd[:-1] |= ((data[:-1] == 0xC2) & (after <= 0xA0)) | ((data[:-1] == 0xC4) & (after == 0xB0))
    return odd


@lru_cache(maxsize=4)
def _loaded(path: str, plain: bool) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    if plain:
        tokenizer.normalizer = None
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = plain
    return tokenizer


def load(path: str, plain: bool = False) -> Tokenizer:
    """The tokenizer of a file, one per process; it is not to be changed.

    plain: without its normalizer, and with special tokens' strings as ordinary text. The library
    runs without threads of its own: Spark's tasks keep the cores busy, and each thread would hold
    memory of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _loaded(path, plain)


class PieceEncoder:
    """Encodes texts as the tokenizers library does, keeping the ids of pieces it has seen.

    ``keep_space``: the tokenizer's words begin with their space (byte-level); a space before a
    non-space always starts a word there, so a text is its first piece and others that begin
    with a space each. Otherwise white space is dropped, and every space or line feed separates
    words. Either way a text's ids are its pieces' ids in turn. Pieces are found, hashed to 128
    bits and looked up by numpy, whole batches at a time; only new ones become strings. These are
    encoded many to a text, and told apart by the bytes that each id stands for. A text that
    holds a special token's opening is one piece where spaces count. Where the file's rules are
    the known ones, pieces of ASCII are lower-cased and split by numpy and go to the same model
    without the library's regular expressions. The store is bounded:
    beyond ``most`` pieces, or eight times as many ids, it starts anew.
    """

    def __init__(self, path: str, keep_space: bool, most: int = 1_000_000):
        self.tokenizer = load(path)
        self.keep_space, self.most = keep_space, most
        special = self.tokenizer.get_added_tokens_decoder()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.sizes = np.array([1 << 20 if i in special else len(n.removesuffix("</w>")) for i, n in enumerate(names)], np.int64)
        known = self.tokenizer.normalizer is not None and self.tokenizer.pre_tokenizer is not None and all("<" in x.content for x in special.values())
        known = known and (self.tokenizer.normalizer.__getstate__(), self.tokenizer.pre_tokenizer.__getstate__()) == (_NORMALIZER, _PRE_TOKENIZER)
        self.split = None if keep_space or not known else Tokenizer(self.tokenizer.model)  # the model is not copied
        if self.split is not None:
            self.split.pre_tokenizer = WhitespaceSplit()
        self.generation = 0
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int32)
        self.lengths = np.zeros(1 << 14, np.int32)
        self.used = self.count = 0
        self.generation += 1

    def pieces(self, raw: np.ndarray, bounds: np.ndarray) -> Spans:
        if not self.keep_space:
            return spans_of((raw != 32) & (raw != 10), bounds)
        n = len(raw)
        cut = raw == 32
        after = np.full(n + 2, 32, np.uint8)
        after[:n] = raw
        cut &= ~_BLANK[after[1 : n + 1]]
        wide = np.flatnonzero(cut & _WIDE[after[1 : n + 1]])  # may begin white space beyond ASCII
        if len(wide):
            x, y = after[wide + 1], after[wide + 2]
            cut[wide[((x == 0xC2) & ((y == 0x85) | (y == 0xA0))) | ((x == 0xE1) & (y == 0x9A)) | ((x == 0xE2) & ((y == 0x80) | (y == 0x81))) | ((x == 0xE3) & (y == 0x80))]] = False
        for at in np.unique(np.searchsorted(bounds, np.flatnonzero((raw == 60) & (after[1 : n + 1] == 124)), "right") - 1).tolist():
            cut[bounds[at] : bounds[at + 1]] = False  # holds "<|"
        begins = bounds[:-1][bounds[:-1] < bounds[1:]]
        ends = bounds[1:][bounds[:-1] < bounds[1:]]
        cut[ends - 1] = False  # a space at the end of a text is its last piece's
        cut[begins] = True
        starts = np.flatnonzero(cut)
        return Spans(starts, np.append(starts[1:], n) if len(starts) else starts, np.searchsorted(starts, bounds))

    def _keep(self, ids: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> None:
        """Ids of new pieces in turn; at: the pieces' numbers."""
        total = self.used + len(ids)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : total] = ids
        self.lengths[at] = lengths
        self.starts[at] = self.used + np.cumsum(lengths) - lengths
        self.used = total

    def _learn_each(self, new: list[str], at: np.ndarray) -> None:
        for s in range(0, len(new), 512):  # the library's result objects are large
            rows = [x.ids for x in self.tokenizer.encode_batch_fast(new[s : s + 512], add_special_tokens=False)]
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
            self._keep(np.fromiter((i for r in rows for i in r), np.uint32, int(lengths.sum())), lengths, at[s : s + 512])

    def _learn_many(self, tokenizer: Tokenizer, at: np.ndarray, sizes: np.ndarray, data: np.ndarray, room: np.ndarray) -> list[np.ndarray]:
        """Pieces of so many bytes, each with its gap in so much of ``data``; returns those whose ids can't be told apart by bytes."""
        odd, whole, gap = [], data.tobytes(), 0 if self.keep_space else 1
        ends, stops = np.cumsum(sizes), np.concatenate([[0], np.cumsum(room)])
        for s in range(0, len(at), 4096):
            some = at[s : s + 4096]
            cuts = stops[[*range(s, s + len(some), 128), s + len(some)]].tolist()
            try:
                texts = [whole[x : y - gap].decode() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            except UnicodeDecodeError:
                odd.append(some)
                continue
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            to, goal = np.cumsum(self.sizes[ids]), ends[s : s + len(some)] - (ends[s - 1] if s else 0)
            last = np.searchsorted(to, goal)
            if len(to) != last[-1] + 1 or (to[last] != goal).any():
                odd.append(some)
            else:
                self._keep(ids, np.diff(last, prepend=-1), self.count + some)
        return odd

    def _learn(self, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        """Gives the next numbers to these pieces."""
        sizes = stops - starts
        while self.count + len(starts) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        # the pieces one behind the other; each is followed by a space if its own spaces are not kept
        room = sizes if self.keep_space else sizes + 1
        edge = np.concatenate([[0], np.cumsum(room)])
        data = np.full(edge[-1], 32, np.uint8)
        run = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data[np.repeat(edge[:-1], sizes) + run] = raw[np.repeat(starts, sizes) + run]
        holds = lambda which: np.add.reduceat(which, edge[:-1], dtype=np.int64) > 0
        many = (raw[starts] == 32 if self.keep_space else ~holds(_odd(data))) & (sizes < 1000)
        odd = [np.flatnonzero(~many)]
        if self.split is not None:
            own = many & ~holds(_NOT_SPLIT[data])
            many &= ~own
            part, at = lower(data[np.repeat(own, room)]), np.flatnonzero(own)
            kind = _KIND[part]
            cut = np.flatnonzero((kind[:-1] > 0) & (kind[1:] > 0) & ((kind[:-1] != kind[1:]) | (kind[1:] == 2))) + 1
            more = np.diff(np.searchsorted(cut, np.concatenate([[0], np.cumsum(room[own])])))
            odd += self._learn_many(self.split, at, sizes[own], np.insert(part, cut, 32), room[own] + more)
        odd += self._learn_many(self.tokenizer, np.flatnonzero(many), sizes[many], data[np.repeat(many, room)], room[many])
        left = np.concatenate(odd)
        self._learn_each([raw[starts[i] : stops[i]].tobytes().decode("utf-8", "replace") for i in left.tolist()], self.count + left)
        self.count += len(starts)

    def numbers(self, raw: np.ndarray, s: Spans, hashes: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """The number of each piece in the store, where new ones are entered."""
        if self.count > self.most or self.used > 8 * self.most:
            self._clear()
        a, b = wide_hashes(raw, s) if hashes is None else hashes
        where = self.table.find(a, b)
        missing = np.flatnonzero(where < 0)
        if len(missing):
            one = missing[distinct(a[missing], b[missing])[0]]
            self._learn(raw, s.starts[one], s.stops[one])
            self.table.add(a[one], b[one])
            where[missing] = self.table.find(a[missing], b[missing])
        return where

    def ids_at(self, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each piece stand, how many they are, and where they end."""
        lengths = self.lengths[where].astype(np.int64)
        ends = np.cumsum(lengths)
        take = np.repeat(self.starts[where] - (ends - lengths), lengths)
        take += np.arange(len(take))
        return take, lengths, ends

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in turn, and the number of ids of each text."""
        s = self.pieces(raw, bounds)
        take, _, ends = self.ids_at(self.numbers(raw, s))
        edge = np.concatenate([[0], ends])
        return self.ids[take], edge[s.first[1:]] - edge[s.first[:-1]]


_encoders: dict[tuple, PieceEncoder] = {}


def encoder(path: str, keep_space: bool, most: int = 1_000_000) -> PieceEncoder:
    """One per Python worker, kept from task to task."""
    key = (path, keep_space, most)
    if key not in _encoders:
        if len(_encoders) > 1:
            _encoders.clear()  # of other files: workers live on from job to job
        _encoders[key] = PieceEncoder(path, keep_space, most)
    return _encoders[key]
