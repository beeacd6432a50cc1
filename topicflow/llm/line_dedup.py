"""Line dedup: winnowed line hashes find runs that repeat earlier text, which are deleted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, stored
from .words import Spans, binary, lower, parts, span_hashes, text_bytes, words

#: The table of repeated fingerprints, where it is broadcast: 2**24 bits, while an eighth of them are set at most.
BITS = 1 << 24
_ENDS = np.isin(np.arange(256), list(b".!?"))
#: Lines of more words are cut; a fingerprint has GRAM words at least. A run of GUARANTEED words holds one.
LINE, GRAM = 12, 8
GUARANTEED = 5 * LINE + GRAM
#: Words known on either side of a fingerprint, which is as far as a run may reach beyond its last one; bytes a word.
CONTEXT, BYTES = 3 * LINE, 3
#: Odd multipliers, which make one number of an earlier text and a distance.
_RUNS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
#: Occurrences of one fingerprint that a task takes; more are dealt out. Hot fingerprints that are broadcast at most.
HOT, MOST_HOT = 2000, 1 << 18


def line_ends(raw: np.ndarray, s: Spans, hashes: np.ndarray, longest: int = LINE) -> np.ndarray:
    """Where the lines of texts end, as counts of words. ``raw``: the texts' bytes, ``hashes``: one for each word.

    A line ends with a text, at a line feed, and after a word that ends a sentence. One of more
    than ``longest`` words is cut further: of every ``longest`` words in a row in it, it is cut
    after the one with the least hash (the last on a tie), which depends on these words alone.
    So text set inside other text has the same lines wherever it stands, but for its edges.
    """
    n = len(s.starts)
    if not n:
        return np.zeros(0, np.int64)
    row = np.cumsum(raw == 10)[s.starts]
    last = np.append(row[1:] != row[:-1], True) | _ENDS[raw[s.stops - 1]]
    last[s.first[1:][s.first[1:] > s.first[:-1]] - 1] = True
    ends = np.flatnonzero(last) + 1
    sizes = np.diff(ends, prepend=0)
    line = np.repeat(np.arange(len(ends)), sizes)
    inside = np.flatnonzero((sizes > longest)[line])  # words of long lines
    if len(inside) >= longest:
        # hash and place in one number: the least has the least hash, and among equals the last place
        key = ((hashes[inside] >> np.uint64(32)) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(inside), dtype=np.uint64))
        least, width = key, 1
        while width < longest:
            step = min(width, longest - width)
            least, width = np.minimum(least[: len(least) - step], least[step:]), width + step
        whole = line[inside[: len(least)]] == line[inside[longest - 1 :]]
        last[inside[(np.uint64(0xFFFFFFFF) - (least[whole] & np.uint64(0xFFFFFFFF))).astype(np.int64)]] = True
        ends = np.flatnonzero(last) + 1
    return ends


def fingerprints(hashes: np.ndarray, ends: np.ndarray, first: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed fingerprints of texts: their hashes, first words and word counts.

    From each line on, lines are taken until they hold ``gram`` words: that is a fingerprint. Of
    every two of them in a row the one with the lesser hash is selected (the later on a tie).
    ``first``: the first word of each text, and the number of all words.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    text = np.searchsorted(first, starts, "right") - 1
    at = np.searchsorted(ends, starts + gram)
    known = at < len(ends)
    known[known] = ends[at[known]] <= first[text[known] + 1]
    starts, text, stops = starts[known], text[known], ends[at[known]]
    prints = span_hashes(hashes, Spans(starts, stops, first))
    alike = np.append(text[1:] == text[:-1], False)  # a pair begins here
    less = np.append(prints[:-1] < prints[1:], False)
    picked = np.zeros(len(prints), bool)
    picked[np.flatnonzero(alike & less)] = True
    picked[np.flatnonzero(alike & ~less) + 1] = True
    picked |= ~alike & ~np.append(False, alike[:-1])[: len(alike)]  # a text's only one
    return prints[picked].view(np.int64), starts[picked], (stops - starts)[picked]


def read_prints(raw: np.ndarray, bounds: np.ndarray) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, a hash of each (A-Z lower-cased), and the fingerprints."""
    raw = lower(raw)
    s = words(raw, bounds)
    hashes = span_hashes(raw, s)
    return s, hashes, *fingerprints(hashes, line_ends(raw, s, hashes), s.first)


def repeated_bits(repeated: DataFrame) -> np.ndarray:
    """Fingerprints that occur more than once, as BITS bits; at most 2**18 rows reach the driver."""
    bit = F.pmod(F.col("print"), F.lit(BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    rows = repeated.groupBy(F.shiftright(bit, 6).alias("slot")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def common_words(column: pa.Array, here: np.ndarray, there: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words of BYTES bytes, from the start or the end, the contexts ``here`` share with those ``there``."""
    raw, edges = text_bytes(column)
    known = np.zeros((len(raw) // BYTES, 4), np.uint8)
    known[:, :BYTES] = raw.reshape(-1, BYTES)
    edges = edges // BYTES
    n = np.minimum(np.diff(edges)[here], np.diff(edges)[there])
    most = int(n.max(initial=0))
    if not most:
        return n
    # a word is one number; margins take what lies beyond the first and last context
    word = np.concatenate([np.zeros(most, np.uint32), known.view(np.uint32).ravel(), np.zeros(most, np.uint32)])
    step = np.arange(most, dtype=np.int32)
    at = [((edges[k + 1] - 1 + most).astype(np.int32)[:, None] - step if back else (edges[k] + most).astype(np.int32)[:, None] + step) for k in (here, there)]
    same = word[at[0]] == word[at[1]]
    return np.minimum(n, np.where(same.all(1), most, same.argmin(1)))


def joined(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of one group that overlap or adjoin as one: groups, first words and ends. They come by group, and by first word in it."""
    if not len(a):
        return group, a, b
    other = np.append(True, group[1:] != group[:-1])
    base = np.cumsum(other) * (int(b.max()) + 1)  # no group reaches the next one's
    high = np.maximum.accumulate(b + base)
    new = other | np.append(True, (a + base)[1:] > high[:-1])
    return group[new], a[new], (high - base)[np.append(new[1:], True)]


def runs_of(doc: np.ndarray, run: np.ndarray, a: np.ndarray, b: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs to cut of many documents: document, first word and end, in this order. ``doc``, ``run``, ``a``, ``b``: the spans'."""
    order = np.lexsort((a, run, doc))
    doc, run, a, b = doc[order], run[order], a[order], b[order]
    other = np.append(True, (doc[1:] != doc[:-1]) | (run[1:] != run[:-1]))[: len(doc)]
    group, a, b = joined(np.cumsum(other) - 1, a, b)
    doc, long = doc[other][group], b - a >= min_words
    doc, a, b = doc[long], a[long], b[long]
    order = np.lexsort((a, doc))
    return joined(doc[order], a[order], b[order])


def cut_texts(texts: list[str], spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]], min_words: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts without their repeated runs of ``min_words`` or more, the words cut and the runs cut of each.

    ``spans``: run, first word and end of each of a text's. Those that were matched with one earlier text at one distance (``run``) and overlap or adjoin stand
    together there too, and make one run; those of fewer than ``min_words`` are left alone, whatever lies beside them.
    Runs that are long enough and touch are cut in one. A run goes with the white space after it.
    """
    n = len(texts)
    run, a, b = (np.concatenate([x[k] for x in spans]) if n else np.zeros(0, np.int64) for k in range(3))
    doc, a, b = runs_of(np.repeat(np.arange(n), [len(x[0]) for x in spans]), run, a, b, min_words)
    words_cut, runs_cut = np.bincount(doc, b - a, n).astype(np.int64), np.bincount(doc, minlength=n)
    out, hit = list(texts), np.flatnonzero(runs_cut)
    raws = [texts[i].encode("utf-8", "replace") for i in hit.tolist()]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in raws])]).astype(np.int64)
    raw, place = np.frombuffer(b"".join(raws), np.uint8), np.searchsorted(hit, doc)
    s = words(raw, bounds)
    at = np.append(s.starts, len(raw))
    edge = np.zeros(len(raw) + 1, np.int8)  # where cuts begin and end
    edge[at[s.first[place] + a]] += 1
    edge[np.where(s.first[place] + b < s.first[place + 1], at[s.first[place] + b], bounds[place + 1])] -= 1
    kept = np.cumsum(edge[:-1], dtype=np.int8) == 0
    left, ends = raw[kept].tobytes(), np.concatenate([[0], np.cumsum(kept)])[bounds].tolist()
    for i, x, y in zip(hit.tolist(), ends[:-1], ends[1:], strict=True):
        out[i] = left[x:y].decode("utf-8")
    return out, words_cut, runs_cut


def cut_spans(text: str | None, spans: tuple[np.ndarray, np.ndarray, np.ndarray] | None, min_words: int) -> tuple[str, int, int]:
    """``cut_texts`` of one text, which may have nothing to cut."""
    if spans is None:
        return text or "", 0, 0
    (left,), (n,), (runs,) = cut_texts([text or ""], [spans], min_words)
    return left, int(n), int(runs)


def _occurrences(rows: DataFrame, most_broadcast: int) -> DataFrame:
    """Every occurrence of a fingerprint that stands in two places or more, with the words around it."""
    spark = rows.sparkSession

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, raw, bounds in parts(b.column("text"), 1 << 20):
                prints, n = np.unique(read_prints(raw, bounds)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(prints), pa.array(n)], names=["print", "n"])

    counted = rows.select("text").mapInArrow(count, "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))
    repeated = stored(counted.filter("n > 1"), "repeated")
    hot = repeated.filter(F.col("n") > HOT).select(F.col("print").alias("group"), "n")

    def described(b: pa.RecordBatch, s: slice, x: Spans, hashes: np.ndarray, prints: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        """The fingerprints with their contexts, which end a line's length beyond the next one, or the one before.

        A run that holds the next one too is followed from there.
        """
        text = np.searchsorted(x.first, at, "right") - 1
        next_one = np.append(text[1:] == text[:-1], False)
        on = np.minimum(CONTEXT, np.where(next_one, np.maximum(np.append((at + sizes)[1:], 0) - at - sizes, 0) + LINE, CONTEXT))
        back = np.minimum(CONTEXT, np.where(np.append(False, next_one[:-1])[: len(at)], at - np.append(0, at[:-1])[: len(at)] + LINE, CONTEXT))
        known = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - BYTES :]).tobytes()
        ends = at + sizes
        low, high = np.maximum(x.first[text], at - back), np.minimum(x.first[text + 1], ends + on)
        some = [b"".join([known[BYTES * p : BYTES * q] for p, q in zip(f.tolist(), t.tolist(), strict=True)]) for f, t in ((low, at), (ends, high))]
        contexts = [binary(v, BYTES * np.concatenate([[0], np.cumsum(n)])) for v, n in zip(some, (at - low, high - ends), strict=True)]
        rows_of = pa.array(text)
        return pa.RecordBatch.from_arrays([pa.array(prints), b.column("doc_id")[s].take(rows_of), b.column("key")[s].take(rows_of), pa.array(at - x.first[text]), pa.array(sizes), *contexts], names=["print", "doc_id", "key", "at", "size", "before", "after"])

    if repeated.count() <= most_broadcast:
        shared = spark.sparkContext.broadcast(repeated_bits(repeated))

        @lean
        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = shared.value
            for b in batches:
                for s, raw, bounds in parts(b.column("text")):
                    x, hashes, prints, at, sizes = read_prints(raw, bounds)
                    bit = prints % BITS
                    again = np.flatnonzero((bits[bit >> 6] >> (bit & 63)) & 1)
                    yield described(b, s, x, hashes, prints[again], at[again], sizes[again])

        return _salted(rows.mapInArrow(marked, _FOUND), F.col("print"), hot)

    @lean
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, raw, bounds in parts(b.column("text")):
                x, _, prints, at, _ = read_prints(raw, bounds)
                rows_of = np.searchsorted(x.first, at, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(prints), b.column("key")[s].take(pa.array(rows_of)), pa.array(at - x.first[rows_of])], names=["print", "key", "at"])

    again = rows.mapInArrow(places, "print long, key long, at long").join(repeated, "print", "left_semi")
    again = again.groupBy("key").agg(F.collect_set("at").alias("places"))  # at most a document's own

    @lean
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, raw, bounds in parts(b.column("text")):
                x, hashes, prints, at, sizes = read_prints(raw, bounds)
                text = np.searchsorted(x.first, at, "right") - 1
                wanted = [set(v) for v in b.column("places")[s].to_pylist()]
                kept = np.flatnonzero([k in wanted[t] for t, k in zip(text.tolist(), (at - x.first[text]).tolist(), strict=True)])
                yield described(b, s, x, hashes, prints[kept], at[kept], sizes[kept])

    return _salted(rows.join(again, "key").select("doc_id", "key", "text", "places").mapInArrow(chosen, _FOUND), F.col("print"), hot)


def _salted(found: DataFrame, group: Column, hot: DataFrame) -> DataFrame:
    """With the group in place of the fingerprint, and a column salt: the occurrences of a hot group, of which ``hot(group, n)`` has a row, are dealt out; others have -1.

    So many hot groups as may be broadcast are, and the occurrences then move once, when they are sorted.
    """
    hot = hot.select(F.col("group").alias("__hot"), F.ceil(F.col("n") / HOT).alias("salts"))
    hot = F.broadcast(hot) if hot.count() <= MOST_HOT else hot
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", "key", "at"), F.col("salts")), F.lit(-1))
    dealt = found.withColumn("print", group).join(hot, F.col("print") == F.col("__hot"), "left")
    return dealt.select(*_NAMES, salt.alias("salt"))


_FOUND = "print long, doc_id long, key long, at long, size long, before binary, after binary"
_PLACE = ("print", "doc_id", "key", "at")


def _matched(found: DataFrame, salted: bool, min_words: int) -> DataFrame:
    """Each occurrence but its group's first, matched with that: a and b, the run's first word and its end. Where these are
    less than ``min_words`` it is matched with the one before, if that has more in common.

    ``run`` names the earlier text and how far before this place the match stands in it.

    Rows of (print, salt) are sorted by place in one task, which keeps but two. With
    ``salted`` the firsts of split groups come out too: those are to be matched in turn.
    """

    @lean
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the group that is open: its first, and the last one so far
        for b in batches:
            if not len(b):
                continue
            old = len(held)
            if held:
                b = pa.Table.from_batches([*held, b]).combine_chunks().to_batches()[0]
            group, salt, doc, key, at = (b.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("print", "salt", "doc_id", "key", "at"))
            size, place = b.column("size").to_numpy(), np.arange(len(b))
            new = np.ones(len(b), bool)
            new[1:] = (group[1:] != group[:-1]) | (salt[1:] != salt[:-1])
            first = np.maximum.accumulate(np.where(new, place, 0))
            elsewhere = lambda i, k: (key[i] != key[k]) | (at[i] != at[k]) | (doc[i] != doc[k])
            here = np.flatnonzero(~new & (place >= old))
            here = here[elsewhere(here, first[here])]

            def reach(here: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                low = at[here] - common_words(b.column("before"), here, there, back=True)
                return low, at[here] + size[here] + common_words(b.column("after"), here, there)

            there = first[here]
            low, high = reach(here, there)
            more = np.flatnonzero((high - low < min_words) & (here - 1 != there) & elsewhere(here, here - 1))
            low2, high2 = reach(here[more], here[more] - 1)
            longer = high2 - low2 > high[more] - low[more]
            more, low2, high2 = more[longer], low2[longer], high2[longer]
            there[more], low[more], high[more] = here[more] - 1, low2, high2
            split = np.flatnonzero(new & (salt >= 0) & (place >= old)) if salted else here[:0]
            rows = np.concatenate([here, split])
            nothing = pa.nulls(len(split), pa.int64())
            run = (key[there].view(np.uint64) * _RUNS[0] + (at[there] - at[here]).view(np.uint64) * _RUNS[1]).view(np.int64)
            ends = [pa.concat_arrays([pa.array(v), nothing]) for v in (run, low, high)]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(rows)) for c in _NAMES), *ends], names=[*_NAMES, "run", "a", "b"])
            begin, end = int(first[-1]), len(b) - 1
            held = [b.slice(begin, 1), *([b.slice(end, 1)] if end > begin else [])]

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(n, "print", "salt").sortWithinPartitions("print", "salt", "doc_id", "key", "at")
    return dealt.mapInArrow(follow, _FOUND + ", run long, a long, b long")


_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _packed(a: Column, b: Column) -> Column:
    """Two numbers of words as one."""
    return F.call_function("shiftleft", a, F.lit(32)).bitwiseOR(b)


def line_dedup(docs: DataFrame, min_words: int = 30, most_broadcast: int = BITS // 8) -> DataFrame:
    """``docs`` with repeated runs of text cut out of ``text``, and removed_words and removed_runs added.

    A run is ``min_words`` words or more, A-Z lower-cased, that also stand together earlier: at a
    smaller (doc_id, place). Shorter ones stay, also where several meet. Lines (``line_ends``) are hashed and winnowed (``fingerprints``); a run of
    GUARANTEED words holds a fingerprint wherever it stands, whatever its lines, and most runs
    of 30 do. Those that occur once are dropped: by a bitmap while at most ``most_broadcast``
    repeat, else by a join. Every other occurrence is set beside the first, and the match
    is extended both ways, word by word, by 24 bits of each word's hash. Between two of a run's
    fingerprints, and beyond its outer ones, lie at most CONTEXT words, so that the matches
    together cover the run from end to end. An occurrence that has less than ``min_words`` in common with
    it is set beside the one before, and then beside the first that also has the next, or the last, eight words in common:
    an earlier text may hold one line of a passage only. The first occurrence stays.

    Null and empty texts have nothing to cut (null becomes empty); null ids come first; rows
    that repeat an id and a text keep it all, as each is the other's first occurrence; rows
    that repeat an id with other texts are documents of their own. An empty table gives none.
    """
    key = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    short = (F.col("b") - F.col("a") < min_words) | F.col("a").isNull()
    matched = _matched(_occurrences(rows, most_broadcast), True, min_words)
    # of those that are long enough only the run is needed
    kept = [F.when(short, F.col(c)).alias(c) for c in _NAMES if c != "key"]
    matched = stored(matched.select(*kept, "key", "run", "a", "b"), "matched")
    spans = [matched.filter("a is not null")]
    # the firsts of split groups among themselves
    firsts = matched.filter("a is null").select(*_NAMES, F.lit(-1).cast("long").alias("salt"))
    firsts = stored(_matched(firsts, False, min_words), "firsts")
    again = matched.filter("a is not null").unionByName(firsts, allowMissingColumns=True).filter(short).select(*_NAMES)
    spans.append(firsts)
    for c, side in (("before", F.substring("before", -8 * BYTES, 8 * BYTES)), ("after", F.substring("after", 1, 8 * BYTES))):
        wide, group = again.filter(F.octet_length(c) >= 8 * BYTES), F.xxhash64("print", side)
        counts = stored(wide.groupBy(group.alias("group")).agg(F.count("*").alias("n")).filter(F.col("n") > HOT), f"wide-{c}")
        wide = _salted(wide, group, counts)
        # what comes out is a span, or the first of a split group, which is matched once more
        firsts_only = [F.when(F.col("a").isNull(), F.col(c)).alias(c) for c in _NAMES if c != "key"]
        once = stored(_matched(wide, True, min_words).select(*firsts_only, "key", "run", "a", "b"), f"matched-{c}")
        more = once.filter("a is null").select(*_NAMES, F.lit(-1).cast("long").alias("salt"))
        spans += [once.filter("a is not null"), _matched(more, False, min_words)]
    every = spans[0].select("key", "run", "a", "b")
    for more in spans[1:]:
        every = every.union(more.select("key", "run", "a", "b"))
    # a document's spans: about one for every few of its lines; dealt first, as lists of one span each would be dear to move
    dealt = every.repartition("key")
    every = stored(dealt.groupBy("key").agg(F.collect_list("run").alias("__run"), F.collect_list(_packed(F.col("a"), F.col("b"))).alias("__span")), "spans")

    @F.pandas_udf("struct<text string, removed_words long, removed_runs long>")
    @lean
    def cut(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, run, span in batches:
            out = pd.DataFrame({"text": "", "removed_words": 0, "removed_runs": 0}, index=range(len(texts)))
            some = np.flatnonzero(run.notna())
            sizes = np.cumsum([len(t or "") for t in texts.iloc[some]], dtype=np.int64)
            for at in np.split(some, np.flatnonzero(np.diff(sizes >> 20)) + 1):  # of about a million characters
                spans = [(r, s >> 32, s & 0xFFFFFFFF) for r, s in zip(run.iloc[at], span.iloc[at], strict=True)]
                for c, found in zip(out.columns, cut_texts([t or "" for t in texts.iloc[at]], spans, min_words), strict=True):
                    out.iloc[at, out.columns.get_loc(c)] = found
            yield out

    keyed = docs.withColumn("__key", key).join(every.withColumnRenamed("key", "__key"), "__key", "left")
    # one join moves the texts once; only those with something to cut go to Python
    some = F.col("__run").isNotNull()
    changed = keyed.withColumn("__cut", cut(F.when(some, F.col("text")), "__run", "__span"))
    changed = changed.withColumn("text", F.when(some, F.col("__cut.text")).otherwise(F.coalesce("text", F.lit(""))))
    changed = changed.withColumns({c: F.col(f"__cut.{c}") for c in ("removed_words", "removed_runs")})
    out: list[Column | str] = [*docs.columns, *[c for c in ("removed_words", "removed_runs") if c not in docs.columns]]
    return changed.select(*out)
