"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "long_words", "short_words", "distinct_words", "distinct_lines", "line_words",
    "upper", "digits", "stops", "commas", "marks", "symbols", "bars", "brackets", "other_bytes", "controls", "letters", "entropy",
)


def _class(chars: str) -> np.ndarray:
    at = np.zeros(256, bool)
    at[list(chars.encode())] = True
    return at


_CLASSES = {
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _class("0123456789"), "stops": _class("."), "commas": _class(",;:"),
    "marks": _class("!?"), "symbols": _class("#$%&*@^~+=_\\"), "bars": _class("|"), "brackets": _class("()[]{}<>/\"'`"),
    "other_bytes": np.arange(256) >= 128, "controls": (np.arange(256) < 32) & ~np.isin(np.arange(256), [9, 10, 13]),
    "letters": _class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128),
}
_CLASS_MATRIX = np.stack(list(_CLASSES.values()), axis=1).astype(np.float64)


def features(texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES per text, from the whole text; an empty or null text gives zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    counts = np.zeros((len(texts), 256))
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        if not raw:
            continue
        counts[i] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words, lines = raw.split(), raw.split(b"\n")
        n = max(1, len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out[i, :8] = (
            np.log1p(len(raw)), np.log1p(len(words)), sizes.sum() / n, (sizes > 12).sum() / n, (sizes < 4).sum() / n,
            len(set(words)) / n, len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)),
        )
    total = np.maximum(1, counts.sum(1, keepdims=True))
    share = counts / total
    out[:, 8:19] = share @ _CLASS_MATRIX
    out[:, 19] = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    return out


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(x), 0), int)


def _line_tree(grad: np.ndarray, hess: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """A tree over ordered bins with few leaves, as a step for every bin. Splits greedily by gain."""
    parts = [(0, len(grad))]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + smooth)
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            if b - a > 1:
                c = np.arange(a + 1, b)
                gain = value(a, c) + value(c, b) - value(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), (a, b), int(c[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        (a, b), c = best[1], best[2]
        parts.remove((a, b))
        parts += [(a, c), (c, b)]
    step = np.zeros(len(grad))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + smooth)
    return step


def _square_tree(grad: np.ndarray, hess: np.ndarray, smooth: float) -> tuple[np.ndarray, float]:
    """A tree of depth two over a grid: one split of the rows, then one of the columns on either side."""
    best_gain, best = 0.0, np.zeros_like(grad)
    for swap in (False, True):
        g, h = (grad.T, hess.T) if swap else (grad, hess)
        up_g, up_h = np.cumsum(g, 0), np.cumsum(h, 0)
        whole = up_g[-1].sum() ** 2 / (up_h[-1].sum() + smooth)
        for cut in range(1, len(g)):
            step, gain = np.zeros_like(g), -whole
            for side, sg, sh in ((slice(0, cut), up_g[cut - 1], up_h[cut - 1]), (slice(cut, None), up_g[-1] - up_g[cut - 1], up_h[-1] - up_h[cut - 1])):
                lg, lh = np.cumsum(sg), np.cumsum(sh)
                rg, rh = lg[-1] - lg, lh[-1] - lh
                scores = lg**2 / (lh + smooth) + rg**2 / (rh + smooth)
                k = int(scores.argmax())
                gain += scores[k]
                step[side, : k + 1], step[side, k + 1 :] = lg[k] / (lh[k] + smooth), rg[k] / (rh[k] + smooth)
            if gain > best_gain:
                best_gain, best = gain, step.T if swap else step
    return best, best_gain


@dataclass
class AdditiveModel:
    """A table per feature and per chosen pair of features; the score is the logistic of their sum."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        fine, coarse = _bins(x, self.edges), _bins(x, self.coarse)
        for k, table in enumerate(self.tables):
            total += table[fine[:, k]]
        for i, j, table in self.pairs:
            total += table[coarse[:, i], coarse[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, leaves: int = 3, n_bins: int = 64, n_coarse: int = 12, n_pairs: int = 8, smooth: float = 5.0) -> AdditiveModel:
    """Cyclic boosting: each round visits every feature in turn with a shallow tree over its bins.

    The single features come first; the pairs that then explain most of what is left are
    boosted in the same manner. No rows, or rows of one label, give that label's share alone.
    """
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(y) < 2 or len(np.unique(y)) < 2:
        return model
    cut = lambda n: [np.unique(np.quantile(c, np.arange(1, n) / n)) for c in x.T]
    model.edges, model.coarse = cut(n_bins), cut(n_coarse)
    fine, coarse = _bins(x, model.edges), _bins(x, model.coarse)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _line_tree(np.bincount(fine[:, k], g, len(table)), np.bincount(fine[:, k], h, len(table)), leaves, smooth)
            table += step
            total += step[fine[:, k]]
    g, h = slopes()

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        a, b = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(coarse[:, i] * b + coarse[:, j], v, a * b).reshape(a, b)

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_square_tree(grid(*p, g), grid(*p, h), smooth)[1])
    model.pairs = [(i, j, np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))) for i, j in ranked[:n_pairs]]
    for _ in range(rounds // 4):
        for i, j, table in model.pairs:
            g, h = slopes()
            step = rate * _square_tree(grid(i, j, g), grid(i, j, h), smooth)[0]
            table += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def _in_parts(texts: pd.Series, n: int = 500) -> Iterator[list]:
    for i in range(0, len(texts), n):
        yield texts.iloc[i : i + n].tolist()


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> AdditiveModel:
    """Learns ``label`` (0 or 1) from the texts of the labelled documents.

    ``labels`` has (doc_id, label): rows with a null in either are left out, and a document
    labelled twice counts with its larger label. At most ``max_rows`` documents are used, those
    whose ids hash lowest: this bound is what may be broadcast and what the driver fits on.
    """
    lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 31))
    rows = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    few = lot < int((1 << 31) * min(1.0, 1.5 * max_rows / max(1, rows.count())))  # else every partition would send so many
    rows = rows.filter(few).orderBy(lot, "doc_id").limit(max_rows)

    @lean
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i : i + 500]
                yield pd.DataFrame({"doc_id": part["doc_id"], "y": part["y"], "x": list(features(part["text"].tolist()))})

    measured = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").mapInPandas(measure, "doc_id long, y int, x array<double>").toPandas()
    measured = measured.sort_values("doc_id", kind="stable")
    x = np.array(measured["x"].tolist()).reshape(len(measured), len(FEATURES))
    return fit_additive(x, measured["y"].to_numpy(np.float64))


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """A column of scores from 0 to 1, from the text alone; null and empty texts have one too."""

    @F.pandas_udf("double")
    @lean
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.concatenate([model.score(features(part)) for part in _in_parts(texts)] or [np.zeros(0)]))

    return score(text)
