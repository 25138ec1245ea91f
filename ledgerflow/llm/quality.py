"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Shallow trees on one feature at a time are boosted in
cycles over the features, and each tree is added into that feature's lookup table (one value per
bin). Then the pairs of features that explain most of what is left get two-way tables, boosted in
the same way. A score is the logistic of the intercept plus one table value per feature and pair:
a few vectorised additions.

The fit runs on the driver over a sample of at most ``sample_rows`` labelled rows (features only,
about 150 bytes each); the features of all texts are computed and scored in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, rows, utf8

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.1
SMOOTH = 2.0

FEATURES = ("log_words", "mean_word", "upper", "digit", "stop", "exclaim", "pipe", "symbol",
            "other_punct", "high_byte", "line_feed", "long_words", "short_words", "distinct_words",
            "distinct_pairs", "top_word", "repeat_next", "distinct_lines", "mean_line",
            "words_ending_in_sign")


def _classes() -> np.ndarray:
    """256 x 8 table: which of the counted classes a byte is in."""
    out = np.zeros((256, 8))
    for c, chars in enumerate((range(65, 91), range(48, 58), b".,;:", b"!?", b"|", b"#$%&*@~^+=<>{}[]\\_",
                               b"\"'()-/`", range(128, 256))):
        out[list(chars), c] = 1
    return out


CLASSES = _classes()


def features(text: bytes) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``; all 0 without words."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    upper, digit, stop, exclaim, pipe, symbol, other, high = (
        np.bincount(np.frombuffer(text, dtype="u1"), minlength=256) @ CLASSES) / size
    lengths = np.fromiter(map(len, words), dtype="i4", count=n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = text.split(b"\n")
    repeats = sum(map(eq, words, words[1:]))
    ends = sum(1 for w in counts if w[-1] in b"!#$%&*|") / len(counts)
    return [float(np.log1p(n)), float(lengths.mean()), upper, digit, stop, exclaim, pipe, symbol,
            other, high, len(lines) / n, float((lengths > 14).mean()), float((lengths < 4).mean()),
            len(counts) / n, len(set(zip(words, words[1:]))) / n, max(counts.values()) / n,
            repeats / n, len(set(lines)) / len(lines), float(np.log1p(size / len(lines))), ends]


@dataclass
class Model:
    """Lookup tables. ``cuts`` bin a feature; ``tables`` add one value per bin; ``pairs`` add one
    value per cell of two coarser binnings."""
    intercept: float
    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for i, j, ci, cj, table in self.pairs:
            out += table[np.searchsorted(ci, x[:, i], side="right"),
                         np.searchsorted(cj, x[:, j], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Quantile cuts half-way between neighbouring distinct values."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def _leaf(g, h):
    return g / (h + SMOOTH)


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """The best place to cut bins [lo, hi) in two, by the second-order gain."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
    gains = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
    best = int(np.argmax(gains))
    return float(gains[best]), lo + best + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A shallow tree on one binned feature, as one value per bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, cut, part = max((*_best_cut(g, h, *p), p) for p in parts)
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], cut), (cut, part[1])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of depth two on a pair: one cut of the first feature, then one of the second on each
    side. Returns the gain and a value per cell."""
    best, out = 0.0, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for cut in range(1, g.shape[0]):
        table, total = np.zeros_like(g), -whole
        for a, b in ((0, cut), (cut, g.shape[0])):
            gs, hs = g[a:b].sum(axis=0), h[a:b].sum(axis=0)
            _, c = _best_cut(gs, hs, 0, len(gs))
            for lo, hi in ((0, c), (c, len(gs))):
                if hi > lo:
                    total += _gain(gs[lo:hi].sum(), hs[lo:hi].sum())
                    table[a:b, lo:hi] = _leaf(gs[lo:hi].sum(), hs[lo:hi].sum())
        if total > best:
            best, out = total, table
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on rows ``x`` with labels ``y`` (0 or 1). Without rows every score is 0.5; with one label
    only, the smoothed share of that label."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    model = Model(float(np.log(share / (1 - share))))
    if n == 0 or y.min() == y.max():
        return model
    model.cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    logit = np.full(n, model.intercept)

    def slopes(cells, size):
        p = 1 / (1 + np.exp(-logit))
        return (np.bincount(cells, weights=y - p, minlength=size),
                np.bincount(cells, weights=p * (1 - p), minlength=size))

    for _ in range(ROUNDS):
        for j, cells in enumerate(binned):
            step = RATE * _tree(*slopes(cells, len(model.tables[j])))
            model.tables[j] += step
            logit += step[cells]

    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]
    found = []
    for i, j in combinations(range(x.shape[1]), 2):
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        cells = at[i] * shape[1] + at[j]
        g, h = slopes(cells, shape[0] * shape[1])
        found.append((_pair_tree(g.reshape(shape), h.reshape(shape))[0], i, j))
    for gain, i, j in sorted(found, reverse=True)[:PAIRS]:
        if gain > 1e-6:
            model.pairs.append((i, j, coarse[i], coarse[j],
                                np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))))
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, table in model.pairs:
            cells = at[i] * table.shape[1] + at[j]
            g, h = slopes(cells, table.size)
            step = RATE * _pair_tree(g.reshape(table.shape), h.reshape(table.shape))[1]
            table += step
            logit += step.ravel()[cells]
    return model


def is_held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _map(docs: DataFrame, id_col: str, text_col: str, names: list[str], make) -> DataFrame:
    bounded_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for b in rows(whole, 512):
                x = np.array([features(t) for t in utf8(b.column(1))]).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([b.column(0), *make(x)],
                                                 names=["id", *names])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, " + ", ".join(f"{n} double" for n in names))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold, taken by the order of
    a hash of the id. Rows with a null id or a label other than 0 and 1 are not used; an id with two
    labels counts with the larger."""
    usable = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                           & ~is_held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("y")))
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = own.join(F.broadcast(sample.select("id")), "id", "left_semi")  # at most sample_rows ids
    made = _map(texts, "id", "text", list(FEATURES), lambda x: [pa.array(c) for c in x.T])
    got = made.join(F.broadcast(sample), "id").drop("id").toPandas()
    got = got.sort_values(list(got.columns))  # the same model whatever the order of the tasks
    return fit(got[list(FEATURES)].to_numpy(dtype="f8"), got["y"].to_numpy(dtype="f8"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(``id_col``, score) for each row; the score (0 to 1) rises with the likelihood of label 1.

    Null and empty texts have the features of a text without words. Null ids and repeated rows stay
    as they are; other columns are not read.
    """
    return _map(docs, id_col, text_col, ["score"], lambda x: [pa.array(model.scores(x))])


def keep_good(docs: DataFrame, model: Model, text_col: str = "text",
              threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``; all columns stay."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for whole in batches:
            for b in rows(whole, 512):
                x = np.array([features(t) for t in utf8(b.column(at))]).reshape(-1, len(FEATURES))
                yield b.filter(pa.array(model.scores(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
