"""Quality scores by Bradley-Terry pairwise ranking.

Every whole text becomes a short vector of shares and counts.  Labelled texts of
the two classes give preference pairs, the good one over the bad one.  The
chance that a text is preferred is the logistic function of the difference of
the two scores, a score being linear in the vector, so the weights come from
logistic loss on vector differences.  The scores are then cut at the quantile
that parts the labelled texts in the shares of their labels, and moved so that
this cut is ``CUT`` on a scale from 0 to 1.

Every labelled row and every pair of a good and a bad one counts.  The sum over
all pairs is taken in linear time: the scores of each class are counted in bins
of width ``BIN`` with their first two moments in the bin, and what a row of one
class owes to all rows of the other is the series of the logistic function
around the middle of its bin (off by less than 1e-7 of a pair).  Spark adds up
the bins and the sums over rows; the driver sees one number per bin or weight.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textblocks as tb
from .minhash import stored

CUT = 0.3
#: Penalty on squared weights, Newton steps at most, and the step that ends them.
PENALTY, STEPS, ENOUGH = 1e-3, 40, 1e-7
BIN = 1 / 32
#: Rows worked on at once.
BLOCK = 20_000
MARKS = b"#*$%&|<>!?.,:;'\"()[]{}/\\-_=+@~^`"
JUNK = b"#*$%&|<>"


def _class(*values: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


CLASSES = {"upper": _class(*range(65, 91)), "lower": _class(*range(97, 123)), "digit": _class(*range(48, 58)),
           "wide": _class(*range(128, 256)), "blank": tb.SPACES, "feed": _class(10), "junk": _class(*JUNK),
           **{f"mark_{m:02x}": _class(m) for m in MARKS}}
TABLE = np.array(list(CLASSES.values()), dtype=np.int64).T
NAMES = [*CLASSES, "words", "length", "different", "repeated_next", "marked_words", "upper_words", "long_words",
         "same_lines", "upper_lines", "junk_lines", "worst_upper", "worst_junk", "worst_repeat"]


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` for each text; an empty text is all zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, len(NAMES)))
    col = NAMES.index
    each = np.bincount(np.repeat(np.arange(n) << 8, size) + data, minlength=n << 8).reshape(n, 256)
    out[:, :len(CLASSES)] = each @ TABLE / np.maximum(size, 1)[:, None]
    starts, ends, row = tb.words(data, offsets)
    count = np.bincount(row, minlength=n)
    many = np.maximum(count, 1)
    share = lambda mask: np.bincount(row, weights=mask, minlength=n) / many
    word = tb.word_hashes(tb.LOWER[data], starts, ends)
    own = tb.mix(word + row.astype(tb.U) * tb.U(tb.INVERSE))
    next_ = np.concatenate([[False], (word[1:] == word[:-1]) & (row[1:] == row[:-1])]) if len(word) else np.zeros(0, bool)
    upper = np.concatenate([[0], np.cumsum(CLASSES["upper"][data])])
    lower = np.concatenate([[0], np.cumsum(CLASSES["lower"][data] | CLASSES["wide"][data])])
    junk = np.concatenate([[0], np.cumsum(CLASSES["junk"][data])])
    ups = (upper[ends] - upper[starts] >= 2) & (upper[ends] - upper[starts] > lower[ends] - lower[starts])
    odd = junk[ends] > junk[starts]
    out[:, col("words")] = np.log1p(count) / 10
    out[:, col("length")] = size / many / 10 * (count > 0)
    out[:, col("different")] = share(~pd.Series(own).duplicated().to_numpy()) if len(word) else 0
    for name, mask in (("repeated_next", next_), ("marked_words", odd), ("upper_words", ups), ("long_words", ends - starts > 15)):
        out[:, col(name)] = share(mask)
    # lines: their words, and the worst of them
    line = np.cumsum(np.concatenate([[0], (data == 10).astype(np.int64)]))[starts] + row
    if len(line):
        first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        owner, length = row[first], np.diff(np.concatenate([first, [len(line)]]))
        lines = np.maximum(np.bincount(owner, minlength=n), 1)
        text = tb.mix(np.add.reduceat(tb.mix(word + (np.arange(len(word)) - np.repeat(first, length)).astype(tb.U) * tb.U(tb.BASE)), first)
                      + owner.astype(tb.U) * tb.U(tb.INVERSE))
        out[:, col("same_lines")] = np.bincount(owner, weights=pd.Series(text).duplicated().to_numpy(), minlength=n) / lines
        for mask, total, worst in ((ups, "upper_lines", "worst_upper"), (odd, "junk_lines", "worst_junk"), (next_, None, "worst_repeat")):
            part = np.add.reduceat(mask.astype(np.float64), first) / np.maximum(length, 4)
            if total:
                out[:, col(total)] = np.bincount(owner, weights=part > 0.5, minlength=n) / lines
            top = np.zeros(n)
            np.maximum.at(top, owner, part)
            out[:, col(worst)] = top
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in tb.blocks(batches, "text"):
        x = vectors(*tb.byte_view(block.column(1)))
        cuts = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([block.column(0), pa.ListArray.from_arrays(cuts, pa.array(x.ravel()))], ["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and vector x of every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_vectors, "doc_id long, x array<double>")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


#: What is added up by number: (numbers, values) of a block of scaled vectors and labels.
Sums = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _in_bins(weights: np.ndarray) -> Sums:
    """Count, first and second moment of the scores in each bin; number = 6 bin + 3 label + moment."""
    def of(z: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = (z * weights).sum(axis=1)
        at = np.floor(s / BIN).astype(np.int64)
        off = s - (at + 0.5) * BIN
        key, place = np.unique(at * 2 + label, return_inverse=True)
        return ((key * 3)[:, None] + np.arange(3)).ravel(), np.stack([np.bincount(place, off ** k, len(key)) for k in range(3)], axis=1).ravel()
    return of


def _pulls(weights: np.ndarray, tables: dict[int, tuple[np.ndarray, np.ndarray]]) -> Sums:
    """Per number: sums of z by pull (gradient), of z and z s by curve of each class, and of z z' by curve."""
    def of(z: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = (z * weights).sum(axis=1)
        at = np.floor(s / BIN).astype(np.int64)
        off = s - (at + 0.5) * BIN
        pull, curve = np.zeros(len(z)), np.zeros(len(z))
        for k, (bins, series) in tables.items():
            own = np.flatnonzero(label == k)
            a, b, c = series[np.searchsorted(bins, at[own])].T  # value, slope and bend of the pull in the middle of the bin
            pull[own] = a + off[own] * (b + off[own] * c / 2)
            curve[own] = np.maximum((b + off[own] * c) * (1 if k == 0 else -1), 0)
        by = [curve * (label == k) for k in (0, 1)]
        parts = [z.T @ np.where(label == 1, pull, -pull), *[z.T @ c for c in by], *[z.T @ (c * s) for c in by], (z.T @ (z * curve[:, None])).ravel()]
        out = np.concatenate(parts)
        return np.arange(len(out)), out
    return of


def _series(at: np.ndarray, bins: np.ndarray, moments: np.ndarray, sign: int) -> np.ndarray:
    """Sum of the logistic function of sign * (t - s) over all t in ``bins``, s the middle of each of ``at``: value, slope, bend."""
    p = _logistic(sign * (bins[None, :] - at[:, None]) * BIN)
    d = p * (1 - p)
    one, two, three = sign * d, d * (1 - 2 * p), sign * d * (1 - 6 * d)  # derivatives in t
    four = d * (1 - 2 * p) * (1 - 12 * d)
    n, m, q = moments.T
    return np.stack([p @ n + one @ m + two @ q / 2, -(one @ n + two @ m + three @ q / 2), two @ n + three @ m + four @ q / 2], axis=1)


def _bins(sums: dict[int, float], label: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the bins of a class and their three moments."""
    at = np.array(sorted({k // 6 for k in sums if k // 3 % 2 == label}), dtype=np.int64)
    return at, np.array([[sums[6 * int(b) + 3 * label + k] for k in range(3)] for b in at]).reshape(len(at), 3)


def _weights(add: Callable[[Sums], dict[int, float]], size: int) -> tuple[np.ndarray, float, float]:
    """Weights of the least mean logistic loss over all pairs, rows of the bad and of the good class.

    Newton steps; only the part of the curve that joins both classes is taken
    from the regression of their vectors on the score.  A step that does not
    lessen the loss is halved.
    """
    w, step, before = np.zeros(size), np.zeros(size), np.inf
    for _ in range(STEPS):
        sums = add(_in_bins(w))
        (b0, m0), (b1, m1) = _bins(sums, 0), _bins(sums, 1)
        n0, n1 = float(m0[:, 0].sum()), float(m1[:, 0].sum())
        if not n0 or not n1:
            return np.zeros(size), n0, n1
        gap = (b1[:, None] - b0[None, :]) * BIN + (m1[:, 1] / m1[:, 0])[:, None] - (m0[:, 1] / m0[:, 0])[None, :]
        weight = m1[:, :1] * m0[:, 0] / (n0 * n1)
        loss = float((np.logaddexp(0, -gap) * weight).sum() + PENALTY * w @ w / 2)
        if loss > before + 1e-4:  # what the bins leave open of the loss
            step = step / 2
            w = w - step
            continue
        before = min(before, loss)
        tables = {0: (b0, _series(b0, b1, m1, -1)), 1: (b1, _series(b1, b0, m0, 1))}
        got = add(_pulls(w, tables))
        flat = np.array([got[k] for k in range(5 * size + size * size)]) / (n0 * n1)
        pull, u0, u1, v0, v1 = flat[:5 * size].reshape(5, size)
        p = _logistic(gap)
        h = p * (1 - p) * weight
        s1, s0 = b1 * BIN + BIN / 2 + m1[:, 1] / m1[:, 0], b0 * BIN + BIN / 2 + m0[:, 1] / m0[:, 0]
        total, e0, e1 = h.sum(), h.sum(axis=0) @ s0 / h.sum(), h.sum(axis=1) @ s1 / h.sum()
        var0, var1 = h.sum(axis=0) @ (s0 - e0) ** 2, h.sum(axis=1) @ (s1 - e1) ** 2
        across = np.outer(u1, u0) / total
        if min(var0, var1) > 1e-12:
            across = across + np.outer(v1 - e1 * u1, v0 - e0 * u0) * ((s1 - e1) @ h @ (s0 - e0)) / (var0 * var1)
        curve = flat[5 * size:].reshape(size, size) - across - across.T + PENALTY * np.eye(size)
        step = np.linalg.solve(curve, pull - PENALTY * w)
        w = w + step
        if np.abs(step).max() < ENOUGH:
            break
    return np.round(w, 6), n0, n1


class Ranker:
    """Weights from preference pairs, and the cut; made here of rows at hand, ``block`` at a time, by ``fit`` of tables."""

    def __init__(self, x: np.ndarray, label: np.ndarray, block: int = BLOCK):
        self.weights, self.cut = np.zeros(len(NAMES)), 0.0
        self.scale_by(x.mean(axis=0) if len(x) else np.zeros(len(NAMES)), x.std(axis=0) if len(x) else np.ones(len(NAMES)))

        def add(of: Sums) -> dict[int, float]:
            total: dict[int, float] = {}
            for i in range(0, len(x), block):
                for k, v in zip(*(a.tolist() for a in of(self.scaled(x[i:i + block]), label[i:i + block]))):
                    total[k] = total.get(k, 0.0) + v
            return total
        self.weights, n0, n1 = _weights(add, len(NAMES))
        if n0 and n1:
            order = np.sort(self.raw(x))
            self.cut = float(order[int(n0) - 1] + order[int(n0)]) / 2  # halfway between the neighbours of the quantile

    def scale_by(self, mean: np.ndarray, spread: np.ndarray) -> None:
        self.mean, self.scale = mean, np.where(spread > 1e-9, spread, np.inf)  # what never changes weighs nothing

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) * self.weights).sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; ``CUT`` at the cut."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + np.log(CUT / (1 - CUT)), -30, 30)))


def _nth(scores: DataFrame, n: int) -> float:
    """The ``n``-th smallest s, from 0: the range that holds it is cut into 1000 parts until one value is left."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while low < high:
        width = (high - low) / 1000
        part = F.floor((F.col("s") - F.lit(low)) / F.lit(width)) if width > 0 else F.col("s")
        parts = (scores.filter(F.col("s").between(low, high)).groupBy(part.alias("part"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).orderBy("low").collect())
        for r in parts:
            if n < r["n"]:
                low, high = r["low"], r["high"]
                break
            n -= r["n"]
    return low


def fit_vectors(rows: DataFrame, labels: DataFrame) -> Ranker:
    """``fit`` of ``measured`` rows."""
    out = Ranker(np.zeros((0, len(NAMES))), np.zeros(0, np.int64))
    chosen = labels.filter("doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label")).filter("label in (0, 1)")
    taught = stored(rows.select("doc_id", "x").join(chosen, "doc_id").select("label", "x"), "ranker-labelled")
    each = (taught.select(F.posexplode("x")).groupBy("pos").agg(F.avg("col").alias("mean"), F.stddev_pop("col").alias("spread")).orderBy("pos").collect())
    if not each:
        return out
    short = lambda v: float(f"{v:.9g}")  # noqa: E731  the order of rows does not show
    out.scale_by(np.array([short(r["mean"]) for r in each]), np.array([short(r["spread"]) for r in each]))

    def add(of: Sums) -> dict[int, float]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    k, v = of(out.scaled(_matrix(batch.column(1))), batch.column(0).to_numpy())
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(v, pa.float64())], ["k", "v"])
        sums = taught.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
        return dict(zip(sums["k"].tolist(), sums["v"].tolist()))
    out.weights, n0, n1 = _weights(add, len(NAMES))
    if n0 and n1:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(out.raw(_matrix(batch.column(1))))], ["s"])
        scores = stored(taught.mapInArrow(run, "s double"), "ranker-scores")
        out.cut = (_nth(scores, int(n0) - 1) + _nth(scores, int(n0))) / 2  # halfway between the neighbours of the quantile
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Ranker from all rows of ``docs`` that ``labels`` (doc_id, label) calls 0 or 1; a null id or label teaches nothing."""
    return fit_vectors(measured(docs), labels)


def held_out(doc_id: Column, parts: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))


def score(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) and predicted (1 from ``CUT`` on) of every row of ``docs`` (doc_id, text).

    A null text is an empty one; both have a score like any other.  A null
    doc_id and equal rows keep their rows; other columns are not looked at.
    """
    return score_vectors(measured(docs), ranker)


def score_vectors(rows: DataFrame, ranker: Ranker) -> DataFrame:
    """``score`` of ``measured`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = ranker.scores(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])
    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")
