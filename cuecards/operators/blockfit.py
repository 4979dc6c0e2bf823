"""Linear models of many folds and labels in shared passes over the data.

All models of a job are columns of one block: column ``(k, l)`` is label ``l``
fitted without fold ``k``.  A pass reads the feature rows once, multiplies them
with the block of current weights, masks each row out of its own fold's columns
and sums the block gradient: inside a task, then over tasks slice by slice.  The
driver keeps weights and directions, (features in use) x (columns) doubles,
whose size the caller's feature width and label count bound, never rows.

Features are counts of hashed characters and character pairs, standardised by
the mean and deviation over each fold's own training rows; a constant feature
gets no weight.  Objectives, with ``x`` standardised and the intercept free:

* ridge: ``1/(2n) sum (y - b - x.w)^2 + reg/2 |w|^2``, by conjugate gradients,
* logistic: ``1/n sum log(1 + exp(-(2y-1)(b + x.w))) + reg/2 |w|^2``, by Newton steps,
  each solved by conjugate gradients and halved until the objective falls.

A row without a fold is a training row of every model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Doubles of one slice of a summed vector; feature entries times columns worked on at a time.
SLICE, WORK = 1 << 16, 1 << 20
#: Bytes or characters of text that are counted at a time.
TEXT = 1 << 18
#: Bytes of all tasks' vectors up to which the driver adds them itself.
DIRECT = 1 << 24


def hashed_ngrams(df: DataFrame, keep: list[str], text_col: str, width: int) -> DataFrame:
    """``keep`` plus ``idx`` and ``cnt``: the buckets of a text and their counts.
    A character falls into bucket ``code % width``, a pair of neighbours into
    ``width + (7919 * code1 + code2) % width``; a null text has none."""
    src = df.select(*keep, F.col(text_col).alias("_text"))
    schema = T.StructType([*[src.schema[c] for c in keep], T.StructField("idx", T.ArrayType(T.IntegerType())),
                           T.StructField("cnt", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _cut(batch):
                ends, idx, cnt = _count(rows.column(rows.num_columns - 1), width)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(idx)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(cnt))], [*keep, "idx", "cnt"])

    return src.mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``TEXT`` bytes in the last column; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + TEXT, "right")))
        yield batch.slice(i, j - i)
        i = j


def _count(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, buckets and counts of some texts, ``TEXT`` characters at a time."""
    words = [t.decode("utf-8", "replace") for t in pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()]
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), [len(t) for t in words])
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a in range(0, len(codes), TEXT):
        c, own = codes[a: a + TEXT + 1].astype(np.int64), row[a: a + TEXT + 1]
        inside = own[:-1] == own[1:]
        pairs = width + (c[:-1] * 7919 + c[1:])[inside] % width
        found, n = np.unique(np.concatenate([own[:TEXT] * (2 * width) + c[:TEXT] % width, own[:-1][inside] * (2 * width) + pairs]),
                             return_counts=True)
        keys, place = np.unique(np.concatenate([keys, found]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, n]), len(keys))
    ends = np.searchsorted(keys, np.arange(len(words) + 1) * (2 * width)).astype(np.int32)
    return ends, (keys % (2 * width)).astype(np.int32), counts.astype(np.float64)


class _Rows:
    """Some rows of a batch: features as row offsets, buckets and counts."""

    def __init__(self, off, idx, cnt, y, mask):
        self.off, self.idx, self.cnt, self.y, self.mask = off, idx, cnt, y, mask
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(off))

    def times(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.off) - 1, v.shape[1]))
        full = np.flatnonzero(np.diff(self.off))
        if len(full):
            out[full] = np.add.reduceat(v[self.idx] * self.cnt[:, None], self.off[full], axis=0)
        return out

    def transposed_times(self, r: np.ndarray, into: np.ndarray) -> None:
        if len(self.idx):
            order = np.argsort(self.idx, kind="stable")
            cols, first = np.unique(self.idx[order], return_index=True)
            into[cols] += np.add.reduceat((r[self.row] * self.cnt[:, None])[order], first, axis=0)


def _rows(batch: pa.RecordBatch, place: np.ndarray, n: int, folds: int, columns: int) -> Iterator[_Rows]:
    idx = batch.column("idx")
    off = idx.offsets.to_numpy().astype(np.int64)
    flat, counts = idx.values.to_numpy(), batch.column("cnt").values.to_numpy()
    names = batch.schema.names
    y = (np.array(batch.column("y").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, n) if "y" in names
         else np.zeros((len(idx), n)))
    fold = batch.column("fold").fill_null(-1).to_numpy() if folds else None
    step_of = off * max(1, columns)
    i = 0
    while i < len(idx):  # pieces are made one at a time, so a wide batch is not held several times over
        j = max(i + 1, min(i + WORK // max(1, columns), int(np.searchsorted(step_of, step_of[i] + WORK, "right")) - 1))
        every = place[flat[off[i]: off[j]]]
        used = every >= 0
        ends = np.concatenate([[0], np.cumsum(used)])[off[i: j + 1] - off[i]]
        mask = np.ones((j - i, max(1, folds)))
        if folds:
            inside = (fold[i: j] >= 0) & (fold[i: j] < folds)
            mask[np.flatnonzero(inside), fold[i: j][inside]] = 0
        yield _Rows(ends, every[used], counts[off[i]: off[j]][used], y[i: j], mask)
        i = j


def _sum(table: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over tasks of the vectors of ``size`` that ``part`` makes of a task's batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = part(batches)
        pieces = [v[i: i + SLICE].tobytes() for i in range(0, len(v), SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], ["slice", "part"])

    def add(rows: pa.Table) -> pa.Table:
        out = None
        for chunk in rows.column("part"):
            v = np.frombuffer(chunk.as_buffer(), np.float64)
            out = v.copy() if out is None else out + v
        return pa.table({"slice": pa.array([rows.column("slice")[0].as_py()], pa.int32()), "part": pa.array([out.tobytes()], pa.binary())})

    rows = table.mapInArrow(run, "slice int, part binary")
    if size * 8 * table.rdd.getNumPartitions() <= DIRECT:  # a few short vectors: one stage is enough
        out = np.zeros(size)
        for r in sorted(rows.collect(), key=lambda r: r.slice):
            v = np.frombuffer(r.part, np.float64)
            out[r.slice * SLICE: r.slice * SLICE + len(v)] += v
        return out
    rows = rows.groupBy("slice").applyInArrow(add, "slice int, part binary")
    return np.concatenate([np.frombuffer(r.part, np.float64) for r in sorted(rows.collect(), key=lambda r: r.slice)] or [np.zeros(size)])


class BlockFit:
    """Weights in counts (``active`` buckets x columns) and intercepts; ``kind`` says how scores are made."""

    def __init__(self, active, weights, intercept, width, n, folds, kind, passes):
        self.active, self.weights, self.intercept = active, weights, intercept
        self.width, self.n, self.folds, self.kind, self.passes = width, n, folds, kind, passes


class _Problem:
    """Standardisation of every column and the block products, one pass each."""

    def __init__(self, table: DataFrame, width: int, n: int, folds: int):
        self.table, self.width, self.n, self.folds, self.passes = table, width, n, folds, 0
        k = self.k = max(1, folds)
        everything = np.arange(width)

        def moments(batches):
            sx, sxx = np.zeros((width, k)), np.zeros((width, k))
            rows, sy = np.zeros(k), np.zeros((k, n))
            for batch in batches:
                for r in _rows(batch, everything, n, folds, k):
                    r.transposed_times(r.mask, sx)
                    squares = _Rows(r.off, r.idx, r.cnt * r.cnt, r.y, r.mask)
                    squares.transposed_times(r.mask, sxx)
                    rows += r.mask.sum(0)
                    sy += r.mask.T @ r.y
            return np.concatenate([sx.ravel(), sxx.ravel(), rows, sy.ravel()])

        v = self._pass(moments, 2 * width * k + k + k * n)
        sx, sxx = v[: width * k].reshape(width, k), v[width * k: 2 * width * k].reshape(width, k)
        self.rows, sy = v[2 * width * k: 2 * width * k + k], v[2 * width * k + k:].reshape(k, n)
        safe = np.maximum(self.rows, 1)
        mean = sx / safe
        var = np.maximum(sxx / safe - mean * mean, 0)
        var[var < 1e-12 * np.maximum(1, mean * mean)] = 0
        self.active = np.flatnonzero(var.max(1) > 0)
        self.place = np.full(width, -1)
        self.place[self.active] = np.arange(len(self.active))
        spread = np.sqrt(var[self.active])
        scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
        wide = lambda a: np.repeat(a, n, axis=-1)  # noqa: E731  (folds -> columns)
        self.scale, self.mean, self.count = wide(scale), wide(mean[self.active]), np.maximum(wide(self.rows), 1)
        self.y_mean = (sy / safe[:, None]).ravel()

    def _pass(self, part, size: int) -> np.ndarray:
        self.passes += 1
        return _sum(self.table, part, size)

    def product(self, residual: Callable, *blocks: tuple[np.ndarray, np.ndarray], extra: int = 0):
        """For blocks ``(w, b)`` of standardised weights and intercepts:
        ``residual(z..., y)`` gives row values per column (and ``extra`` more
        sums per column); back come their standardised gradient, sum and extras."""
        raw = []
        for w, b in blocks:
            v = self.scale * w
            raw.append((v, b - (self.mean * v).sum(0)))
        sent = self.table.sparkSession.sparkContext.broadcast((raw, self.place))
        n, folds, size, columns = self.n, self.folds, len(self.active), self.k * self.n

        def part(batches):
            raw, place = sent.value
            grad, total = np.zeros((size, columns)), np.zeros((1 + extra, columns))
            for batch in batches:
                for r in _rows(batch, place, n, folds, columns):
                    zs = [r.times(v) + c for v, c in raw]
                    mask = np.repeat(r.mask, n, axis=1)
                    out = residual(*zs, np.tile(r.y, (1, max(1, folds))))
                    r.transposed_times(out[0] * mask, grad)
                    total += np.stack([(o * mask).sum(0) for o in out])
            return np.concatenate([grad.ravel(), total.ravel()])

        v = self._pass(part, (size + 1 + extra) * columns)
        sent.destroy()
        grad, total = v[: size * columns].reshape(size, columns), v[size * columns:].reshape(1 + extra, columns)
        return self.scale * (grad - self.mean * total[0]) / self.count, total / self.count

    def finished(self, w, b, kind) -> BlockFit:
        v = self.scale * w
        return BlockFit(self.active, v, b - (self.mean * v).sum(0), self.width, self.n, self.folds, kind, self.passes)


def _conjugate(apply: Callable, rhs: np.ndarray, limit: np.ndarray, most: int) -> np.ndarray:
    """Solve ``apply(x) = rhs`` for every column; a column stops at its ``limit``."""
    x, r = np.zeros_like(rhs), rhs.copy()
    p, rr = r.copy(), (r * r).sum(0)
    for _ in range(most):
        live = np.sqrt(rr) > limit
        if not live.any():
            break
        ap = apply(p * live)
        curve = (p * ap).sum(0)
        alpha = np.divide(rr, curve, out=np.zeros_like(rr), where=live & (curve > 0))
        x += alpha * p
        r -= alpha * ap
        new = (r * r).sum(0)
        p = r + np.divide(new, rr, out=np.zeros_like(rr), where=rr > 0) * p
        rr = new
    return x


def fit_ridge(table: DataFrame, width: int, n: int, folds: int = 0, reg: float = 0.01, max_iter: int = 100,
              tol: float = 1e-8) -> BlockFit:
    """Ridge for all columns of ``table (idx, cnt, y, fold)``; ``folds = 0``: one model per label."""
    p = _Problem(table, width, n, folds)
    rhs, _ = p.product(lambda z, y: (y - z,), (np.zeros_like(p.scale), p.y_mean))

    def apply(w):
        g, _ = p.product(lambda z, y: (z,), (w, np.zeros_like(p.y_mean)))
        return g + reg * w

    w = _conjugate(apply, rhs, tol * np.sqrt((rhs * rhs).sum(0)), max_iter)
    return p.finished(w, p.y_mean, "regression")


def fit_logistic(table: DataFrame, width: int, n: int, folds: int = 0, reg: float = 0.01, max_iter: int = 100,
                 tol: float = 1e-8) -> BlockFit:
    """Logistic models for all columns; labels are 0 or 1, at most about ``max_iter`` passes."""
    p = _Problem(table, width, n, folds)

    def loss(z, y):
        return np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))

    def gradient(z, y):
        return 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y, loss(z, y)

    def curvature(z, d, y):
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return (s * (1 - s) * d,)

    one_class = (p.y_mean <= 0) | (p.y_mean >= 1)  # no finite minimum: the class is certain, no weights
    start = np.where(one_class, 0.5, p.y_mean)
    w, b = np.zeros_like(p.scale), np.where(one_class, np.where(p.y_mean >= 1, 40.0, -40.0), np.log(start / (1 - start)))

    def state(w, b):
        g, sums = p.product(gradient, (w, b), extra=1)
        return np.vstack([g + reg * w, sums[0]]), sums[1] + reg / 2 * (w * w).sum(0)

    g, value = state(w, b)
    first, polished = np.sqrt((g * g).sum(0)), False
    while p.passes < max_iter:
        size = np.sqrt((g * g).sum(0))
        open_ = (size > tol * np.maximum(first, 1e-300)) & (size > 1e-14) & ~one_class
        if not open_.any():  # all within tol: one step more, which shrinks what tol leaves by orders of magnitude
            open_ = (size > 1e-14) & ~one_class
            if polished or not open_.any():
                break
            polished = True

        def apply(d, w=w, b=b):
            h, sums = p.product(curvature, (w, b), (d[:-1], d[-1]))
            return np.vstack([h + reg * d[:-1], sums[0]])

        limit = np.where(open_, size * np.minimum(0.1, np.sqrt(size)), np.inf)
        step = _conjugate(apply, -g, limit, max(1, max_iter - p.passes))
        scale = open_.astype(float)
        for _ in range(30):
            new_w, new_b = w + scale * step[:-1], b + scale * step[-1]
            new_g, new_value = state(new_w, new_b)
            worse = open_ & (new_value > value + 1e-12 * np.abs(value) + 1e-4 * scale * (g * step).sum(0) * (size > 1e-6))
            if not worse.any():
                break
            scale = np.where(worse, scale / 2, scale)
        w, b, g, value = new_w, new_b, new_g, new_value
    return p.finished(w, b, "classification")


def predict(rows: DataFrame, fit: BlockFit, key: str) -> DataFrame:
    """``(key, scores)``: for each model (one, or one per fold) the array of its scores."""
    schema = T.StructType([rows.schema[key], T.StructField("scores", T.ArrayType(T.ArrayType(T.DoubleType())))])
    place = np.full(fit.width, -1)
    place[fit.active] = np.arange(len(fit.active))
    sent = rows.sparkSession.sparkContext.broadcast((place, fit.weights, fit.intercept))
    n, k, logistic = fit.n, max(1, fit.folds), fit.kind == "classification"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights, intercept = sent.value
        for batch in batches:
            parts = [r.times(weights) + intercept for r in _rows(batch, place, n, 0, k * n)]
            z = np.concatenate(parts) if parts else np.zeros((0, k * n))
            if logistic:
                z = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            inner = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, n, dtype=np.int32)), pa.array(z.ravel()))
            outer = pa.ListArray.from_arrays(pa.array(np.arange(0, len(z) * k + 1, k, dtype=np.int32)), inner)
            yield pa.RecordBatch.from_arrays([batch.column(key), outer], [key, "scores"])

    return rows.mapInArrow(run, schema)


def leave_one_out(table: DataFrame, features: list[str], label: str, fold: str, folds: int) -> list[tuple[float, np.ndarray]]:
    """``(intercept, weights)`` of least squares without fold 0, 1, ...: one
    pass sums the cross products of ``(1, features, label)`` per fold; a fold is
    left out by subtraction.  Collinear features get the smallest weights."""
    width = len(features) + 2

    def part(batches):
        out = np.zeros((folds + 1, width, width))
        for batch in batches:
            z = np.stack([np.ones(batch.num_rows), *[batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in [*features, label]]], 1)
            own = batch.column(fold).fill_null(folds).to_numpy()
            for f in np.unique(own):
                mine = z[own == f]
                out[min(int(f), folds)] += mine.T @ mine
        return out.ravel()

    cols = [F.col(c).cast("double").alias(c) for c in [*features, label]]
    stats = _sum(table.select(F.col(fold).cast("int").alias(fold), *cols), part, (folds + 1) * width * width)
    stats = stats.reshape(folds + 1, width, width)
    everything = stats.sum(0)
    out = []
    for f in range(folds):
        m = everything - stats[f]
        n = max(m[0, 0], 1)
        mean = m[0] / n
        centred = m / n - np.outer(mean, mean)
        w = np.linalg.lstsq(centred[1:-1, 1:-1], centred[1:-1, -1], rcond=1e-12)[0]
        out.append((float(mean[-1] - mean[1:-1] @ w), w))
    return out
