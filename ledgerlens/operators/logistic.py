"""Logistic regressions of all folds and strengths of a grid, fitted together by Newton's method.

Each model minimises the mean logistic loss of its rows plus ``strength`` / 2
times the squared coefficients of its scaled inputs; the intercept is free. That
is what Spark's ``LogisticRegression`` minimises with L2 and without its own
standardisation, but its steps by gradients take some hundred passes a model
where inputs depend on each other or nearly tell the classes apart.

Rows are stored once, in blocks. A job gives loss, gradient and Hessian of all
models that aren't done yet: a task adds up its own rows, cells are summed by a
shuffle, and what comes to the driver are the cells, whose number follows from
models and inputs, not from rows. A fold's own scaling is a linear map of the
stored inputs, so it is applied to the sums. A step that does not lower the
loss is halved.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block.
BLOCK_ROWS = 8192
BLOCK = "inputs binary, label binary, fold binary"
# Passes at most, halvings of a step at most, and the fall of the loss still to be had at which a model is done.
PASSES = 200
HALVINGS = 30
LEFT = 1e-12


@dataclass
class Moments:
    """Rows, positives, means and summed squared deviations."""

    n: int
    positive: int
    mean: np.ndarray
    squares: np.ndarray

    def joined(self, other: Moments) -> Moments:
        n, off = self.n + other.n, other.mean - self.mean
        mean = self.mean + off * other.n / n
        return Moments(n, self.positive + other.positive, mean, self.squares + other.squares + off**2 * self.n * other.n / n)

    def scaling(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean, and one by the standard deviation; an input that is the same everywhere becomes 0."""
        std = np.sqrt(self.squares / max(self.n - 1, 1))
        return self.mean, np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)


def usable(rows: DataFrame, numeric: list[str], label: str) -> DataFrame:
    """Inputs as doubles, label and fold; without rows that have a missing or NaN input."""
    numbers = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(numeric)]
    given = rows.select(*numbers, F.col(label).cast("double").alias("_y"), "fold")
    return given.dropna(subset=[f"_x{i}" for i in range(len(numeric))])


def moments(rows: DataFrame, width: int) -> dict[int, Moments]:
    """One row a fold."""
    inputs = [f(f"_x{i}") for f in (F.avg, F.var_pop) for i in range(width)]
    odd = F.count_if(F.col("_y").isNull() | ~F.col("_y").isin(0.0, 1.0))
    out = {}
    for fold, n, positive, wrong, *values in rows.groupBy("fold").agg(F.count("*"), F.count_if(F.col("_y") == 1), odd, *inputs).collect():
        if wrong:
            raise ValueError("labels must be 0 or 1")
        out[fold] = Moments(n, positive, np.array(values[:width]), np.array(values[width:]) * n)
    return out


def blocks(rows: DataFrame, width: int, whole: Moments) -> DataFrame:
    """Stored rows with a 1 behind their inputs, which are scaled by all rows; ordered by fold within a block."""
    mean, by = whole.scaling()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                order = np.argsort(some.column("fold").to_numpy(), kind="stable")
                inputs = np.ones((some.num_rows, width + 1))
                for i in range(width):
                    inputs[:, i] = (some.column(f"_x{i}").to_numpy()[order] - mean[i]) * by[i]
                parts = inputs, some.column("_y").to_numpy()[order], some.column("fold").to_numpy()[order].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["inputs", "label", "fold"])

    return written(rows.mapInArrow(run, BLOCK), "logistic-rows")


def sides(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Fold, inputs and labels, fold by fold of every block."""
    for batch in batches:
        for x, y, fold in zip(*(batch.column(c) for c in ("inputs", "label", "fold"))):
            x, y, fold = np.frombuffer(x.as_py()).reshape(-1, width + 1), np.frombuffer(y.as_py()), np.frombuffer(fold.as_py(), np.int32)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(fold)) + 1, [len(fold)]])
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                yield int(fold[a]), x[a:b], y[a:b]


def cells(sums: np.ndarray) -> pa.RecordBatch:
    flat = sums.ravel()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "value"])


def summed(made: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Cells of all tasks, added up."""
    out = np.zeros(shape[0] * shape[1])
    for cell, value in made.groupBy("cell").agg(F.sum("value")).collect():
        out[cell] = value
    return out.reshape(shape)


def curvatures(rows: DataFrame, width: int, held: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per model the summed loss, gradient and upper triangle of the Hessian over all rows but those of its held-out fold."""
    upper, across = np.triu_indices(width + 1)
    size = 1 + width + 1 + len(upper)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(held), size))
        for fold, x, y in sides(batches, width):
            models = np.flatnonzero(held != fold)
            if not len(models):
                continue
            margin = x @ weights[models].T
            p = 0.5 * (1.0 + np.tanh(0.5 * margin))
            sums[models, 0] += (np.logaddexp(0.0, margin) - y[:, None] * margin).sum(axis=0)
            sums[models, 1 : width + 2] += (p - y[:, None]).T @ x
            sums[models, width + 2 :] += (p * (1.0 - p)).T @ (x[:, upper] * x[:, across])
        yield cells(sums)

    return summed(rows.mapInArrow(run, "cell long, value double"), (len(held), size))


def hits(rows: DataFrame, width: int, held: np.ndarray, weights: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """Per model how many rows of its held-out fold it tells right. ``constant`` is -1, or what a model says of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros((len(held), 1))
        for fold, x, y in sides(batches, width):
            models = np.flatnonzero(held == fold)
            said = np.where(constant[models] < 0, x @ weights[models].T > 0, constant[models] == 1)
            right[models, 0] += (said == (y[:, None] == 1)).sum(axis=0)
        yield cells(right)

    return summed(rows.mapInArrow(run, "cell long, value double"), (len(held), 1))[:, 0]


@dataclass
class Fit:
    """A model on its way: where it is, the step it tried last, and how often that was halved."""

    to_stored: np.ndarray
    n: int
    strength: float
    at: np.ndarray
    loss: float = np.inf
    step: np.ndarray | None = None
    halved: int = 0
    done: bool = False

    def tried(self) -> np.ndarray:
        return self.at if self.step is None else self.at + self.step

    def met(self, sums: np.ndarray) -> None:
        """Take the step or halve it, and choose the next one."""
        width, now = len(self.at) - 1, self.tried()
        penalty = np.append(np.full(width, self.strength), 0.0)
        loss = sums[0] / self.n + 0.5 * (penalty * now) @ now
        if not loss <= self.loss and self.halved < HALVINGS:
            self.step, self.halved = self.step / 2, self.halved + 1
            return
        if not loss <= self.loss:
            self.step, self.done = None, True
            return
        self.at, self.loss, self.halved = now, loss, 0
        upper = np.zeros((width + 1, width + 1))
        upper[np.triu_indices(width + 1)] = sums[width + 2 :]
        hessian = upper + np.triu(upper, 1).T
        a = self.to_stored
        gradient = a @ sums[1 : width + 2] / self.n + penalty * now
        self.step = -np.linalg.lstsq(a @ hessian @ a.T / self.n + np.diag(penalty), gradient, rcond=1e-15)[0]
        if -gradient @ self.step < 2 * LEFT:
            self.step, self.done = None, True


def grid_accuracy(folded: DataFrame, numeric: list[str], label: str, strengths: list[float], folds: int) -> list[float]:
    """Mean accuracy per strength over the folds, each scored by a model of the other folds' rows, scaled by these.

    ``folded`` has ``fold`` in 0..folds-1; a fold without rows is an error.
    """
    width, rows = len(numeric), usable(folded, numeric, label)
    own = moments(rows, width)
    if folds < 2 or any(f not in own for f in range(folds)):
        raise ValueError("a fold has no rows")

    def joined(some: list[Moments]) -> Moments:
        whole = some[0]
        for other in some[1:]:
            whole = whole.joined(other)
        return whole

    whole = joined([own[f] for f in range(folds)])
    mean, by = whole.scaling()
    stored = blocks(rows, width, whole)
    fits, held, constant = [], [], []
    for fold in range(folds):
        train = joined([own[f] for f in range(folds) if f != fold])
        centre, scale = train.scaling()
        # Inputs scaled by the fold's training rows, from those scaled by all rows.
        a = np.zeros((width + 1, width + 1))
        a[range(width), range(width)] = np.divide(scale, by, out=np.zeros(width), where=by > 0)
        a[:width, width], a[width, width] = (mean - centre) * scale, 1.0
        for strength in strengths:
            fits.append(Fit(a, train.n, strength, np.zeros(width + 1)))
            held.append(fold)
            # Rows of one class have no finite optimum: every row is said to be of that class.
            constant.append(0 if train.positive == 0 else 1 if train.positive == train.n else -1)
            fits[-1].done = constant[-1] >= 0
    held, constant = np.array(held), np.array(constant)
    for _ in range(PASSES):
        active = [i for i, f in enumerate(fits) if not f.done]
        if not active:
            break
        found = curvatures(stored, width, held[active], np.array([fits[i].tried() @ fits[i].to_stored for i in active]))
        for i, sums in zip(active, found):
            fits[i].met(sums)
    right = hits(stored, width, held, np.array([f.at @ f.to_stored for f in fits]), constant)
    shares = right.reshape(folds, -1) / np.array([[own[f].n] for f in range(folds)])
    return shares.mean(axis=0).tolist()
