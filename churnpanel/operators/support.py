"""Polynomial regression on account features: support vectors, and ridge.

The loss of a row is 0 while its error stays within ``epsilon`` and grows linearly beyond
(the corner is rounded over ``ROUNDING``, so that the loss has a gradient everywhere).  The model is
linear in the monomials of the scaled columns up to ``degree``.  A step of the fit is one
pass over the rows: each task adds up the loss and the gradient of its rows in blocks, and Spark
adds the sums of the tasks.  Only vectors as long as the number of monomials, which the columns
and the degree fix, reach the driver; rows never do.

The ridge on the same monomials is one pass: each task multiplies blocks of its rows into one matrix of
products, the triangles of the tasks are added in pieces, and the sum is solved on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnpanel.functions.scale import materialize

#: Width over which the loss bends from flat to linear, in standard deviations of the label.
ROUNDING = 0.05
#: Cells of the expanded matrix a task holds at a time, and monomials a model may have.
CELLS, MONOMIALS = 1 << 22, 1 << 17
#: Steps of the fit that shape the next direction.
MEMORY = 10
#: Monomials of a ridge (their square is solved on the driver), and numbers in a piece of a triangle.
RIDGE_MONOMIALS, PIECE = 1 << 12, 1 << 16


def monomials(x: np.ndarray, degree: int) -> np.ndarray:
    """All products of up to ``degree`` columns, a constant first.

    The products of one degree are those of the degree below, from a column on, times that column."""
    width = x.shape[1]
    out = np.ones((len(x), comb(width + degree, degree)))
    begins, end = [0] * width, 1
    for _ in range(degree):
        at, begun = end, []
        for i, begin in enumerate(begins):
            begun.append(at)
            np.multiply(out[:, begin:end], x[:, i:i + 1], out=out[:, at:at + end - begin])
            at += end - begin
        begins, end = begun, at
    return out


def insensitive_loss(error: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Loss and slope for each error (prediction less label)."""
    beyond = np.maximum(np.abs(error) - epsilon, 0)
    bent = np.minimum(beyond, ROUNDING)
    return bent * (beyond - bent / 2) / ROUNDING, np.sign(error) * bent / ROUNDING


def _rows(batches: Iterator[pa.RecordBatch], width: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows whose expansion has at most ``CELLS`` cells, with their matrix ``x``."""
    step = max(1, CELLS // size)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            x = part.column(part.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
            yield part, x.reshape(part.num_rows, width)


@dataclass
class PolynomialModel:
    """A fitted model: scaling of columns and label, and one weight for each monomial."""

    columns: list[str]
    degree: int
    mean: np.ndarray
    scale: np.ndarray
    label_mean: float
    label_scale: float
    weights: np.ndarray

    def scaled(self) -> Column:
        """The model's columns as one array, on the training scale (a null is the mean)."""
        return F.array(*[F.coalesce((F.col(f"`{c}`") - F.lit(float(m))) / F.lit(float(s)), F.lit(0.0))
                         for c, m, s in zip(self.columns, self.mean, self.scale)]).alias("x")

    def predict(self, df: DataFrame, name: str, key: str = "acc_id") -> DataFrame:
        """``key`` and the prediction; the weights travel with the code of the tasks."""
        weights, degree, width = self.weights, self.degree, len(self.columns)
        mean, scale = self.label_mean, self.label_scale

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, x in _rows(batches, width, len(weights)):
                value = monomials(x, degree) @ weights * scale + mean
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value)], names=["key", "value"])

        rows = df.select(F.col(key).alias("key"), self.scaled())
        kind = rows.schema["key"].dataType.simpleString()
        return rows.mapInArrow(score, f"key {kind}, value double").select(F.col("key").alias(key), F.col("value").alias(name))


def _minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Limited-memory quasi-Newton descent; each call of ``value`` is one pass over the rows."""
    at, (best, slope) = start, value(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.linalg.norm(slope) <= tolerance:
            break
        go, back = -slope, []
        for move, turn in reversed(moves):
            share = move @ go / (move @ turn)
            go = go - share * turn
            back.append(share)
        if moves:
            move, turn = moves[-1]
            go = go * (move @ turn) / (turn @ turn)
        for (move, turn), share in zip(moves, reversed(back)):
            go = go + (share - turn @ go / (move @ turn)) * move
        length = 1.0 if moves else min(1.0, 1.0 / np.linalg.norm(slope))
        for _ in range(20):
            new, (got, new_slope) = at + length * go, value(at + length * go)
            if got <= best + 1e-4 * length * (slope @ go):
                break
            length /= 2
        else:
            break
        move, turn, gain = new - at, new_slope - slope, best - got
        if move @ turn > 1e-12:
            moves = [*moves, (move, turn)][-MEMORY:]
        at, best, slope = new, got, new_slope
        if gain <= tolerance * max(abs(best), 1e-9):
            break
    return at


def fit_poly_svr(train: DataFrame, columns: list[str], label: str = "amount_spent", degree: int = 2, epsilon: float = 0.1,
                 reg: float = 0.01, steps: int = 60, tolerance: float = 1e-5) -> PolynomialModel:
    """Minimise mean loss + ``reg`` / 2 * |weights|^2 (the constant is not penalised).

    ``epsilon`` is in standard deviations of the label.  Columns that are constant count as
    0; rows without a label are left out; without any labelled row the model predicts 0."""
    size = comb(len(columns) + degree, degree)
    if size > MONOMIALS:
        raise ValueError(f"{size} monomials of {len(columns)} columns exceed {MONOMIALS}; lower the degree or select columns")
    train = train.where(F.col(f"`{label}`").isNotNull())
    every = [*columns, label]
    one = train.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{c}`")).alias(f"{k}{i}")
                                                    for i, c in enumerate(every) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([one[f"m{i}"] or 0.0 for i in range(len(every))])
    spread = np.array([one[f"s{i}"] or 0.0 for i in range(len(every))])
    scale = np.where(spread > 1e-12, spread, 1.0)
    model = PolynomialModel(columns, degree, mean[:-1], scale[:-1], float(mean[-1]), float(scale[-1]), np.zeros(size))
    if not one["n"]:
        return model
    y = (F.col(f"`{label}`") - F.lit(float(mean[-1]))) / F.lit(float(scale[-1]))
    # the scaled columns are stored once; monomials are made anew in every pass, in bounded blocks
    rows = materialize(train.select(y.cast("double").alias("y"), model.scaled()), "svr-rows")
    width, n = len(columns), one["n"]

    def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + 1)
            for part, x in _rows(batches, width, size):
                z = monomials(x, degree)
                loss, slope = insensitive_loss(z @ weights - part.column(0).to_numpy(zero_copy_only=False), epsilon)
                total[0] += loss.sum()
                total[1:] += slope @ z
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

        sums = rows.mapInArrow(add, "total array<double>").select(array_to_vector("total").alias("total"))
        got = np.array(sums.select(vector_to_array(Summarizer.sum(F.col("total"))).alias("total")).first().total) / n
        own = np.concatenate([[0.0], weights[1:]])
        return float(got[0] + reg / 2 * own @ own), got[1:] + reg * own

    model.weights = _minimise(value, model.weights, steps, tolerance)
    return model


def fit_poly_ridge(train: DataFrame, columns: list[str], label: str, degree: int = 2, reg: float = 0.1) -> PolynomialModel:
    """Least squares on the monomials of the columns as they are, with ``reg`` / 2 * |weights|^2 on the
    scale where label and monomials have deviation 1 (as Spark's linear regression has it): exact, in one pass.

    Monomials that are constant get no weight; rows without a label are left out."""
    width, size = len(columns), comb(len(columns) + degree, degree)
    if size > RIDGE_MONOMIALS:
        raise ValueError(f"{size} monomials of {width} columns exceed {RIDGE_MONOMIALS}; lower the degree or select columns")
    model = PolynomialModel(columns, degree, np.zeros(width), np.ones(width), 0.0, 1.0, np.zeros(size))
    rows = train.where(F.col(f"`{label}`").isNotNull()).select(F.col(f"`{label}`").cast("double").alias("y"), model.scaled())
    corner = np.triu_indices(size + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for part, x in _rows(batches, width, size):
            z = np.hstack([monomials(x, degree), part.column(0).to_numpy(zero_copy_only=False)[:, None]])
            total += z.T @ z
        flat = total[corner]
        for at in range(0, len(flat), PIECE):
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([flat[at:at + PIECE]], pa.list_(pa.float64()))], names=["at", "total"])

    # a task sends its whole triangle, so there are as many tasks as cores, whatever the number of rows
    sums = rows.coalesce(train.sparkSession.sparkContext.defaultParallelism).mapInArrow(add, "at long, total array<double>")
    pieces = sums.groupBy("at").agg(vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")).collect()
    products = np.zeros((size + 1, size + 1))
    products[corner] = np.concatenate([p.total for p in sorted(pieces)]) if pieces else 0.0
    n = products[0, 0]
    if not n:
        return model
    mean = products[0] / n
    spread = products / n - np.outer(mean, mean)
    spread = np.triu(spread) + np.triu(spread, 1).T
    # a deviation below the rounding of the sums is none
    deviation = np.sqrt(np.maximum(np.diag(spread), 0.0))
    used = np.flatnonzero(deviation[:-1] > 1e-7 * np.abs(mean[:-1]))
    used = used[used > 0]
    weights = np.zeros(size)
    if deviation[-1] > 1e-7 * abs(mean[-1]) and len(used):
        own = deviation[used]
        like = spread[np.ix_(used, used)] / np.outer(own, own) + np.eye(len(used)) * (reg / deviation[-1])
        weights[used] = np.linalg.solve(like, spread[used, -1] / own) / own
    weights[0] = mean[-1] - mean[1:-1] @ weights[1:]
    model.weights = weights
    return model
