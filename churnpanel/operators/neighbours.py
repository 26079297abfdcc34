"""Exact k-nearest-neighbour votes without forming all pairs.

Training rows are cut into cells around pivots (each row belongs to its nearest pivot).  A
cell can hold a neighbour of a query closer than ``r`` only if two bounds allow it:

* triangle inequality: the query's distance to the cell's pivot lies within ``r`` of the
  range of distances its rows have to that pivot;
* half space: the cell's rows are at least as close to its pivot as to the query's own
  pivot, so the query is at least (d(q, pivot)^2 - d(q, own)^2) / (2 d(pivot, own)) away.

Each query is first compared with the cell of its own pivot, which gives a radius, and then
only with the cells that radius reaches.  Nothing is approximated or capped: the pivots, from
a bounded sample of the training rows, only decide how many cells are visited.

Neighbouring cells form regions of many rows.  A query travels once to each region that holds
a cell it must visit, however many cells that are: first to its own region, whose rows give a
tight radius, then to the others.  In a task a matrix product screens all pairs of a cell; its
error is bounded, and distances are worked out exactly for the pairs that may count.

* Identical training rows: only the k smallest ids of a copy group can be among
  the k nearest, so the others are left out by a ranked limit Spark applies
  before its shuffle.
* Crowded cells: a region's training rows and the queries that visit it are both split into
  blocks of bounded size; a task compares one block of each, and emits at most k rows per
  query."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnpanel.functions.exprs import key_hash
from churnpanel.functions.scale import materialize

#: Most rows of one side that are compared by a task at once; smaller tables are cut into
#: about ``PARTS`` regions, of at least ``LEAST_ROWS``.
BLOCK_ROWS, LEAST_ROWS, PARTS = 50_000, 2_000, 16
#: Cells of the distance matrix, and pairs worked out exactly, that a task holds at a time (both
#: stay in a core's cache).
MATRIX, PAIRS = 1 << 17, 1 << 12
#: Most cells, and the sampled training rows for each that place the pivots.
MOST_CELLS, SAMPLE = 1024, 16


def _exact(q: np.ndarray, r: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (i, j), summed column by column and rounded."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        a, b = i[at:at + PAIRS], j[at:at + PAIRS]
        gap = q[a] - r[b]
        gap *= gap
        d = np.zeros(len(a))
        for f in range(q.shape[1]):
            d += gap[:, f]
        out[at:at + PAIRS] = np.round(np.sqrt(d), 9)
    return out


class _Screen:
    """Squared distances of queries and training rows by matrix products, with a bound on their
    error (``slack``, one for each query): a pair left out is farther than the limit."""

    def __init__(self, q: np.ndarray, r: np.ndarray):
        self.q, self.r = q, r
        with np.errstate(all="ignore"):
            centre = r.mean(axis=0) if len(r) else np.zeros(q.shape[1])
            near, far = q - centre, r - centre
            self.qq, rr = (near ** 2).sum(axis=1), (far ** 2).sum(axis=1)
            most = rr.max(initial=0.0)
            # |q|^2 + |r|^2 - 2 q r as one product
            self.near = np.hstack([-2 * near, self.qq[:, None], np.ones((len(q), 1))])
            self.far = np.hstack([far, np.ones((len(r), 1)), rr[:, None]])
            # rows that are not finite, or whose squares are not, are compared without a screen
            self.sound = bool(np.isfinite(most) and np.isfinite(self.qq).all() and max(most, self.qq.max(initial=0.0)) < 1e290)
        self.slack = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (self.qq + most)

    def tiles(self, rows: np.ndarray, cell: slice):
        """Blocks of ``rows`` with their squared distances to the training rows of ``cell``."""
        far = self.far[cell].T
        step = max(1, MATRIX // max(1, far.shape[1]))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            yield some, self.near[some] @ far if self.sound else np.zeros((len(some), far.shape[1]))

    def limit(self, radius: np.ndarray) -> np.ndarray:
        """Greatest screened value of a pair whose rounded distance may be ``radius``."""
        return (radius + 1e-9) ** 2 * (1 + 1e-12) + self.slack


def _own_radius(screen: _Screen, rows: np.ndarray, cell: slice, k: int, q_ids: np.ndarray, r_ids: np.ndarray,
                include_self: bool) -> np.ndarray:
    """No less than the distance of each query's k-th nearest training row in ``cell``."""
    out = np.full(len(rows), np.inf)
    if not screen.sound:
        return out
    at = 0
    for some, d in screen.tiles(rows, cell):
        if not include_self:
            d[q_ids[some, None] == r_ids[None, cell]] = np.inf
        if d.shape[1] >= k:
            kth = np.partition(d, k - 1, axis=1)[:, k - 1]
            out[at:at + len(some)] = np.sqrt(np.maximum(kth + screen.slack[some], 0))
        at += len(some)
    return out


def _nearest(screen: _Screen, q_ids: np.ndarray, r_ids: np.ndarray, k: int, include_self: bool,
             radius: np.ndarray, wanted: list[tuple[slice, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, training row index and distance of at most ``k`` nearest rows of each query.

    ``wanted`` has the rows of each cell and the queries that visit it."""
    limit = screen.limit(radius)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for cell, rows in wanted:
        for some, d in screen.tiles(rows, cell):
            i, j = np.divmod(np.flatnonzero(d <= limit[some, None] if screen.sound else np.ones_like(d, bool)), d.shape[1])
            i, j = some[i], j + cell.start
            if not include_self:
                other = q_ids[i] != r_ids[j]
                i, j = i[other], j[other]
            if len(i):
                # the best of this block go on, so that what is held stays bounded
                found.append(_best(i, j, _exact(screen.q, screen.r, i, j), r_ids, k))
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return _best(*(np.concatenate(part) for part in zip(*found)), r_ids, k)


def _best(i: np.ndarray, j: np.ndarray, d: np.ndarray, r_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    real = np.isfinite(d)
    i, j, d = i[real], j[real], d[real]
    order = np.lexsort((r_ids[j], d, i))
    i, j, d = i[order], j[order], d[order]
    first = np.searchsorted(i, i)
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], d[keep]


@dataclass(frozen=True)
class Cells:
    """Pivots and, for each cell, its rows' number and range of distances to the pivot."""

    pivots: np.ndarray
    near: np.ndarray
    far: np.ndarray
    rows: np.ndarray

    def distances(self, points: np.ndarray) -> np.ndarray:
        out = np.empty((len(points), len(self.pivots)))
        for at in range(0, len(self.pivots), 64):
            gap = points[:, None, :] - self.pivots[None, at: at + 64, :]
            out[:, at: at + 64] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
        return out

    def bounds(self, points: np.ndarray, between: np.ndarray | None = None) -> np.ndarray:
        """Least possible distance of each point to the rows of each cell.  ``between`` has the
        distances of the pivots where they are known."""
        d = self.distances(points)
        own = d.argmin(axis=1)
        mine = d[np.arange(len(d)), own][:, None]
        apart = (self.distances(self.pivots) if between is None else between)[own]
        half = np.divide(d * d - mine * mine, 2 * apart, out=np.zeros_like(d), where=apart > 0)
        return np.maximum.reduce([np.zeros_like(d), d - self.far, self.near - d, half])

    def regions(self, most: int) -> np.ndarray:
        """The region of each cell: neighbouring cells with ``most`` rows together, or one cell
        that has more."""
        between = self.distances(self.pivots)
        out, count = np.full(len(self.pivots), -1), 0
        while (out < 0).any():
            seed = int(np.flatnonzero(out < 0)[0])
            left = [c for c in np.argsort(between[seed], kind="stable") if out[c] < 0 and c != seed]
            rows, out[seed] = self.rows[seed], count
            for c in left:
                if rows + self.rows[c] > most:
                    break
                rows, out[c] = rows + self.rows[c], count
            count += 1
        return out


def _pivots(rows: DataFrame, features: list[str], count: int, seed: int = 5, rounds: int = 6) -> np.ndarray:
    """``count`` pivots from a bounded sample of the rows, moved to the means of what is
    nearest to them."""
    sample = rows.orderBy(key_hash("acc_id", seed), "acc_id").limit(count * SAMPLE).select(*features).toPandas().to_numpy(float)
    sample = np.unique(sample, axis=0)
    pivots = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)]
    for _ in range(rounds):
        own = Cells(pivots, *[np.zeros(len(pivots))] * 3).distances(sample).argmin(axis=1)
        pivots = np.array([sample[own == c].mean(axis=0) if (own == c).any() else pivots[c] for c in range(len(pivots))])
    return np.unique(pivots, axis=0)


def _placed(df: DataFrame, features: list[str], pivots: np.ndarray) -> DataFrame:
    """``df`` with ``cell`` (nearest pivot, the first on ties) and ``p`` (distance to it)."""
    cells = Cells(pivots, *[np.zeros(len(pivots))] * 3)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), 2048):
                f = whole.iloc[at: at + 2048]
                d = cells.distances(f[features].to_numpy(float))
                own = d.argmin(axis=1)
                yield f.assign(cell=own.astype("int32"), p=d[np.arange(len(d)), own])

    more = [T.StructField("cell", T.IntegerType()), T.StructField("p", T.DoubleType())]
    return df.mapInPandas(place, T.StructType([*df.schema.fields, *more]))


def _block(rows: np.ndarray, block_rows: int, key: str, of: str = "cell") -> tuple[Column, Column]:
    """Number of blocks of a row's cell (or region), and the row's own block (by its key)."""
    counts = F.array(*[F.lit(max(1, math.ceil(int(n) / block_rows))) for n in rows])
    blocks = F.get(counts, F.col(of))
    return blocks, F.pmod(F.xxhash64(key), blocks).cast("int")


@dataclass(frozen=True)
class Search:
    """Training rows in cells, and queries beside their own cells, both written."""

    cells: Cells
    refs: DataFrame
    asked: DataFrame


def cell_search(train: DataFrame, query: DataFrame, features: list[str], label: str, keep: int,
                cells: int | None = None) -> Search:
    """Place training rows and queries.  ``keep`` rows of each group of equal training rows
    go on.  The cells grow with the root of the training rows, to ``MOST_CELLS``."""
    def numeric(df: DataFrame, *more: str) -> DataFrame:
        return df.select("acc_id", *more, *[F.col(c).cast("double").alias(c) for c in features])

    copies = Window.partitionBy(*features).orderBy("acc_id")
    refs = numeric(train, label).withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= keep).drop("_copy")
    refs = materialize(refs, "references")
    count = cells or min(MOST_CELLS, max(1, round(math.sqrt(refs.count()) / 2)))
    pivots = _pivots(refs, features, count)
    refs = materialize(_placed(refs, features, pivots), "cells")
    asked = materialize(_placed(numeric(query), features, pivots), "queries")
    near, far, rows = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots))
    # one row for each cell
    for r in refs.groupBy("cell").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("n")).collect():
        near[r.cell], far[r.cell], rows[r.cell] = r.lo, r.hi, r.n
    return Search(Cells(pivots, near, far, rows), refs, asked)


def _visits(search: Search, features: list[str], radius: DataFrame, regions: np.ndarray) -> DataFrame:
    """One row for each region with cells besides its own that a query's radius reaches: their
    numbers are in ``reached``."""
    cells = search.cells
    rows = search.asked.join(radius, "acc_id", "left").withColumn("r", F.coalesce("r", F.lit(float("inf")))).drop("p")
    schema = T.StructType([*rows.schema.fields, T.StructField("region", T.IntegerType()),
                           T.StructField("reached", T.ArrayType(T.IntegerType()))])
    by_region = np.argsort(regions, kind="stable")

    def reach(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between = cells.distances(cells.pivots)
        for whole in frames:
            for at in range(0, len(whole), 2048):
                f = whole.iloc[at: at + 2048].reset_index(drop=True)
                least = cells.bounds(f[features].to_numpy(float), between)
                hit = (least <= f["r"].to_numpy()[:, None] * (1 + 1e-9) + 1e-8) & (cells.rows > 0)
                hit[np.arange(len(f)), f["cell"].to_numpy()] = False
                at_row, cell = np.nonzero(hit[:, by_region])
                cell = by_region[cell]
                # cells of one region follow each other
                new = np.flatnonzero(np.diff(at_row, prepend=-1) | np.diff(regions[cell], prepend=-1))
                if len(new):
                    yield f.iloc[at_row[new]].assign(
                        region=regions[cell[new]].astype("int32"), reached=np.array([*np.split(cell, new[1:]), None], dtype=object)[:-1])

    return rows.mapInPandas(reach, schema)


def knn(
    train: DataFrame, query: DataFrame, features: list[str], label: str, k: int = 5,
    include_self: bool = True, block_rows: int = BLOCK_ROWS, cells: int | None = None,
) -> DataFrame:
    """(acc_id, n_id, dist, label): the k nearest training rows of every query."""
    search = cell_search(train, query, features, label, k if include_self else k + 1, cells)
    return _nearest_in_cells(search, features, label, k, include_self, block_rows)[0]


def visited_cells(
    train: DataFrame, query: DataFrame, features: list[str], label: str, k: int = 5,
    include_self: bool = True, block_rows: int = BLOCK_ROWS, cells: int | None = None,
) -> DataFrame:
    """(acc_id, n_cells, n_visited): how many of the cells each query's radius reaches, its own included."""
    search = cell_search(train, query, features, label, k if include_self else k + 1, cells)
    visits = _nearest_in_cells(search, features, label, k, include_self, block_rows)[1]
    more = visits.groupBy("acc_id").agg(F.sum(F.size("reached")).alias("more"))
    return search.asked.join(more, "acc_id", "left").select(
        "acc_id", F.lit(int((search.cells.rows > 0).sum())).alias("n_cells"), (F.coalesce("more", F.lit(0)) + 1).alias("n_visited"))


def _nearest_in_cells(search: Search, features: list[str], label: str, k: int, include_self: bool,
                      block_rows: int) -> tuple[DataFrame, DataFrame]:
    schema = "acc_id bigint, n_id bigint, dist double, label int"
    cells = search.cells
    block_rows = min(block_rows, max(LEAST_ROWS, math.ceil(cells.rows.sum() / PARTS)))
    regions = cells.regions(block_rows)
    region_of = F.get(F.array(*[F.lit(int(n)) for n in regions]), F.col("cell"))

    def compare(_, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"acc_id": [], "n_id": [], "dist": [], "label": []})
        r = r.rename(columns=lambda c: c.removeprefix("r_")).sort_values("cell", kind="stable")
        q_ids, r_ids, own = q["acc_id"].to_numpy(), r["acc_id"].to_numpy(), q["cell"].to_numpy()
        points, lying = q[features].to_numpy(float), r["cell"].to_numpy()
        starts = np.flatnonzero(np.diff(lying, prepend=-1))
        parts = {int(lying[a]): slice(int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(lying)])}
        screen = _Screen(points, r[features].to_numpy(float))
        if "reached" in q:
            radius = q["r"].to_numpy(float)
            at = np.repeat(np.arange(len(q)), [len(c) for c in q["reached"]])
            reached = np.concatenate(q["reached"].to_numpy())
            wanted = [(part, at[reached == c]) for c, part in parts.items()]
        else:  # the queries' own region
            radius = np.full(len(q), np.inf)
            for c, part in parts.items():
                rows = np.flatnonzero(own == c)
                radius[rows] = _own_radius(screen, rows, part, k, q_ids, r_ids, include_self)
            least = np.empty((len(q), len(parts)))
            between, numbers = cells.distances(cells.pivots), list(parts)
            for a in range(0, len(q), 2048):
                least[a:a + 2048] = cells.bounds(points[a:a + 2048], between)[:, numbers]
            hit = ~(least > (radius * (1 + 1e-9) + 1e-8)[:, None])
            wanted = [(part, np.flatnonzero(hit[:, n] | (own == c))) for n, (c, part) in enumerate(parts.items())]
        i, j, d = _nearest(screen, q_ids, r_ids, k, include_self, radius, wanted)
        return pd.DataFrame({"acc_id": q_ids[i], "n_id": r_ids[j], "dist": d,
                             "label": r[label].to_numpy()[j].astype("int64")})

    def visit(visits: DataFrame, *more: str) -> DataFrame:
        size = np.zeros(regions.max() + 1)
        np.add.at(size, regions, cells.rows)
        asked = np.zeros(len(size))
        for row in visits.groupBy("region").count().collect():  # one row for each region
            asked[row["region"]] = row["count"]
        q_blocks, q_block = _block(asked, block_rows, "acc_id", "region")
        r_blocks, r_block = _block(size, block_rows, "acc_id", "region")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        q = visits.withColumn("qb", q_block).withColumn("rb", every(r_blocks))
        r = search.refs.withColumn("region", region_of).withColumn("rb", r_block).withColumn("qb", every(q_blocks))
        key = ["region", "rb", "qb"]
        # own names on the reference side: both sides may come from one frame
        named = r.select(*[F.col(c).alias(f"r_{c}") for c in [*key, "cell", "acc_id", *features, label]])
        return q.select(*key, "cell", "acc_id", *features, *more).groupBy(*key).cogroup(
            named.groupBy(*[f"r_{c}" for c in key])).applyInPandas(compare, schema)

    def best(found: DataFrame) -> DataFrame:
        nearest = Window.partitionBy("acc_id").orderBy("dist", "n_id")
        return found.withColumn("_at", F.row_number().over(nearest)).where(F.col("_at") <= k).drop("_at")

    # read by the radius and by the result
    first = materialize(best(visit(search.asked.drop("p").withColumn("region", region_of))), "first-neighbours")
    radius = first.groupBy("acc_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("r"))
    visits = _visits(search, features, radius, regions)
    if regions.max() == 0:
        return first, visits
    visits = materialize(visits, "visits")
    away = visits.where(F.col("region") != region_of)
    return best(first.unionByName(visit(away, "r", "reached"))), visits


def vote(neighbours: DataFrame) -> DataFrame:
    """Majority label per query; ties go to the smaller label."""
    counts = neighbours.groupBy("acc_id", "label").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct(F.col("n"), (-F.col("label")).alias("neg"))).alias("top")
    return counts.groupBy("acc_id").agg(top).select(
        "acc_id", (-F.col("top.neg")).alias("prediction")
    )


def knn_vote(
    train: DataFrame, query: DataFrame, features: list[str], label: str, k: int = 5,
    include_self: bool = True, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return vote(knn(train, query, features, label, k, include_self, block_rows))


def knn_weekly(
    weeks: DataFrame, groups: DataFrame, features: list[str], label: str, k: int = 5,
    include_self: bool = True, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One vote per week, averaged and cut: below 1 → 0, below 2 → 1, else 2 for
    ``amo_group``; below 0.5 → 0, else 1 for ``sur_group``."""
    rows = weeks.join(groups.select("acc_id", label), "acc_id")
    votes = None
    for week in (1, 2, 3, 4):
        one = rows.where(F.col("week") == week)
        found = knn_vote(one, one, features, label, k, include_self, block_rows)
        votes = found if votes is None else votes.unionByName(found)
    mean = votes.groupBy("acc_id").agg(F.avg("prediction").alias("mean_vote"))
    cut = {
        "amo_group": F.when(F.col("mean_vote") < 1, 0).when(F.col("mean_vote") < 2, 1).otherwise(2),
        "sur_group": F.when(F.col("mean_vote") < 0.5, 0).otherwise(1),
    }[label]
    return mean.select("acc_id", "mean_vote", cut.alias("prediction"))
