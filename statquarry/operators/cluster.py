"""K-means of many runs side by side, the elbow table and PCA from moments.

A *run* is one start for one number of clusters.  All runs of a fit or a sweep go through the data together: a pass carries
the centres of every run, each task adds up its points by run and centre, and one aggregate merges these sums, whose number
hangs on the runs only.  Starts are drawn from a bounded sample by farthest-first traversal, which is deterministic: the
same table gives the same clusters whatever its layout.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.operators.partials import matrix, summed, values_of
from statquarry.operators.shape import q
from statquarry.session import materialise

START_SAMPLE = 2_000


# ---- K-means ---------------------------------------------------------------------------------------------------
@dataclass
class KMeansFit:
    """Centres of the best run; ``summary.trainingCost`` and ``transform`` are named as in Spark ML."""

    centres: np.ndarray
    trainingCost: float
    features: str = "features"

    @property
    def summary(self) -> KMeansFit:
        return self

    def transform(self, points: DataFrame) -> DataFrame:
        """All columns plus ``cluster``, the number of the nearest centre, the first of equally near ones."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(values: pd.Series) -> pd.Series:
            return pd.Series(_distances(np.stack(values.to_numpy()), centres).argmin(axis=1).astype(np.int32))

        return points.withColumn("cluster", nearest(values_of(points, self.features)))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances but for the term that is the same for all centres of a point."""
    return (centres * centres).sum(axis=1) - 2 * (x @ centres.T)


def start_sample(points: DataFrame, features: str, key: str | None, seed: int, size: int = START_SAMPLE) -> np.ndarray:
    """``size`` points at most, in the order of a hash of their key (or of their values) and the seed."""
    values = values_of(points, features)
    name = values.cast("string") if key is None else q(key).cast("string")
    rows = points.select(values.alias("values"), name.alias("name")).withColumn(
        "order", F.md5(F.concat_ws("/", "name", F.lit(str(seed))))
    )
    found = rows.orderBy("order", "name").limit(size).select("values").collect()
    return np.array([r[0] for r in found], float)


def farthest_first(sample: np.ndarray, k: int, first: int) -> np.ndarray:
    """``k`` points of the sample: number ``first``, then again and again the one farthest from those chosen so far."""
    chosen = [first % len(sample)]
    far = np.full(len(sample), np.inf)
    while len(chosen) < k:
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(far.argmax()))
    return sample[chosen]


def lloyd(
    points: DataFrame, starts: Sequence[np.ndarray], features: str = "features", max_iter: int = 100, tol: float = 1e-12
) -> list[KMeansFit]:
    """Run Lloyd's iterations from every start, all runs in the same passes.

    A run rests when its centres move by less than ``tol`` (sum of squares); then it is no longer carried.  A cluster that
    loses all its points keeps its centre.  ``trainingCost`` is the inertia about the final centres.
    """
    values = points.select(values_of(points, features).alias("values"))
    centres = [np.array(s, float) for s in starts]
    cost = np.zeros(len(centres))
    moving = list(range(len(centres)))
    for turn in range(max_iter + 1):
        shared = points.sparkSession.sparkContext.broadcast([(r, centres[r]) for r in moving])

        def partial(batches: Iterator[pa.RecordBatch]):
            runs = shared.value
            stacked = np.concatenate([c for _, c in runs])
            edges = np.cumsum([0, *(len(c) for _, c in runs)])
            lines = np.zeros((len(stacked), 2 + stacked.shape[1]))  # points, squared distances, sum of points
            for batch in batches:
                x = matrix(batch.column(0))
                distances = _distances(x, stacked)
                for low, high in zip(edges[:-1], edges[1:]):
                    own = low + distances[:, low:high].argmin(axis=1)
                    lines[:, 0] += np.bincount(own, minlength=len(lines))
                    lines[:, 1] += np.bincount(own, ((x - stacked[own]) ** 2).sum(axis=1), len(lines))
                    order = np.argsort(own, kind="stable")
                    heads = np.flatnonzero(np.diff(own[order], prepend=-1))
                    lines[own[order[heads]], 2:] += np.add.reduceat(x[order], heads, axis=0)
            seen = np.flatnonzero(lines[:, 0])
            run = np.repeat([r for r, _ in runs], np.diff(edges))
            yield (run[seen], (np.arange(len(lines)) - np.repeat(edges[:-1], np.diff(edges)))[seen]), lines[seen]

        found = summed(values, partial, ["run", "centre"])
        shared.destroy()
        cost[moving] = 0.0
        moved = {r: centres[r].copy() for r in moving}
        for (run, centre), line in found.items():
            cost[run] += line[1]
            moved[run][centre] = line[2:] / line[0]
        if turn == max_iter:
            break
        moving = [r for r in moving if ((moved[r] - centres[r]) ** 2).sum() > tol]
        for r in moving:
            centres[r] = moved[r]
        if not moving:
            break
    return [KMeansFit(c, float(x), features) for c, x in zip(centres, cost)]


def sweep(
    points: DataFrame, k_range: Iterable[int], n_init: int, seed: int, features: str, max_iter: int, key: str | None = None,
    stored: bool = False,
) -> dict[int, KMeansFit]:
    """The best fit of ``n_init`` starts for every number of clusters; the first of equally good ones."""
    wanted = list(dict.fromkeys(k_range))
    if not wanted:
        return {}
    if min(wanted) < 1 or n_init < 1:
        raise ValueError("clusters and starts are counted from 1")
    kept = points if stored else materialise(points.select(*([] if key is None else [key]), features))
    sample = start_sample(kept, features, key, seed)
    if not len(sample):
        return {}
    # a traversal holds that of every smaller number of clusters at its beginning
    longest = [farthest_first(sample, max(wanted), r) for r in range(n_init)]
    fits = lloyd(kept, [longest[r][:k] for k in wanted for r in range(n_init)], features, max_iter)
    return {k: min(fits[i * n_init : (i + 1) * n_init], key=lambda f: f.trainingCost) for i, k in enumerate(wanted)}


def best_kmeans(
    points: DataFrame, k: int, n_init: int = 10, seed: int = 42, features: str = "features", max_iter: int = 100,
    stored: bool = False, key: str | None = None,
) -> KMeansFit:
    """The fit with the least inertia out of ``n_init`` starts.  ``stored``: ``points`` is cheap to read again.

    ``key`` names a unique column whose hash draws the starts; without it the values are hashed.
    """
    return sweep(points, [k], n_init, seed, features, max_iter, key, stored)[k]


def total_inertia(points: DataFrame, features: str = "features") -> float:
    """Inertia of one cluster: squared distance to the centre, from the variances."""
    row = points.select(
        Summarizer.metrics("variance", "count").summary(F.col(features)).alias("s")
    ).select("s.variance", "s.count").first()
    return float(sum(row["variance"])) * (row["count"] - 1)


def elbow(
    points: DataFrame,
    k_range: Iterable[int] = range(3, 16),
    n_init: int = 1,
    seed: int = 42,
    features: str = "features",
    max_iter: int = 100,
    stored: bool = False,
    key: str | None = None,
) -> DataFrame:
    """``k, inertia``, one row per tried ``k``."""
    fits = sweep(points, k_range, n_init, seed, features, max_iter, key, stored)
    return points.sparkSession.createDataFrame([(k, f.trainingCost) for k, f in fits.items()], "k int, inertia double")


def assign_clusters(points: DataFrame, model: KMeansFit) -> DataFrame:
    """All columns plus ``cluster``; the row keeps its own columns, so nothing is joined back."""
    return model.transform(points)


def check_k(k: int, n_rows: int) -> int:
    if not 0 < k < n_rows:
        raise ValueError(f"k must lie between 1 and {n_rows - 1}, got {k}")
    return k


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"))


# ---- principal components -----------------------------------------------------------------------------------------
def moments(points: DataFrame, features: str = "features") -> tuple[int, np.ndarray, np.ndarray]:
    """Number of points, mean and covariance (divided by n - 1), in one aggregate of d + 1 vectors for each task.

    Products are taken about one of the points, so that large means don't drown small deviations.
    """
    values = points.select(values_of(points, features).alias("values"))
    first = values.first()
    if first is None:
        raise ValueError("no points")
    origin = np.array(first[0], float)

    def partial(batches: Iterator[pa.RecordBatch]):
        lines = np.zeros((len(origin) + 1, len(origin) + 1))  # number of points with every line; sums, then products
        for batch in batches:
            x = matrix(batch.column(0)) - origin
            lines[:, 0] += len(x)
            lines[0, 1:] += x.sum(axis=0)
            lines[1:, 1:] += x.T @ x
        yield (np.arange(len(lines)),), lines

    found = summed(values, partial, ["line_no"])
    n, rows = found[0,][0], np.array([found[k,][1:] for k in range(len(origin) + 1)])
    shift = rows[0] / n
    covariance = (rows[1:] - n * np.outer(shift, shift)) / max(n - 1, 1)
    return int(n), origin + shift, (covariance + covariance.T) / 2


class CentredPCA:
    """PCA of the centred matrix with a fixed sign: the largest loading of each component is positive."""

    def __init__(self, points: DataFrame, components: int = 2, features: str = "features"):
        self.features = features
        self.n, self.mean, covariance = moments(points, features)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        loadings = vectors[:, order].T
        self.loadings = loadings * np.where(loadings[np.arange(len(order)), np.abs(loadings).argmax(axis=1)] >= 0, 1.0, -1.0)[:, None]
        total = np.trace(covariance)
        self.shares = [float(x / total) if total > 0 else 0.0 for x in values[order]]

    def transform(self, points: DataFrame) -> DataFrame:
        """All columns plus ``pca1, pca2, …``."""
        values = values_of(points, self.features)

        def projected(loading: np.ndarray) -> Column:
            weights = F.array(*[F.lit(float(w)) for w in loading])
            dot = F.aggregate(F.zip_with(values, weights, lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
            return dot - F.lit(float(self.mean @ loading))

        return points.withColumns({f"pca{i + 1}": projected(loading) for i, loading in enumerate(self.loadings)})

    @property
    def explained(self) -> list[float]:
        """Share of the total variance per component."""
        return self.shares
