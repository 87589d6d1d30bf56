"""Gradient-boosted regression trees of many trials side by side, grown level by level from histograms.

Rows are reduced to small bin numbers once.  A pass adds up residuals by (trial, node, feature, bin) in the tasks and merges
these histograms in one aggregate; the driver reads only them, chooses the splits of a level for all trials, and starts the
next pass.  Their size hangs on trials, nodes, features and bins, not on the rows.  A *trial* is a set of parameters and,
for cross-validation, the fold it leaves out, so a whole random search takes as many passes as its longest model.

Every ``refresh`` trees the predictions so far are written with the rows, and the new trees are added to ``folder`` (if one is
given), where a search that was interrupted goes on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.operators.partials import matrix, summed, values_of
from statquarry.operators.shape import q
from statquarry.session import materialise

BINS, CELLS = 32, 1024
TREE_ROWS = "trial int, tree int, node int, feature int, split int, n double, gain double, value double"


@dataclass(frozen=True)
class Trial:
    """``min_split``: a node of fewer rows is not split.  ``fold``: rows of this fold are left out and scored."""

    trees: int = 100
    rate: float = 0.1
    depth: int = 3
    min_split: int = 2
    subsample: float = 1.0
    fold: int | None = None


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2i + 1 (bin up to ``split``) and 2i + 2.  Leaves have feature -1."""

    feature: np.ndarray
    split: np.ndarray
    n: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @staticmethod
    def bare(depth: int) -> Tree:
        size = (2 << depth) - 1
        return Tree(np.full(size, -1), np.zeros(size, int), np.zeros(size), np.zeros(size), np.zeros(size))

    def leaves(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row after so many levels."""
        node, rows = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(levels):
            feature = self.feature[node]
            right = bins[rows, feature] > self.split[node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1


@dataclass
class Grid:
    """How a feature's values become bins: equal cells between least and greatest value, gathered into bins of about equal
    numbers of rows.  A value beyond the ends lies in the outermost cell."""

    low: np.ndarray
    width: np.ndarray
    bins: np.ndarray  # by feature and cell

    def __call__(self, x: np.ndarray) -> np.ndarray:
        cell = np.floor((x - self.low) / np.where(self.width > 0, self.width, 1.0))
        cell = np.clip(np.nan_to_num(cell), 0, self.bins.shape[1] - 1).astype(int)
        return self.bins[np.arange(x.shape[1]), cell]


def grid(rows: DataFrame, features: str = "features", bins: int = BINS, cells: int = CELLS) -> Grid:
    """The bins of all features, from two aggregates: ends, then counts by cell."""
    values = rows.select(values_of(rows, features).alias("values"))
    if not values.head(1):
        raise ValueError("no rows")
    ends = values.select(Summarizer.metrics("min", "max", "count").summary(array_to_vector("values")).alias("s")).select("s.*").first()
    low, high = ends["min"].toArray(), ends["max"].toArray()
    width, features_ = (high - low) / cells, len(low)
    # every cell a bin of its own, to count them
    fine = Grid(low, width, np.tile(np.arange(cells), (features_, 1)))

    def partial(batches: Iterator[pa.RecordBatch]):
        counts = np.zeros(features_ * cells)
        for batch in batches:
            at = fine(matrix(batch.column(0))) + np.arange(features_) * cells
            counts += np.bincount(at.ravel(), minlength=len(counts))
        yield (np.arange(features_),), counts.reshape(features_, cells)

    found = summed(values, partial, ["feature"])
    counts = np.array([found[k,] for k in range(features_)])
    before = np.cumsum(counts, axis=1) - counts
    return Grid(low, width, (before * bins // ends["count"]).astype(int))


@dataclass
class Boosted:
    """A grown trial: ``start`` plus ``rate`` times the values of the leaves a row falls into."""

    grid: Grid
    trial: Trial
    start: float
    trees: list[Tree] = field(default_factory=list)
    features: str = "features"

    def raw(self, bins: np.ndarray, since: int = 0) -> np.ndarray:
        """What the trees from number ``since`` on add."""
        out = np.zeros(len(bins))
        for tree in self.trees[since:]:
            out += self.trial.rate * tree.value[tree.leaves(bins, tree.depth)]
        return out

    def transform(self, df: DataFrame, name: str = "predicted_log") -> DataFrame:
        """All columns plus the prediction."""

        @F.pandas_udf("double")
        def predicted(values: pd.Series) -> pd.Series:
            return pd.Series(self.start + self.raw(self.grid(np.stack(values.to_numpy()))))

        return df.withColumn(name, predicted(values_of(df, self.features)))

    def importances(self) -> np.ndarray:
        """Gain of the splits of every feature, as a share of all gains."""
        total = np.zeros(len(self.grid.low))
        for tree in self.trees:
            inner = tree.feature >= 0
            if inner.any():
                np.add.at(total, tree.feature[inner], tree.gain[inner] / tree.n[0])
        return total / total.sum() if total.sum() > 0 else total


def splitting_hash(row: np.ndarray, tree: int) -> np.ndarray:
    """32 bits for a row (a number of 32 bits) and a tree."""
    x = (row.astype(np.uint64) ^ np.uint64(tree * 2654435761 % (1 << 32))) & np.uint64(0xFFFFFFFF)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):  # the finaliser of MurmurHash3
        x = ((x ^ (x >> np.uint64(shift))) * np.uint64(factor)) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(16))


def _drawn(row: np.ndarray, tree: int, share: float) -> np.ndarray:
    return splitting_hash(row, tree) < share * (1 << 32) if share < 1 else np.ones(len(row), bool)


def binned(df: DataFrame, made: Grid, features: str, label: str, key: str, folds: int, seed: int) -> DataFrame:
    """Written table (row, fold, label, bins, base): 32 bits and a fold from the key's hash, and a byte for each feature."""
    digest = F.md5(F.concat_ws("/", q(key).cast("string"), F.lit(f"{seed}/fold")))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    rows = df.select(
        part(1).alias("row"), (part(9) % folds).cast("int").alias("fold"), q(label).cast("double").alias("label"),
        values_of(df, features).alias("values"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                body = made(matrix(batch.column("values"))).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "fold", "label")), pa.array([r.tobytes() for r in body], pa.binary()),
                     pa.array([b""] * len(body), pa.binary())],
                    names=["row", "fold", "label", "bins", "base"],
                )

    return materialise(rows.mapInArrow(run, "row long, fold int, label double, bins binary, base binary"))


def _bytes(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _rows_of(batch: pa.RecordBatch, models: dict[int, Boosted], since: int):
    """(trial, model, row, label, bins, prediction, left out) for each model and the rows of a batch."""
    bins, base = _bytes(batch.column("bins"), np.uint8), _bytes(batch.column("base"), np.float64)
    row, fold, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "fold", "label"))
    for number, model in models.items():
        held = base[:, number] if base.shape[1] else model.start
        out = np.zeros(len(row), bool) if model.trial.fold is None else fold == model.trial.fold
        yield number, model, row, label, bins, held + model.raw(bins, since), out


def _best_split(counts: np.ndarray, sums: np.ndarray) -> tuple[int, int, float] | None:
    """(feature, split, gain) of the greatest gain, to six decimals; the first feature and bin of equal ones."""
    left_n, left_s = counts.cumsum(axis=1), sums.cumsum(axis=1)
    n, s = left_n[:, -1:], left_s[:, -1:]
    right_n, right_s = n - left_n, s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s**2 / left_n + right_s**2 / right_n - s**2 / n
    gain = np.round(np.where((left_n > 0) & (right_n > 0), gain, 0.0), 6)
    at = int(gain.argmax())
    if gain.flat[at] <= 0:
        return None
    return (*divmod(at, counts.shape[1]), float(gain.flat[at]))


def grow(
    df: DataFrame, trials: Sequence[Trial], features: str, label: str, key: str, folds: int = 5, seed: int = 42, bins: int = BINS,
    cells: int = CELLS, refresh: int = 10, folder: str | None = None, stop_after: int | None = None,
) -> tuple[list[Boosted], DataFrame]:
    """The grown trials and the table of binned rows.  ``stop_after``: stop once so many trees are written to ``folder``."""
    if bins > 256:
        raise ValueError("a bin is one byte: 256 bins at most")
    spark = df.sparkSession
    data = materialise(df.select(q(key), q(features), q(label)))  # read three times
    made = grid(data, features, bins, cells)
    rows = binned(data, made, features, label, key, folds, seed)
    sums = {r["fold"]: (r["n"], r["s"]) for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("s")).collect()}
    models = []
    for trial in trials:
        kept = [x for fold, x in sums.items() if fold != trial.fold]
        models.append(Boosted(made, trial, sum(s for _, s in kept) / max(1, sum(n for n, _ in kept)), [], features))
    if folder is not None:
        _resume(spark, folder, models)
    written = done = max((len(m.trees) for m in models), default=0)
    if done:
        rows = _with_base(rows, models, 0)
    for tree in range(done, max((t.trees for t in trials), default=0)):
        active = {i: m for i, m in enumerate(models) if m.trial.trees > tree}
        _grow_trees(rows, active, tree, written, made, bins)
        if (tree + 1) % refresh == 0:
            if folder is not None:
                _save_trees(spark, folder, models, written, tree + 1)
            rows = _with_base(rows, models, written)
            written = tree + 1
            if stop_after is not None and written >= stop_after:
                break
    return models, rows


def _grow_trees(rows: DataFrame, active: dict[int, Boosted], number: int, since: int, made: Grid, bins: int) -> None:
    """Add one tree to every active model."""
    spark = rows.sparkSession
    trees = {i: Tree.bare(m.trial.depth) for i, m in active.items()}
    open_ = {i: [0] for i in active}
    for level in range(max(m.trial.depth for m in active.values())):
        wanted = {i: nodes for i, nodes in open_.items() if nodes and level < active[i].trial.depth}
        if not wanted:
            break
        shared = spark.sparkContext.broadcast(({i: active[i] for i in wanted}, trees, wanted))

        def partial(batches: Iterator[pa.RecordBatch]):
            models, growing, nodes = shared.value
            features = len(made.low)
            held = {i: np.zeros((2, len(n) * features * bins)) for i, n in nodes.items()}
            for batch in batches:
                for i, model, row, label, body, predicted, out in _rows_of(batch, models, since):
                    own = np.flatnonzero(~out & _drawn(row, number, model.trial.subsample))
                    slots = np.full(len(growing[i].feature), -1)
                    slots[nodes[i]] = np.arange(len(nodes[i]))
                    slot = slots[growing[i].leaves(body[own], level)]
                    own, slot = own[slot >= 0], slot[slot >= 0]
                    at = ((slot[:, None] * features + np.arange(features)) * bins + body[own]).ravel()
                    residual = np.repeat((label - predicted)[own], features)
                    held[i][0] += np.bincount(at, minlength=held[i].shape[1])
                    held[i][1] += np.bincount(at, residual, held[i].shape[1])
            for i, both in held.items():
                lines = both.reshape(2, -1, bins).transpose(1, 0, 2).reshape(-1, 2 * bins)
                seen = np.flatnonzero(lines[:, :bins].any(axis=1))
                yield (np.full(len(seen), i), seen // features, seen % features), lines[seen]

        found: dict[tuple[int, int], np.ndarray] = {}
        for (i, slot, feature), line in summed(rows, partial, ["trial", "slot", "feature"]).items():
            found.setdefault((i, slot), np.zeros((len(made.low), 2 * bins)))[feature] = line
        shared.destroy()
        open_ = {i: [] for i in active}
        for (i, slot), lines in found.items():
            tree, node = trees[i], wanted[i][slot]
            counts, sums = lines[:, :bins], lines[:, bins:]
            n, s = counts[0].sum(), sums[0].sum()
            tree.n[node], tree.value[node] = n, s / n
            best = _best_split(counts, sums) if n >= active[i].trial.min_split else None
            if best is None:
                continue
            feature, split, tree.gain[node] = best
            tree.feature[node], tree.split[node] = feature, split
            left_n, left_s = counts[feature, : split + 1].sum(), sums[feature, : split + 1].sum()
            for child, child_n, child_s in ((2 * node + 1, left_n, left_s), (2 * node + 2, n - left_n, s - left_s)):
                tree.n[child], tree.value[child] = child_n, child_s / child_n
                open_[i].append(child)
        for nodes in open_.values():
            nodes.sort()
    for i, model in active.items():
        model.trees.append(trees[i])


def _with_base(rows: DataFrame, models: list[Boosted], since: int) -> DataFrame:
    """The rows with the predictions of all trees so far."""
    shared = rows.sparkSession.sparkContext.broadcast(dict(enumerate(models)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [predicted for *_, predicted, _ in _rows_of(batch, shared.value, since)]
                base = np.ascontiguousarray(np.column_stack(columns))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array([r.tobytes() for r in base], pa.binary())], names=batch.schema.names
                )

    return materialise(rows.mapInArrow(run, rows.schema))


def tree_rows(models: list[Boosted], low: int = 0) -> list[tuple]:
    """One row for each node that rows reach, of the trees from number ``low`` on."""
    return [
        (i, low + t, node, int(tree.feature[node]), int(tree.split[node]), float(tree.n[node]), float(tree.gain[node]), float(tree.value[node]))
        for i, model in enumerate(models) for t, tree in enumerate(model.trees[low:]) for node in np.flatnonzero(tree.n).tolist()
    ]


def _part(folder: str, low: int) -> str:
    return f"{folder.rstrip('/')}/trees-{low:06d}"


def _save_trees(spark, folder: str, models: list[Boosted], low: int, high: int) -> None:
    """The trees ``low`` to ``high`` of all trials: one committed write, so a part is there as a whole or not at all."""
    rows = [(*r, high) for r in tree_rows(models, low)]
    spark.createDataFrame(rows, TREE_ROWS + ", high int").coalesce(1).write.mode("overwrite").parquet(_part(folder, low))


def _exists(spark, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _resume(spark, folder: str, models: list[Boosted]) -> None:
    """Take over the trees that an earlier run of the same trials has written."""
    low = 0
    while _exists(spark, _part(folder, low)):
        rows = spark.read.parquet(_part(folder, low)).collect()
        add_trees(models, rows)
        low = rows[0]["high"]


def add_trees(models: list[Boosted], rows: list) -> None:
    for r in sorted(rows, key=lambda r: (r["trial"], r["tree"], r["node"])):
        model = models[r["trial"]]
        if r["tree"] == len(model.trees):
            model.trees.append(Tree.bare(model.trial.depth))
        for name in ("feature", "split", "n", "gain", "value"):
            getattr(model.trees[-1], name)[r["node"]] = r[name]


def held_out_scores(rows: DataFrame, models: list[Boosted], since: int) -> dict[int, float]:
    """R² of every trial on the fold it leaves out, in one pass; ``since``: trees that ``base`` holds already."""
    shared = rows.sparkSession.sparkContext.broadcast({i: m for i, m in enumerate(models) if m.trial.fold is not None})

    def partial(batches: Iterator[pa.RecordBatch]):
        sums = {i: np.zeros(4) for i in shared.value}
        for batch in batches:
            for i, _, _, label, _, predicted, out in _rows_of(batch, shared.value, since):
                y, error = label[out], (label - predicted)[out]
                sums[i] += (len(y), y.sum(), (y * y).sum(), (error * error).sum())
        yield (list(sums),), np.array(list(sums.values())).reshape(-1, 4)

    out = {}
    for (trial,), (n, y, yy, sse) in summed(rows, partial, ["trial"]).items():
        spread = yy - y * y / n if n else 0.0
        out[trial] = float(1 - sse / spread) if spread > 0 else float("nan")
    return out


def fit(df: DataFrame, trial: Trial, features: str, label: str, key: str, **options) -> Boosted:
    """One model on all rows."""
    return grow(df, [trial], features, label, key, **options)[0][0]


@dataclass
class Search:
    """``scores``: (draw, fold, R²); ``best``: the draw of the greatest mean, grown on all rows."""

    draws: list[Trial]
    scores: list[tuple[int, int, float]]
    best: int
    model: Boosted


def search(
    df: DataFrame, draws: Sequence[Trial], features: str, label: str, key: str, folds: int = 5, seed: int = 42,
    refresh: int = 10, folder: str | None = None, together: int = 40, **options,
) -> Search:
    """Cross-validate every draw by folds of the key's hash; up to ``together`` trials share their passes."""
    table = [(d, f, replace(draw, fold=f)) for d, draw in enumerate(draws) for f in range(folds)]
    scores = []
    for low in range(0, len(table), together):
        group = table[low : low + together]
        place = None if folder is None else f"{folder.rstrip('/')}/trials-{low:06d}"
        models, rows = grow(df, [t for *_, t in group], features, label, key, folds, seed, refresh=refresh, folder=place, **options)
        written = max(len(m.trees) for m in models) // refresh * refresh
        found = held_out_scores(rows, models, written)
        scores += [(d, f, found.get(i, float("nan"))) for i, (d, f, _) in enumerate(group)]
    means = [np.nanmean([s for d2, _, s in scores if d2 == d]) for d in range(len(draws))]
    best = int(np.argmax(means))
    place = None if folder is None else f"{folder.rstrip('/')}/best"
    model = fit(df, draws[best], features, label, key, folds=folds, seed=seed, refresh=refresh, folder=place, **options)
    return Search(list(draws), scores, best, model)
