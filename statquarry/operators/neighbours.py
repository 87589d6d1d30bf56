"""Exact nearest-neighbour imputation without comparing all pairs of rows.

Distance between two rows is Euclidean over the coordinates both have, scaled by ``sqrt(features / shared)``.  It is never
smaller than the difference in any single shared coordinate, which is what the search uses:

1. A row and a donor meet in the grid of the (at most three) widest features that both have.  A row is placed in every
   grid in which donors can meet it, a donor in every grid in which rows ask for it, so nobody has to look into a cell
   of donors without a value on an axis: those that share no feature with a row are never paired with it.  Gap patterns
   are told apart on the ``_TOP`` widest features; pairs that share none of these meet on the widest of the others.
   With many different grids the widest shared feature alone is used, which bounds their number by that of features.
2. A few *seed* donors of a row's own cell, of its coarse cell and of its whole grid bound the distance of its ``k``-th
   neighbour: any ``k`` donors give a valid bound.
3. Only cells that reach into the bound are joined, only pairs within it are ranked.

Donors with equal features collapse to their ``k`` smallest keys beforehand: they are at equal distance from everything and
ties go by key, so no other copy can be chosen.  A hot group of copies therefore never meets itself.

The donors and the rows with gaps are read several times, so both are checkpointed (shared folder, see
``statquarry.session.materialise``) instead of recomputing the input each time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from math import isfinite

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statquarry.operators.shape import q
from statquarry.session import materialise, splittable_join

_AXES = 3  # per grid
_GRIDS = 16  # with more combinations of axes, one axis per grid
_TOP = 6  # widest features on which gap patterns are told apart
_ROWS_PER_CELL = 24
_CUTS = 64  # equal-count intervals per axis; each is split further into equal-width slices
_SLACK = 1 + 1e-9
_UNUSED = -2


@dataclass
class _Axis:
    """One grid axis: feature position, spread, equal-count cut points from minimum to maximum."""

    position: int
    spread: float
    cuts: list[float] = field(default_factory=list)

    @cached_property
    def edges(self) -> Column:
        return F.array(*[F.lit(c) for c in self.cuts]).cast("array<double>")

    def place(self, value: Column) -> Column:
        """``(interval, share)``: the equal-count interval and how far into it, non-decreasing in ``value``.

        Values beyond the cut points fall into the outer intervals; NULL for a NULL value.
        """
        if not self.cuts:
            return F.when(value.isNotNull(), F.struct(F.lit(0).alias("interval"), F.lit(0.0).alias("share")))
        edges = self.edges
        passed = F.size(F.filter(edges, lambda c: c <= value))
        interval = F.greatest(F.least(passed, F.lit(len(self.cuts) - 1)), F.lit(1)) - 1
        low, high = F.get(edges, interval), F.get(edges, interval + 1)
        share = F.least(F.greatest((value - low) / (high - low), F.lit(0.0)), F.lit(1.0))
        return F.when(value.isNotNull(), F.struct(interval.alias("interval"), share.alias("share")))


def _cell(place: Column, slices: int) -> Column:
    """Cell number of a place; ``-n`` slices put ``n`` intervals into one cell."""
    if slices < 0:
        return F.floor(place["interval"] / -slices).cast("int")
    inside = F.least(F.floor(place["share"] * slices), F.lit(slices - 1))
    return (place["interval"] * slices + inside).cast("int")


@dataclass
class _Grid:
    """The grid for pairs whose widest shared axes are ``shared``.

    ``rows`` and ``donors`` hold the gap patterns that enter (None: all that have the axis), ``hidden`` the axes that a
    pair must not share, as bits, ``slices`` the slices per interval of the axes that are worth splitting (``-n``: ``n``
    intervals to a cell).
    """

    shared: tuple[int, ...]
    hidden: int
    rows: set[int] | None = None
    donors: set[int] | None = None
    slices: dict[int, int] = field(default_factory=dict)

    @property
    def used(self) -> tuple[int, ...]:
        return tuple(self.slices)


def _slices(axes: list[_Axis], shared: tuple[int, ...], n_rows: int) -> dict[int, int]:
    """Near-cubic cells of about ``_ROWS_PER_CELL`` rows: an axis narrower than a cell's side is not split."""
    cells = max(1.0, n_rows / _ROWS_PER_CELL)
    chosen, side = [], float("inf")
    for count in range(1, len(shared) + 1):
        product = 1.0
        for i in shared[:count]:
            product *= axes[i].spread
        candidate = (product / cells) ** (1 / count)
        if axes[shared[count - 1]].spread <= candidate and count > 1:
            break
        chosen, side = list(shared[:count]), candidate
    slices = {}
    for i in chosen:
        wanted = axes[i].spread / side if side > 0 else 1.0
        intervals = max(1, len(axes[i].cuts) - 1)
        # too many cells would be as bad as too few: the donors of a row's own cell give it its bound
        slices[i] = max(1, round(wanted / intervals)) if wanted >= intervals else -round(intervals / max(1.0, wanted))
    return slices


def _grids(axes: list[_Axis], asked: set[tuple[int, int]], held: dict[int, int]) -> dict[str, _Grid]:
    """The grids by name, from the rows' gap patterns with their missing features and the donors' patterns with counts."""
    top = range(min(_TOP, len(axes)))
    bit = {axes[i].position: 1 << i for i in top}
    for most in (_AXES, 1):
        met = defaultdict(lambda: (set(), set()))
        for row, t in asked:
            for donor in held:
                shared = tuple(i for i in top if row & donor & 1 << i)[:most]
                if shared and (t not in bit or donor & bit[t]):
                    met[shared][0].add(row)
                    met[shared][1].add(donor)
        if len(met) <= _GRIDS:
            break
    grids = {}
    for shared, (rows, donors) in sorted(met.items()):
        others = [i for i in top if i not in shared and (len(shared) < most or i < shared[-1])]
        grid = _Grid(shared, sum(1 << i for i in others), rows, donors)
        grid.slices = _slices(axes, shared, sum(held[d] for d in donors))
        grids[",".join(map(str, shared))] = grid
    for i in range(len(top), len(axes)):
        grids[str(i)] = _Grid((i,), (1 << len(top)) - 1, slices=_slices(axes, (i,), sum(held.values())))
    return grids


def knn_impute(
    df: DataFrame, features: Sequence[str], key: str, k: int = 5, donors: DataFrame | None = None
) -> DataFrame:
    """Fill NULL features with the mean over the ``k`` nearest rows that have the feature.

    Ties go to the smaller key; a row that shares no coordinate with any donor gets the column mean.  ``donors``
    (default: ``df`` itself) needs the same key and features; ``key`` is unique.
    """
    features = list(features)
    width = len(features)
    pool = df if donors is None else donors
    vector = F.array(*[q(f).cast("double") for f in features])
    means, axes = _survey(pool, features)
    empty = [F.get(vector, F.lit(i)).isNull() for i in range(width)]
    missing = F.filter(F.array(*[F.when(empty[i], F.lit(i)) for i in range(width)]), lambda t: t.isNotNull())
    gaps = df.where(F.coalesce(*[q(f).cast("double") for f in features]).isNotNull()).select(
        q(key).alias("rid"), vector.alias("rvec"), F.explode(missing).alias("t")
    )
    gaps = materialise(_with_places(gaps, "rvec", axes))
    asked = {(r["known"], r["t"]) for r in gaps.select("known", "t").distinct().collect()}  # gap patterns, not rows

    copies = Window.partitionBy("vec").orderBy("id")
    placed = (
        pool.select(q(key).alias("id"), vector.alias("vec"))
        .withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy")
    )
    placed = materialise(_with_places(placed, "vec", axes))
    held = {r["known"]: r["count"] for r in placed.groupBy("known").count().collect()}
    grids = _grids(axes, asked, held)

    filled = None
    if asked and grids:
        pairs = _candidates(gaps, placed, axes, grids, sorted({t for _, t in asked}), k, width)
        nearest = Window.partitionBy("rid", "t").orderBy("dist", "id")
        chosen = pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        filled = chosen.groupBy("rid").agg(
            *[F.avg(F.when(F.col("t") == i, F.col("donated"))).alias(f"__fill{i}") for i in range(width)]
        ).withColumnRenamed("rid", "__rid")
    joined = df if filled is None else df.join(filled, q(key) == F.col("__rid"), "left")
    found = {i: F.lit(None) if filled is None else F.col(f"__fill{i}") for i in range(width)}
    complete = joined.withColumns(
        {f: F.coalesce(q(f).cast("double"), found[i], F.lit(means[f])).cast("double") for i, f in enumerate(features)}
    )
    return complete.drop("__rid", *[f"__fill{i}" for i in range(width)])


def _survey(pool: DataFrame, features: list[str]) -> tuple[dict[str, float | None], list[_Axis]]:
    """Column means and the grid axes from the widest down, with their cut points.

    Every feature that has a value is an axis; one without a (finite) spread has a single cell.
    """
    row = pool.agg(
        *[f(q(c)).alias(f"{name}{i}") for i, c in enumerate(features) for name, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    known = [(row[f"s{i}"], i) for i in range(len(features)) if row[f"s{i}"] is not None]
    spreads = [(s if isfinite(s) else 0.0, i) for s, i in known]
    axes = [_Axis(i, s) for s, i in sorted(spreads, key=lambda pair: (-pair[0], pair[1]))]
    wide = [a for a in axes if a.spread > 0]
    if wide:
        probs = [i / _CUTS for i in range(_CUTS + 1)]
        cuts = pool.approxQuantile([features[a.position] for a in wide], probs, 1 / (4 * _CUTS))
        for axis, found in zip(wide, cuts):
            axis.cuts = sorted(set(found))  # spread above zero: at least two cut points
    return {c: row[f"m{i}"] for i, c in enumerate(features)}, axes


def _with_places(rows: DataFrame, vec: str, axes: list[_Axis]) -> DataFrame:
    """Adds ``known``, which of the ``_TOP`` widest axes have a value, as bits, and ``a<i>``, the place on each axis."""
    values = [F.get(F.col(vec), F.lit(a.position)) for a in axes]
    bits = [F.when(v.isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(values[:_TOP])]
    known = reduce(lambda a, b: a + b, bits, F.lit(0))
    return rows.withColumns({"known": known} | {f"a{i}": a.place(v) for i, (a, v) in enumerate(zip(axes, values))})


def _home(j: int, grid: _Grid) -> Column:
    """Cell number on the grid's ``j``-th axis; a constant when it has fewer."""
    if j >= len(grid.used):
        return F.lit(_UNUSED)
    i = grid.used[j]
    return _cell(F.col(f"a{i}"), grid.slices[i])


def _entered(frame: DataFrame, columns: list[str], side: str, grids: dict[str, _Grid], cells: list[str]) -> DataFrame:
    """``columns`` once for every grid that a row or donor enters, with its name ``p``, coarse cell and cells."""
    spots = []
    for p, grid in grids.items():
        patterns = getattr(grid, side)
        enters = F.col(f"a{grid.shared[0]}").isNotNull() if patterns is None else F.col("known").isin(sorted(patterns))
        spot = F.struct(
            F.lit(p).alias("p"),
            F.col(f"a{grid.used[0]}")["interval"].alias("coarse"),
            *[_home(j, grid).alias(n) for j, n in enumerate(cells)],
        )
        spots.append(F.when(enters, spot))
    return frame.select(*columns, F.inline(F.filter(F.array(*spots), lambda spot: spot.isNotNull())))


def _by_grid(grids: dict[str, _Grid], build) -> Column:
    """The expression built for the grid that a row has entered."""
    chain = F
    for p, grid in grids.items():
        chain = chain.when(F.col("p") == p, build(grid))
    return chain


def _meets(axes: list[_Axis], grids: dict[str, _Grid]) -> Column:
    """Whether this is the one grid in which ``rvec`` and ``vec`` meet."""
    hidden = _by_grid(grids, lambda grid: F.lit(grid.hidden))
    meets = F.col("known").bitwiseAND(F.col("donor_known")).bitwiseAND(hidden) == 0
    rest = [p for p, grid in grids.items() if grid.rows is None]
    if rest:
        both = [F.get("rvec", F.lit(a.position)).isNotNull() & F.get("vec", F.lit(a.position)).isNotNull() for a in axes]
        widest = F.coalesce(*[F.when(b, F.lit(str(i))) for i, b in enumerate(both)])
        meets = meets & (~F.col("p").isin(rest) | (widest == F.col("p")))
    return meets


def _distance(width: int) -> Column:
    """Scaled distance of ``rvec`` and ``vec``, NULL without a shared coordinate.

    Written over arrays: spelt out by feature, the generated method grows beyond what the JVM compiles and is interpreted.
    """
    squares = F.zip_with("rvec", "vec", lambda a, b: (a - b) * (a - b))
    total = F.aggregate(squares, F.lit(0.0), lambda sum_, s: sum_ + F.coalesce(s, F.lit(0.0)))
    shared = F.size(F.filter(squares, lambda s: s.isNotNull()))
    return F.when(shared > 0, F.sqrt(F.lit(float(width)) / shared * total))


def _candidates(
    gaps: DataFrame, placed: DataFrame, axes: list[_Axis], grids: dict[str, _Grid], wanted: list[int], k: int, width: int
) -> DataFrame:
    """``rid, t, id, dist, donated`` of every pair that can be among the ``k`` nearest."""
    cells = [f"g{j}" for j in range(_AXES)]
    donors = placed.withColumn("donor_known", F.col("known"))
    grid = _entered(donors, ["id", "vec", "donor_known"], "donors", grids, cells)
    rows = _entered(gaps, ["rid", "t", "rvec", "known"], "rows", grids, cells)
    bounds = _bounds(rows, grid, cells, wanted, k, width)
    # the cells within reach are stored as numbers: places are costly, an explode would work them out for every cell
    slack, ends = F.col("bound") * _SLACK, {}
    for i in sorted({i for g in grids.values() for i in g.used}):
        value = F.get(F.col("rvec"), F.lit(axes[i].position))
        ends |= {f"from{i}": axes[i].place(value - slack), f"to{i}": axes[i].place(value + slack)}
    reach = [
        _by_grid(grids, lambda g, j=j, end=end: _end(j, g, end)).alias(f"{end}_{name}")
        for j, name in enumerate(cells) for end in ("from", "to")
    ]
    bounded = rows.join(bounds, ["rid", "t"], "left").withColumns(ends)
    bounded = materialise(bounded.select("rid", "t", "rvec", "known", "p", "bound", *reach))
    near = bounded.where(F.col("bound").isNotNull())
    for name in cells:
        near = near.withColumn(name, F.explode(F.sequence(f"from_{name}", f"to_{name}")))
    columns = ["rid", "t", "id", "rvec", "vec", "bound", "known", "donor_known", "p"]
    joined = near.join(grid.drop("coarse"), ["p", *cells]).select(*columns)
    needy = bounded.where(F.col("bound").isNull())
    if not needy.isEmpty():
        # fewer than k donors to compare with: the seeds of whole grids are all there are
        few = needy.join(F.broadcast(_seeds(grid, ["p"], wanted, k)), ["p", "t"])
        joined = joined.unionByName(few.select(*columns))
    donated = F.get(F.col("vec"), F.col("t"))
    pairs = joined.where(donated.isNotNull() & _meets(axes, grids)).select(
        "rid", "t", "id", "bound", donated.alias("donated"), _distance(width).alias("dist")
    )
    # one comparison, so that the distance is worked out once; everything is at most NaN, and NULL goes
    return pairs.where(F.col("dist") <= F.coalesce(F.col("bound") * _SLACK, F.lit(float("nan")))).drop("bound")


def _end(j: int, grid: _Grid, end: str) -> Column:
    """First or last cell of the grid's ``j``-th axis that may hold a donor within the bound."""
    if j >= len(grid.used):
        return F.lit(_UNUSED)
    i = grid.used[j]
    return _cell(F.col(f"{end}{i}"), grid.slices[i])


def _with_feature(placed: DataFrame, wanted: list[int]) -> DataFrame:
    """One row per donor and wanted feature it has."""
    own = F.array(*[F.when(F.get(F.col("vec"), F.lit(t)).isNotNull(), F.lit(t)) for t in wanted])
    return placed.select("*", F.explode(F.filter(own, lambda t: t.isNotNull())).alias("t"))


def _seeds(grid: DataFrame, keys: list[str], wanted: list[int], k: int) -> DataFrame:
    """A few donors of each wanted feature for each cell named by ``keys``."""
    order = Window.partitionBy(*keys, "t").orderBy("id")
    ranked = _with_feature(grid, wanted).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= 4 * k).select(*keys, "t", "id", "vec", "donor_known")


def _bounds(rows: DataFrame, grid: DataFrame, cells: list[str], wanted: list[int], k: int, width: int) -> DataFrame:
    """``rid, t, bound``: a distance within which ``k`` donors of feature ``t`` lie; absent when seeds do not suffice."""
    tried = None
    for keys in (["p", *cells], ["p", "coarse"], ["p"]):
        found = _seeds(grid, keys, wanted, k).drop("donor_known")
        # 4k rows per grid and wanted feature for whole grids
        pairs = rows.join(F.broadcast(found), ["p", "t"]) if keys == ["p"] else splittable_join(rows, found, [*keys, "t"])
        part = pairs.select("rid", "t", "id", _distance(width).alias("dist"))
        tried = part if tried is None else tried.unionByName(part)
    # whoever meets in a grid shares a feature: no distance is NULL
    tried = tried.groupBy("rid", "t", "id").agg(F.min("dist").alias("dist"))
    order = Window.partitionBy("rid", "t").orderBy("dist", "id")
    ranked = tried.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") == k).select("rid", "t", F.col("dist").alias("bound"))
