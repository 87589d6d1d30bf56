"""The five jobs end to end, each a function from DataFrames to DataFrames (and one that fits models).

Reading and writing is left to ``statquarry.sources``; every job takes its column names from arguments whose defaults
come from the league configuration.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statquarry.functions.parsing import age_years, money, money_raw, score, strip_space, unsentinel
from statquarry.operators import boosting, cluster, distribution, joins, longform, neighbours, prepare, ranking, shape, stats, valuation
from statquarry.operators.boosting import Boosted
from statquarry.operators.ordering import sort_by_first_name
from statquarry.plans import league
from statquarry.session import materialise
from statquarry.sources import pages as page_source
from statquarry.sources.artefacts import Store


# ---- collect ----------------------------------------------------------------------------------------------------
def collect_wide(pages: DataFrame, edition: str = "later", min_minutes: int = league.MIN_MINUTES) -> DataFrame:
    """Saved stat pages to the wide table, sorted by first name.

    The base table gives the rows (threshold applied before any join); the other tables update them by name.  Only
    the fields that reach the output are extracted.
    """
    wanted = {field for _, field in league.export_fields(edition)} | {"player", "minutes"}
    blocks = materialise(page_source.table_blocks(pages, list(league.TABLE_FIELDS)))  # eight branches read it
    base = page_source.table_rows(blocks, league.BASE_TABLE, [f for f in league.TABLE_FIELDS[league.BASE_TABLE] if f in wanted])
    base = shape.min_threshold(shape.drop_placeholders(base, "player"), "minutes", min_minutes)
    details = []
    for table, fields in league.TABLE_FIELDS.items():
        fields = [f for f in fields if f in wanted]
        if table != league.BASE_TABLE and fields:
            details.append((page_source.table_rows(blocks, table, ["player", *fields]), fields))
    wide = joins.update_join(base.drop("page_id"), details, "player")
    headers = [header for header, _ in league.export_fields(edition)]
    export = shape.export_projection(wide, league.export_fields(edition), keep=["row_no"])
    if edition == "later":
        # which columns are numbers takes a pass of its own, so the parsed table is written once in between
        export = materialise(export)
        export = shape.clean_columns(export, [h for h in headers if h not in league.IDENTITY_COLUMNS])
    return sort_by_first_name(export, "Player", "row_no").select(*[shape.q(h) for h in headers])


# ---- profile ----------------------------------------------------------------------------------------------------
@dataclass
class Profile:
    metrics: list[str]
    long: DataFrame
    ranked: DataFrame
    report: DataFrame
    stats: DataFrame
    wide: DataFrame
    leaders: DataFrame
    counts: DataFrame
    top: DataFrame
    key_report: DataFrame


def profile(
    wide: DataFrame,
    row_no: str,
    entity: str = league.ENTITY,
    group: str = league.GROUP,
    exclude: Sequence[str] = tuple(league.IDENTITY_COLUMNS),
    key_metrics: Sequence[str] = tuple(league.KEY_METRICS),
    lowest_wins: Sequence[str] = tuple(league.LOWEST_WINS),
    k: int = 3,
    approx: bool = False,
) -> Profile:
    """Ranked lists, group statistics and leader boards of every discovered metric."""
    shape.require_columns(wide, [entity, group])
    candidates = shape.choose_columns(wide.columns, [*exclude, row_no])
    metrics = shape.discover_metrics(wide, candidates, "any")
    if not metrics:
        raise ValueError("no metric column found")
    whole = integer_columns(wide, metrics)
    long = longform.to_long(wide.withColumn(group, strip_space(shape.q(group))), metrics, entity, group, row_no)
    table = stats.stats_with_all(long, approx)
    means = stats.group_means(long)
    best = stats.leaders(means)
    return Profile(
        metrics=metrics,
        long=long,
        ranked=ranking.top_and_bottom(long, k),
        report=ranking.topk_report(long, k, whole),
        stats=table,
        wide=stats.stats_wide(table, metrics),
        leaders=best,
        counts=stats.leader_counts(best),
        top=stats.top_group(best),
        key_report=stats.key_metric_report(means, key_metrics, lowest_wins),
    )


def integer_columns(df: DataFrame, metrics: Sequence[str]) -> list[str]:
    """Metrics holding only whole numbers and no gap, which print without a decimal point."""
    text = [m for m in metrics if not longform.is_numeric(df, m)]
    typed = [m for m, t in df.dtypes if m in metrics and t in ("bigint", "int", "smallint", "tinyint")]
    if not text:
        return typed
    row = df.agg(
        *[
            F.bool_and(F.coalesce(F.replace(shape.q(m), F.lit(","), F.lit("")).rlike(r"^\s*[+-]?\d+\s*$"), F.lit(False)))
            .alias(f"i{i}")
            for i, m in enumerate(text)
        ]
    ).first()
    whole = {m for i, m in enumerate(text) if row[f"i{i}"]} | set(typed)
    return [m for m in metrics if m in whole]


def chart_tables(long: DataFrame, bins: int = 15) -> dict[str, DataFrame]:
    """Histogram and density tables of the metrics in ``long``."""
    return {
        "overall": distribution.histogram_fixed(long, bins),
        "by_group": distribution.histogram_by_group(long, bins),
        "auto": distribution.histogram_auto(long),
        "density": distribution.kde_curve(long, bins),
    }


# ---- cluster ----------------------------------------------------------------------------------------------------
@dataclass
class Clustering:
    preprocessor: PipelineModel
    elbow: DataFrame | None
    assigned: DataFrame
    points: DataFrame
    explained: list[float]


def cluster_entities(
    wide: DataFrame,
    k: int,
    entity: str = league.ENTITY,
    categories: Sequence[str] = tuple(league.CATEGORY_COLUMNS),
    age: str | None = league.AGE,
    rule: str = "strict_raw",
    k_range: Sequence[int] = tuple(range(3, 16)),
    sweep_starts: int = 1,
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 100,
) -> Clustering:
    """Impute, scale, one-hot, sweep ``k``, cluster, project to two components.

    ``rule="strict_raw"`` takes only columns without any unreadable cell as numbers; ``"any"`` also those with
    missing-value texts.
    """
    df = wide if age is None or age not in wide.columns else wide.withColumn(age, age_years(unsentinel(shape.q(age))))
    categories = [c for c in categories if c in df.columns]
    candidates = shape.choose_columns(df.columns, [entity, *categories])
    candidates = [c for c in candidates if not dict(df.dtypes)[c].startswith(("struct", "array", "map"))]
    numeric = shape.discover_metrics(df, candidates, rule)
    df = df.withColumns({c: longform.as_number(df, c) for c in numeric})
    df = df.withColumns({c: unsentinel(shape.q(c)) for c in categories})
    model = prepare.feature_pipeline(df, numeric, categories)
    prepared = model.transform(df)
    prepared = materialise(prepared.drop(*prepare.helper_columns(prepared)))  # read by every fit below
    cluster.check_k(k, prepared.count())
    table = cluster.elbow(prepared, k_range, sweep_starts, seed, max_iter=max_iter, stored=True) if k_range else None
    fitted = cluster.best_kmeans(prepared, k, n_init, seed, max_iter=max_iter, stored=True)
    pca = cluster.CentredPCA(prepared)
    assigned = cluster.assign_clusters(prepared, fitted)
    points = pca.transform(assigned).select("pca1", "pca2", "cluster", shape.q(entity))
    return Clustering(model, table, assigned.drop("features"), points, pca.explained)


# ---- transfer values ----------------------------------------------------------------------------------------------
def listed_values(listing_pages: DataFrame) -> DataFrame:
    """Listing pages to numbered rows with parsed scores and values (earlier edition's working table)."""
    rows = page_source.listing_rows(
        listing_pages, league.LISTING_BODY, league.LISTING_TEXTS, league.LISTING_ATTRIBUTES
    )
    rows = page_source.in_scrape_order(rows, "Player").withColumnRenamed("scrape_order", "ScrapeOrder")
    return rows.withColumns(
        {
            "Skill": score(shape.q("SkillText")),
            "Potential": score(shape.q("PotentialText")),
            "ETV_Parsed": money_raw(shape.q("ETV_Raw_Internal")),
        }
    ).drop("SkillText", "PotentialText")


def estimation_table(
    listed: DataFrame, wide: DataFrame, min_minutes: float = league.VALUE_MIN_MINUTES, inclusive: bool = True
) -> DataFrame:
    """Earlier edition: listed rows whose trimmed name plays enough minutes, in scrape order.

    With nobody eligible the result is empty but keeps its columns.
    """
    allowed = shape.eligible(wide, league.MINUTES, min_minutes, inclusive)
    kept = joins.semi_join_exact(listed, allowed, league.ENTITY).orderBy("ScrapeOrder")
    return shape.rename_select(kept, league.EARLIER_VALUE_RENAMES, league.EARLIER_VALUE_COLUMNS)


def valued_players(listing_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Later edition: current value from the listing, highest value from the detail page or else the current one."""
    rows = page_source.listing_rows(
        listing_pages, league.LISTING_BODY, league.LISTING_TEXTS, league.LISTING_ATTRIBUTES
    )
    rows = page_source.in_scrape_order(rows, "Player").where(shape.q("detail_url") != "N/a")
    rows = rows.select(
        "scrape_order", "Player", shape.q("Team_Internal").alias("Team"),
        strip_space(F.split_part(shape.q("Age"), F.lit("-"), F.lit(1))).alias("Age"), "Position",
        money(shape.q("ETV_Raw_Internal")).alias("TransferValue_EUR_Millions"),
        shape.q("detail_url").alias("url"),
    )
    details = page_source.labelled_value(
        detail_pages, league.DETAIL_LABEL_TEXT, league.DETAIL_BLOCK, league.DETAIL_LABEL, league.DETAIL_VALUE
    ).select("url", money(F.col("value")).alias("Highest_ETV_EUR_Millions"))
    found = joins.detail_fallback(rows, details, "url", "Highest_ETV_EUR_Millions", "TransferValue_EUR_Millions")
    return found.orderBy("scrape_order").select(*league.VALUE_COLUMNS)


def valued_eligible(valued: DataFrame, wide: DataFrame, min_minutes: float = league.VALUE_MIN_MINUTES) -> DataFrame:
    """Later edition: valued rows whose accent-free name plays more than the minutes limit."""
    return joins.semi_join_namekey(valued, shape.eligible(wide, league.MINUTES, min_minutes), league.ENTITY)


# ---- valuation ----------------------------------------------------------------------------------------------------
@dataclass
class Valuation:
    preprocessor: PipelineModel
    model: Boosted
    numeric: list[str]
    categories: list[str]
    scored: DataFrame
    scores: DataFrame
    metrics: DataFrame
    importance: DataFrame
    residuals: DataFrame

    def save(self, folder: str) -> int:
        """Publish preprocessor, model and tables together; returns the publication's number."""
        store = Store(self.scored.sparkSession, folder)
        return store.publish(
            preprocessor=self.preprocessor, model=self.model, scores=self.scores, metrics=self.metrics, importance=self.importance
        )

    @staticmethod
    def load(folder: str, spark: SparkSession | None = None) -> tuple[PipelineModel, Boosted]:
        store = Store(spark or SparkSession.getActiveSession(), folder)
        return store.load("preprocessor"), store.load("model")


def training_table(wide: DataFrame, valued: DataFrame, entity: str = league.ENTITY, target: str = league.TARGET) -> DataFrame:
    """Every valued row with its statistics; rows without a target drop out."""
    joined = joins.right_join_suffix(wide, valued, entity)
    return joined.withColumn(target, longform.as_number(joined, target)).na.drop(subset=[target])


def value_entities(
    data: DataFrame,
    key: str,
    entity: str = league.ENTITY,
    target: str = league.TARGET,
    ids: Sequence[str] = tuple(league.ID_COLUMNS),
    keep_leaking: bool = False,
    leaking: str = league.LEAKING_COLUMN,
    draws: int = valuation.DRAWS,
    folds: int = valuation.FOLDS,
    trees: tuple[int, int] = valuation.TREES,
    seed: int = valuation.SEED,
    parallelism: int = 40,
    restart: str | None = None,
) -> Valuation:
    """Split, impute (nearest neighbours, on unscaled features), encode, search, score.

    ``key`` is a unique row key; the split, the folds and the imputation's tie rule hang on it.  ``parallelism`` trials of
    the search share their passes; with a ``restart`` folder a search that was interrupted goes on with the trees written there.
    """
    dropped = {entity, key, target, *ids, *(f"{c}{s}" for c in ids for s in ("_x", "_y"))}
    if not keep_leaking:
        dropped.add(leaking)
    columns = [c for c in data.columns if c not in dropped]
    numeric = [c for c in columns if longform.is_numeric(data, c)]
    numeric += shape.discover_metrics(data, [c for c in columns if c not in numeric], "ratio")
    df = data.withColumns({c: longform.as_number(data, c) for c in numeric})
    df = df.withColumns({c: unsentinel(shape.q(c)) for c in columns if c not in numeric})
    df = df.withColumn("target__log", F.log1p(shape.q(target)))

    train, test = valuation.train_test_split(df, key, seed)
    sparse = set(shape.mostly_null_columns(train, columns))
    numeric = [c for c in numeric if c not in sparse]
    categories = [c for c in columns if c not in sparse and c not in numeric]
    train = shape.fill_defaults(train, [], categories)
    test = shape.fill_defaults(test, [], categories)

    train_filled = neighbours.knn_impute(train, numeric, key)
    test_filled = neighbours.knn_impute(test, numeric, key, donors=train)
    preprocessor = prepare.feature_pipeline(train_filled, numeric, categories)
    ready = preprocessor.transform(train_filled).select(shape.q(key), "features", "target__log")
    search = boosting.search(
        ready, valuation.draw_trials(draws, seed, trees), "features", "target__log", key, folds, seed, folder=restart, together=parallelism
    )
    model = search.model
    scored = valuation.predict(model, preprocessor.transform(test_filled))
    names = prepare.feature_names(preprocessor, numeric, categories)
    return Valuation(
        preprocessor=preprocessor,
        model=model,
        numeric=numeric,
        categories=categories,
        scored=scored,
        scores=valuation.score_table(search, df),
        metrics=valuation.regression_metrics(scored, target, "predicted"),
        importance=valuation.gain_table(model, names, df),
        residuals=valuation.residuals(scored, entity, target),
    )

