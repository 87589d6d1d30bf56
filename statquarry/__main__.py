"""Run a job from saved pages or tables to written tables: ``python -m statquarry JOB … --out FOLDER``.

Start it with ``spark-submit`` on a cluster; every path may be any location Spark can reach.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statquarry.functions.parsing import DEFAULT_NA_TOKENS
from statquarry.operators.valuation import DRAWS, TREES
from statquarry.plans import jobs, league
from statquarry.sources.tables import read_table, write_report, write_table


def _pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, html`` from parquet."""
    return spark.read.parquet(path)


def collect(spark: SparkSession, args: argparse.Namespace) -> None:
    write_table(jobs.collect_wide(_pages(spark, args.pages), args.edition), f"{args.out}/results")


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    exclude = league.IDENTITY_COLUMNS if args.edition == "later" else league.EARLIER_STATS_EXCLUDE
    wide = read_table(spark, args.wide, with_row_no=True, encoding_fallback=True)
    found = jobs.profile(wide, "row_no", exclude=exclude, approx=args.approx)
    write_report(found.report, f"{args.out}/top_3")
    table = found.wide.orderBy(F.desc("is_all"), "grp").drop("is_all").withColumnRenamed("grp", league.GROUP)
    write_table(table, f"{args.out}/results2", decimals=3)
    for name, part in (("leaders", found.leaders), ("leader_counts", found.counts), ("top_group", found.top),
                       ("key_metrics", found.key_report)):
        write_table(part, f"{args.out}/{name}")
    metrics = league.HISTOGRAM_METRICS if args.edition == "later" else league.EARLIER_HISTOGRAM_METRICS
    for name, part in jobs.chart_tables(found.long.where(F.col("metric").isin(metrics))).items():
        part.write.mode("overwrite").partitionBy("metric").parquet(f"{args.out}/charts/{name}")


def cluster(spark: SparkSession, args: argparse.Namespace) -> None:
    wide = read_table(spark, args.wide, na_tokens=DEFAULT_NA_TOKENS)
    sweep, starts = (range(3, 16), 1) if args.edition == "later" else (range(1, 11), 10)
    found = jobs.cluster_entities(wide, args.k, rule=args.rule, k_range=tuple(sweep), sweep_starts=starts)
    write_table(found.elbow, f"{args.out}/elbow")
    write_table(found.assigned, f"{args.out}/results_clustered")
    write_table(found.points, f"{args.out}/pca_clusters")


def values(spark: SparkSession, args: argparse.Namespace) -> None:
    wide = read_table(spark, args.wide)
    if args.edition == "earlier":
        listed = jobs.listed_values(_pages(spark, args.listings))
        write_table(listed, f"{args.out}/scraped_all_data")
        write_table(jobs.estimation_table(listed, wide), f"{args.out}/estimation_data")
        return
    valued = jobs.valued_players(_pages(spark, args.listings), _pages(spark, args.details))
    write_table(valued, f"{args.out}/all_players")
    write_table(jobs.valued_eligible(valued, wide), f"{args.out}/players_over_limit")


def valuation(spark: SparkSession, args: argparse.Namespace) -> None:
    wide, valued = (read_table(spark, path, with_row_no=True) for path in (args.wide, args.values))
    data = jobs.training_table(wide, valued)
    # unique per joined row, also where names repeat on both sides
    data = data.withColumn("row_key", F.to_json(F.struct("row_no_x", "row_no_y"))).drop("row_no_x", "row_no_y")
    found = jobs.value_entities(data, "row_key", draws=args.draws, trees=tuple(args.trees))
    found.save(f"{args.out}/model")
    for name, part in (("metrics", found.metrics), ("importance", found.importance), ("residuals", found.residuals)):
        write_table(part, f"{args.out}/{name}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="statquarry", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    inputs = {
        collect: ["pages"], profile: ["wide"], cluster: ["wide"], values: ["listings", "wide"], valuation: ["wide", "values"],
    }
    for job, names in inputs.items():
        command = commands.add_parser(job.__name__)
        command.set_defaults(run=job)
        for name in names:
            command.add_argument(f"--{name}", required=True)
        command.add_argument("--out", required=True)
        command.add_argument("--edition", choices=["later", "earlier"], default="later")
        if job is profile:
            command.add_argument("--approx", action="store_true", help="sketched medians, one pass")
        if job is cluster:
            command.add_argument("--k", type=int, required=True)
            command.add_argument("--rule", choices=["strict_raw", "any"], default="strict_raw")
        if job is values:
            command.add_argument("--details", help="detail pages, later edition")
        if job is valuation:
            command.add_argument("--draws", type=int, default=DRAWS)
            command.add_argument("--trees", type=int, nargs=2, default=TREES, metavar=("LEAST", "MOST"))
    args = parser.parse_args(argv)
    args.run(spark or SparkSession.builder.appName("statquarry").getOrCreate(), args)


if __name__ == "__main__":
    main()
