"""Command line for ``spark-submit``: ``python -m ledgermill <command> ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ledgermill.operators.cascade import BANK_REFERENCES
from ledgermill.operators.integrity import integrity_report
from ledgermill.operators.profiling import amount_statistics, column_nulls
from ledgermill.plans import gold, integrate, jobs, marts
from ledgermill.schemas import CORRUPT
from ledgermill.session import build_session
from ledgermill.sources import files, kafka

REPORTS = ["executive", "branches", "loan-risk", "alerts", "trend"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgermill")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    command("bronze", "raw_path", "out_path")
    sub = command("integrate", "raw_path", "out_path")
    sub.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    sub.add_argument("--limit", type=int, help="only a sample of so many rows")
    sub.add_argument("--seed", type=int, default=0)
    sub = command("silver", "entity_path", "base_path")
    sub.add_argument("--references", action="store_true", help="reject rows whose parent is missing or rejected")
    sub = command("gold", "base_path")
    sub.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    command("integrity", "entity_path")
    command("profile", "raw_path")
    sub = command("report", "base_path")
    sub.add_argument("name", choices=REPORTS)
    sub = command("stream", "servers", "out_path", "checkpoint")
    sub.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    return top


def report(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """One report over the written Silver and Gold tables."""

    def silver(table: str) -> DataFrame:
        return spark.read.parquet(f"{base_path}/silver/{table}")

    def mart(table: str) -> DataFrame:
        return spark.read.parquet(f"{base_path}/gold/{table}")

    if name == "executive":
        return marts.executive_summary(
            mart("branch_performance"), silver("customers"), mart("loan_portfolio")
        )
    if name == "loan-risk":
        return marts.loan_risk_distribution(silver("loans"))
    if name == "trend":
        return marts.monthly_trend(
            marts.monthly_revenue(silver("revenue")), marts.monthly_costs(silver("costs"))
        ).orderBy("month")
    details = marts.branch_with_details(
        gold.branch_performance_view(mart("branch_performance")), silver("branches")
    )
    if name == "branches":
        return marts.top_branches(details, 5)
    return marts.alerts(
        details,
        mart("customer_profitability"),
        gold.loan_portfolio_view(mart("loan_portfolio")),
        silver("branches"),
    )


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    now = datetime.now()
    if args.command == "bronze":
        jobs.raw_to_bronze(spark, args.raw_path, args.out_path)
    elif args.command == "integrate":
        result = jobs.integrate_raw(
            spark, args.raw_path, args.out_path, args.as_of, args.limit, args.seed
        )
        for frame in (result.gaps, result.statistics, result.counts):
            frame.show(truncate=False)
        print("malformed lines:", result.malformed.count())
    elif args.command == "silver":
        references = BANK_REFERENCES if args.references else ()
        outcomes = jobs.bronze_to_silver(spark, args.entity_path, args.base_path, now, references)
        for outcome in outcomes.values():
            print(outcome)
    elif args.command == "gold":
        result = jobs.silver_to_gold(spark, args.base_path, args.as_of, now)
        jobs.written_rows(spark, result).show(truncate=False)
        if result.scoring_error:
            print("scoring failed:", result.scoring_error)
    elif args.command == "integrity":
        tables = files.read_entities(spark, args.entity_path).items()
        report_rows = integrity_report({name: df.drop(CORRUPT) for name, df in tables})
        report_rows.show(50, truncate=False)
    elif args.command == "profile":
        raw = files.raw_lines(files.read_raw(spark, args.raw_path)).drop(*files.FILE_ORDER)
        column_nulls(raw).show(truncate=False)
        amounts = raw.withColumnRenamed(integrate.AMOUNT, "amount")
        amount_statistics(amounts, "amount", "CustomerID").show(truncate=False)
    elif args.command == "report":
        report(spark, args.base_path, args.name).show(100, truncate=False)
    else:
        jobs.branch_volume_stream(
            spark, args.servers, args.topic, args.out_path, args.checkpoint
        ).awaitTermination()


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"ledgermill-{args.command}")
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
