"""The jobs: raw to entities, entities to Silver, Silver to Gold, stream.

Every job takes its folders and its run time as arguments, writes its tables
and returns what it did. The only actions are the writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.functions import dates
from ledgermill.operators.cascade import Reference, cascade
from ledgermill.operators.integrity import layer_counts
from ledgermill.operators.profiling import amount_statistics, columns_with_gaps
from ledgermill.operators.quality import GATES, Gate, GateOutcome, write_gated
from ledgermill.operators.sampling import contiguous_sample
from ledgermill.plans import gold, integrate, risk, silver
from ledgermill.schemas import CORRUPT, ENTITIES
from ledgermill.sources import files, kafka
from ledgermill.sources.paths import stored
from ledgermill.sources.resolve import Resolved, resolve_table
from ledgermill.sources.sinks import (
    SinkOutcome,
    overwrite_csv,
    overwrite_parquet,
    row_counts,
    write_first,
)
from ledgermill.sources.warehouse import Warehouse, read_table, write_table
from ledgermill.streaming import decode, ledger, sinks, volume


@dataclass
class IntegrateResult:
    gaps: DataFrame
    statistics: DataFrame
    counts: DataFrame
    malformed: DataFrame


def integrate_raw(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    as_of: date,
    limit: int | None = None,
    seed: int = 0,
) -> IntegrateResult:
    """Clean the raw file and write the ledger and the customer dimension.

    Lines that do not fit the file's columns go to ``out_path/quarantine/raw``
    with their text; with a limit, those among the sampled lines.

    The cleaned rows feed both tables and the report, so they are written once
    to ``out_path/cleaned`` and read back.
    """
    raw = files.read_raw(spark, raw_path)
    if limit is not None:
        raw = contiguous_sample(files.with_ordinal(raw), "ordinal", limit, seed, raw.count())
    malformed_path = f"{out_path}/quarantine/raw"
    overwrite_parquet(files.malformed_lines(raw), malformed_path)
    cleaned_path = f"{out_path}/cleaned"
    lines = files.raw_lines(raw)
    overwrite_parquet(integrate.clean_raw(lines, as_of, keep=files.FILE_ORDER), cleaned_path)
    cleaned = spark.read.parquet(cleaned_path)
    overwrite_csv(integrate.transaction_ledger(cleaned), f"{out_path}/transactions.csv")
    overwrite_csv(
        integrate.customer_dimension(cleaned, files.FILE_ORDER), f"{out_path}/customers.csv"
    )
    written = {
        name: files.read_entity(spark, out_path, name) for name in ("transactions", "customers")
    }
    return IntegrateResult(
        gaps=columns_with_gaps(cleaned.drop(*files.FILE_ORDER)),
        statistics=amount_statistics(cleaned, "account_balance", "customer_id"),
        counts=layer_counts(written),
        malformed=spark.read.parquet(malformed_path),
    )


def raw_to_bronze(spark: SparkSession, raw_path: str, out_path: str) -> None:
    """Keep the raw file as Parquet by year and month, its text untouched.

    Rows without a readable date share one partition.
    """
    day = dates.parse_dmy("TransactionDate")
    raw = (
        files.read_raw(spark, raw_path)
        .withColumn("transaction_date", day)
        .withColumns({"year": F.year("transaction_date"), "month": F.month("transaction_date")})
        .withColumnRenamed(integrate.AMOUNT, "TransactionAmount")
    )
    overwrite_parquet(raw, out_path, ["year", "month"])


def bronze_to_silver(
    spark: SparkSession,
    entity_path: str,
    out_path: str,
    run_ts: datetime,
    references: Sequence[Reference] = (),
) -> dict[str, GateOutcome]:
    """Type, band and gate every entity; facts are partitioned by month.

    A line that does not fit its schema is quarantined with its text, also for
    the entities that have no rules of their own, and so is a transaction whose
    day cannot be read. With ``references`` (``BANK_REFERENCES`` for all keys of
    the bank) a row whose parent is missing or rejected is rejected too.
    """
    tables: dict[str, DataFrame] = {}
    gates: dict[str, Gate] = {}
    for entity in ENTITIES:
        df = silver.to_silver(entity, files.read_entity(spark, entity_path, entity), run_ts)
        if entity in silver.FACT_DAY:
            df = silver.with_month(df, silver.FACT_DAY[entity])
        gate = GATES.get(entity, Gate(entity, []))
        if entity == "transactions":
            gate = gate.with_rule("day is unreadable", "transaction_date IS NOT NULL")
        tables[entity] = df
        gates[entity] = gate.with_rule("line is malformed", f"{CORRUPT} IS NULL")
    return {
        entity: write_gated(
            checked.df,
            checked.gate,
            f"{out_path}/silver/{entity}",
            f"{out_path}/quarantine/{entity}",
            run_ts,
            ["month"] if entity in silver.FACT_DAY else [],
            rejected_only=[CORRUPT],
            helpers=checked.helpers,
        )
        for entity, checked in cascade(tables, gates, references).items()
    }


@dataclass
class GoldResult:
    tables: dict[str, str] = field(default_factory=dict)
    warehouse: dict[str, SinkOutcome] = field(default_factory=dict)
    scoring_error: str | None = None


def silver_to_gold(
    spark: SparkSession,
    base_path: str,
    as_of: date,
    run_ts: datetime,
    warehouse: Warehouse | None = None,
    with_scores: bool = True,
) -> GoldResult:
    """Write the Gold marts, then load the warehouse from the written files.

    A scoring failure does not stop the batch; it is part of the result.
    """
    silver_path = f"{base_path}/silver"
    table = {name: spark.read.parquet(f"{silver_path}/{name}") for name in ENTITIES}
    marts = {
        "customer_profitability": gold.customer_profitability(
            table["customers"], table["revenue"], table["transactions"], as_of
        ),
        "branch_performance": gold.branch_performance(
            table["revenue"], table["costs"], table["transactions"], as_of
        ),
        "loan_portfolio": gold.loan_portfolio(table["loans"], as_of),
    }
    result = GoldResult()
    for name, mart in marts.items():
        _publish(spark, mart, name, base_path, warehouse, result)
    if with_scores:
        try:
            _publish(
                spark,
                score_loans(spark, base_path, run_ts),
                "loan_risk_analytics",
                base_path,
                warehouse,
                result,
            )
        except Exception as error:
            # The kind of error and what caused it, not the trace behind it.
            cause = f" (cause: {error.__cause__!r})" if error.__cause__ else ""
            result.scoring_error = f"{type(error).__name__}: {str(error).splitlines()[0]}{cause}"
    return result


def score_loans(spark: SparkSession, base_path: str, run_ts: datetime) -> DataFrame:
    """Scores of the Silver loans; missing Silver tables are an error."""
    loans = spark.read.parquet(f"{base_path}/silver/loans")
    customers = spark.read.parquet(f"{base_path}/silver/customers")
    features = stored(risk.loan_features(loans, customers), "loan-features")
    return risk.score(risk.fit(features), features, run_ts)


def _publish(
    spark: SparkSession,
    mart: DataFrame,
    name: str,
    base_path: str,
    warehouse: Warehouse | None,
    result: GoldResult,
) -> None:
    path = f"{base_path}/gold/{name}"
    overwrite_parquet(mart, path)
    result.tables[name] = path
    if warehouse is not None:
        written = spark.read.parquet(path)
        result.warehouse[name] = write_first(
            written,
            name,
            [
                ("warehouse", lambda df: write_table(df, warehouse, name)),
                ("lake", lambda df: None),  # already written above
            ],
        )


def written_rows(spark: SparkSession, result: GoldResult) -> DataFrame:
    return row_counts(spark, result.tables)


MART_VIEWS = {
    "branch_performance": gold.branch_performance_view,
    "customer_profitability": gold.customer_profitability_view,
    "loan_portfolio": gold.loan_portfolio_view,
}


def _from_entities(spark: SparkSession, entity_path: str, mart: str) -> DataFrame:
    """What the entity CSVs alone can say in place of a mart."""

    def entity(name: str) -> DataFrame:
        return files.read_entity(spark, entity_path, name).drop(CORRUPT)

    if mart == "branch_performance":
        return gold.branch_ratio_from_entities(
            entity("branches"), entity("revenue"), entity("costs")
        )
    return entity("customers" if mart == "customer_profitability" else "loans")


def resolve_mart(
    spark: SparkSession,
    mart: str,
    base_path: str,
    entity_path: str,
    warehouse: Warehouse | None = None,
) -> Resolved:
    """A mart from the warehouse view, the Gold files or the entity CSVs."""
    sources = []
    if warehouse is not None:
        sources.append(("warehouse", lambda: read_table(spark, warehouse, f"vw_{mart}")))
    sources.append(
        ("gold", lambda: MART_VIEWS[mart](spark.read.parquet(f"{base_path}/gold/{mart}")))
    )
    sources.append(("entities", lambda: _from_entities(spark, entity_path, mart)))
    return resolve_table(mart, sources)


def register_views(spark: SparkSession, base_path: str) -> list[str]:
    """Name the warehouse views over the Gold files for ``spark.sql``."""

    def mart(name: str) -> DataFrame:
        return spark.read.parquet(f"{base_path}/gold/{name}")

    views = {f"vw_{name}": view(mart(name)) for name, view in MART_VIEWS.items()}
    views["vw_summary_kpis"] = gold.summary_kpis(
        mart("customer_profitability"), mart("loan_portfolio")
    )
    views["vw_loan_risk_analytics"] = gold.loan_risk_view(mart("loan_risk_analytics"))
    views["vw_realtime_branch_tps"] = gold.branch_throughput(mart("branch_performance"))
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return sorted(views)


def branch_volume_stream(
    spark: SparkSession, servers: str, topic: str, out_path: str, checkpoint: str
) -> StreamingQuery:
    """Start the windowed volume from the event topic into the lake, read by ``ledger.windows``.

    Events that cannot be routed are kept beside it, by a query of their own.
    """
    events = decode.decode(kafka.read_topic(spark, servers, topic))
    sinks.keep_events(decode.quarantined_events(events), f"{out_path}-quarantine", f"{checkpoint}-quarantine")
    cards = decode.typed_events(events, decode.CARD)
    return ledger.to_ledger(volume.stream_volume(cards), out_path, checkpoint)
