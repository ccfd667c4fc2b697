"""Feature views: one row per entity, built from the order tables.

Every builder aggregates the fact side by the entity key *before* joining, so
that map-side combining shrinks the shuffle and a hot entity arrives as partial
sums, not as rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.sources.tables import load

LABELLED_HORIZON = "2001-02-01"
SCORING_HORIZON = "2001-08-01"
PERIOD_MONTHS = 6
# Current period and up to three earlier ones.
SUFFIXES = ("", "_PM", "_PPM", "_PPPM")

ID = "AccountID"
LABEL = "ContractActivityLABEL"
POSITIVE = "Churned"
NEGATIVE = "Active"
CATEGORICAL = ["ServiceType", "ServiceName"]


def _back(day: dt.date, months: int) -> dt.date:
    total = day.year * 12 + day.month - 1 - months
    return dt.date(total // 12, total % 12 + 1, day.day)


def _stamp(day: dt.date) -> Column:
    return F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")


def feature_columns() -> list[str]:
    """The 27 inputs in the order of the view, without id and label."""
    names = CATEGORICAL + ["DataAllowance_MB", "VoiceAllowance_Minutes", "SMSAllowance_N_Messages"]
    for measure, periods in (
        ("DataUsage_PCT", 3),
        ("VoiceUsage_PCT", 3),
        ("SMSUsage_PCT", 3),
        ("Revenue_Month", 4),
        ("ServiceFailureRate_PCT", 3),
        ("CustomerLifetimeValue_USD", 3),
        ("Device_Lifetime", 3),
    ):
        names += [measure + suffix for suffix in SUFFIXES[:periods]]
    return names


def _order_measures(orders: DataFrame, horizon: dt.date, labelled: bool) -> DataFrame:
    """Lagged measures per account in one pass over ``orders``, without windows."""
    when = F.col("o_orderdate").cast("timestamp_ntz")
    price = F.col("o_totalprice")
    aggregates = [F.min("o_orderdate").alias("first_order")]
    for k, suffix in enumerate(SUFFIXES):
        start = _stamp(_back(horizon, PERIOD_MONTHS * (k + 1)))
        end = _stamp(_back(horizon, PERIOD_MONTHS * k))
        inside = (when >= start) & (when < end)
        aggregates.append(F.sum(F.when(inside, price)).alias(f"revenue{suffix}"))
        if k < 3:
            aggregates += [
                F.count_if(inside).alias(f"orders{suffix}"),
                F.count_if(inside & (F.col("o_orderpriority") == "1-URGENT")).alias(f"urgent{suffix}"),
                F.count_if(inside & (F.col("o_orderstatus") == "P")).alias(f"pending{suffix}"),
                F.count_if(inside & (F.col("o_orderstatus") == "F")).alias(f"failed{suffix}"),
                F.sum(F.when(when < end, price)).alias(f"lifetime{suffix}"),
            ]
    if labelled:
        aggregates.append(F.count_if(when >= _stamp(horizon)).alias("later"))
    return orders.groupBy("o_custkey").agg(*aggregates)


def churn_features(
    customer: DataFrame, nation: DataFrame, orders: DataFrame, horizon: str, labelled: bool
) -> DataFrame:
    """One row per customer; customers without orders are kept with zeros."""
    day = dt.date.fromisoformat(horizon)
    measures = _order_measures(orders, day, labelled)
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        measures, F.col("c_custkey") == F.col("o_custkey"), "left"
    )

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    def money(name: str) -> Column:
        return F.round(F.coalesce(F.col(name), F.lit(0.0)), 2)

    def failure_rate(suffix: str) -> Column:
        total = count(f"orders{suffix}")
        rate = F.when(total > 0, F.col(f"failed{suffix}") / total).otherwise(0.0)
        return F.round(rate, 6)

    def lifetime_days(k: int) -> Column:
        end = F.lit(_back(day, PERIOD_MONTHS * k))
        return F.greatest(F.coalesce(F.datediff(end, "first_order"), F.lit(0)), F.lit(0))

    columns = [
        F.col("c_custkey").alias(ID),
        F.col("c_mktsegment").alias("ServiceType"),
        F.col("n_name").alias("ServiceName"),
        F.col("c_acctbal").alias("DataAllowance_MB"),
        (F.col("c_custkey") % 7).alias("VoiceAllowance_Minutes"),
        (F.col("c_custkey") % 11).alias("SMSAllowance_N_Messages"),
    ]
    columns += [count(f"orders{s}").alias(f"DataUsage_PCT{s}") for s in SUFFIXES[:3]]
    columns += [count(f"urgent{s}").alias(f"VoiceUsage_PCT{s}") for s in SUFFIXES[:3]]
    columns += [count(f"pending{s}").alias(f"SMSUsage_PCT{s}") for s in SUFFIXES[:3]]
    columns += [money(f"revenue{s}").alias(f"Revenue_Month{s}") for s in SUFFIXES]
    columns += [failure_rate(s).alias(f"ServiceFailureRate_PCT{s}") for s in SUFFIXES[:3]]
    columns += [money(f"lifetime{s}").alias(f"CustomerLifetimeValue_USD{s}") for s in SUFFIXES[:3]]
    columns += [lifetime_days(k).alias(f"Device_Lifetime{s}") for k, s in enumerate(SUFFIXES[:3])]
    if labelled:
        columns.append(F.when(count("later") == 0, POSITIVE).otherwise(NEGATIVE).alias(LABEL))
    return rows.select(*columns)


def _order_tables(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(load(spark, directory, name) for name in ("customer", "nation", "orders"))


def churn_view(spark: SparkSession, directory: str) -> DataFrame:
    """Labelled view: did the account order again after the horizon?"""
    return churn_features(*_order_tables(spark, directory), LABELLED_HORIZON, labelled=True)


def new_customer_view(spark: SparkSession, directory: str) -> DataFrame:
    """The same columns half a year later, label not known."""
    return churn_features(*_order_tables(spark, directory), SCORING_HORIZON, labelled=False)


def with_planted_label(view: DataFrame) -> DataFrame:
    """Replace the label by a rule over the features, so that models can find it."""
    low = (F.col("Revenue_Month") + F.col("Revenue_Month_PM") < 150000) & (F.col("DataUsage_PCT_PPM") <= 1)
    return view.withColumn(LABEL, F.when(low, POSITIVE).otherwise(NEGATIVE))


def with_stepped_label(view: DataFrame) -> DataFrame:
    """Replace the label by two axis-parallel steps a single tree can express exactly."""
    rule = F.col("ServiceType").isin("BUILDING", "MACHINERY") & (F.col("DataUsage_PCT") <= 0)
    return view.withColumn(LABEL, F.when(rule, POSITIVE).otherwise(NEGATIVE))


WHOLESALE_MEASURES = {
    "FRESHPRODUCE": "SMALL",
    "MILK": "MEDIUM",
    "GROCERY": "LARGE",
    "FROZEN": "STANDARD",
    "DETERGENTS": "ECONOMY",
    "MEATDELI": "PROMO",
}


def wholesale_view(spark: SparkSession, directory: str) -> DataFrame:
    """Spend per part type and buyer, with a two-valued integer class.

    Line items collapse to one row per order before they meet ``orders``: that
    aggregation and the join use the same order-key partitioning.
    """
    lines = load(spark, directory, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    parts = load(spark, directory, "part").select("p_partkey", "p_type")
    orders = load(spark, directory, "orders").select("o_orderkey", "o_custkey")
    per_order = (
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
        .groupBy("l_orderkey")
        .agg(*[
            F.sum(F.when(F.col("p_type") == kind, F.col("l_extendedprice")).otherwise(0.0)).alias(name)
            for name, kind in WHOLESALE_MEASURES.items()
        ])
    )
    spend = (
        per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("IDCOL"))
        .agg(*[F.round(F.sum(name), 2).alias(name) for name in WHOLESALE_MEASURES])
    )
    first_class = F.col("DETERGENTS") + F.col("MEATDELI") > F.col("FRESHPRODUCE") + F.col("MILK")
    return spend.withColumn("CUSTOMERTYPE", F.when(first_class, 1).otherwise(2))


def retail_sales(spark: SparkSession, directory: str) -> DataFrame:
    """Quantity sold per part type and month number (1 = January 1995)."""
    lines = load(spark, directory, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    parts = load(spark, directory, "part").select("p_partkey", "p_type")
    month = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")
    return (
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
        .groupBy(F.col("p_type").alias("PRODUCT_ID"), month.alias("DAY"))
        .agg(F.round(F.sum("l_quantity"), 2).alias("SALES"))
    )
