"""Account reporting over order tables: an order is an account, a customer a patient."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.coding import map_values, money, rate, share_of
from tallymark.operators import gold as gold_tables
from tallymark.operators.conform import conform
from tallymark.operators.joins import collapse, join_dimension, only_of
from tallymark.sources.tables import load

PATIENT_TYPES = {"F": "Inpatient", "O": "Outpatient"}
PATIENT_TYPE_OTHERWISE = "Observation"
SURGICAL_PRIORITY = "1-URGENT"
WEIGHT_PER_UNIT = Decimal("0.00001")


def accounts(spark: SparkSession, folder: str, chosen: Column | None = None) -> DataFrame:
    """One row per order, with the columns of its own primary encounter.

    ``chosen`` is a condition on the stored ``o_orderdate``: one on the date made from it
    would not reach the scan when its bounds come from subqueries.
    """
    orders = load(spark, folder, "orders")
    if chosen is not None:
        orders = orders.where(chosen)
    charges = F.col("o_totalprice").cast("decimal(18,2)")
    inpatient = F.col("o_orderstatus") == "F"
    return conform(
        orders,
        {
            "hospital_account_id": F.col("o_orderkey"),
            "patient_id": F.col("o_custkey"),
            "primary_encounter_id": F.col("o_orderkey"),
            "discharge_department_id": F.col("o_custkey"),
            "discharge_date": F.col("o_orderdate").cast("date"),
            "patient_type": map_values("o_orderstatus", PATIENT_TYPES, PATIENT_TYPE_OTHERWISE),
            "financial_class_group": F.col("o_orderpriority"),
            "surgical_case_flag": F.col("o_orderpriority") == SURGICAL_PRIORITY,
            "ms_drg_weight": F.when(
                inpatient, F.round(charges * F.lit(WEIGHT_PER_UNIT), 2).cast("double")
            ),
            "total_charges": charges,
        },
    )


def departments(spark: SparkSession, folder: str) -> DataFrame:
    """Customer, nation and region as department, service line and facility."""
    nations = load(spark, folder, "nation").join(
        load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = load(spark, folder, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return conform(
        joined,
        {
            "department_id": F.col("c_custkey"),
            "facility": F.col("r_name"),
            "service_line": F.col("n_name"),
            "product": F.col("c_mktsegment"),
        },
    )


def financials(spark: SparkSession, folder: str, of: DataFrame | None = None) -> DataFrame:
    """Line amounts, each rounded to cents, added up to one row per order.

    With ``of``, only the lines of those accounts, cut before they are added up.
    """
    lines = load(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "hospital_account_id")
    if of is not None:
        lines = only_of(lines, of, "hospital_account_id")
    price, discount, tax = money("l_extendedprice"), rate("l_discount"), rate("l_tax")
    parts = lines.select(
        "hospital_account_id",
        share_of(price, 1 - discount).alias("net"),
        share_of(price, discount).alias("direct"),
        share_of(price, tax).alias("indirect"),
        tax.alias("tax"),
    )
    amounts = {
        "estimated_net_revenue": F.col("net"),
        "total_direct_cost": F.col("direct"),
        "total_indirect_cost": F.col("indirect"),
        "total_actual_payment": share_of(F.col("net"), 1 + F.col("tax")),
    }
    return collapse(
        parts,
        "hospital_account_id",
        *[F.sum(amount).cast("decimal(18,2)").alias(name) for name, amount in amounts.items()],
    )


def primary_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order and line number: when it was shipped first, and its quantity.

    Keyed by both columns, as an encounter is by its account's and its own id.
    """
    return collapse(
        load(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("hospital_account_id"),
            F.col("l_linenumber").cast("long").alias("encounter_id"),
            F.col("l_shipdate").cast("date").alias("shipped"),
            F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        ),
        ["hospital_account_id", "encounter_id"],
        F.min("shipped").alias("first_shipped"),
        F.sum("quantity").cast("decimal(18,2)").alias("quantity"),
    )


def located_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts with their department, for reports that need no amounts."""
    return join_dimension(
        accounts(spark, folder).withColumnRenamed("discharge_department_id", "department_id"),
        departments(spark, folder),
        "department_id",
    )


def gold(spark: SparkSession, folder: str, account_rows: DataFrame | None = None) -> DataFrame:
    """All accounts, or the given ones of them."""
    rows = accounts(spark, folder) if account_rows is None else account_rows
    return gold_tables.account(
        rows, departments(spark, folder), financials(spark, folder, account_rows)
    )
