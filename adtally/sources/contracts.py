"""Contract feeds kept as JSON files: advertisers, customer and channel contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ADVERTISERS = "data array<struct<code:string,contractCode:string>>"
CUSTOMERS = "code string, data struct<customerContractRes:struct<currency:string>>"
CHANNELS = (
    "code string, data struct<contractList:array<struct<"
    "channelContractRes:struct<code:string,currency:string>>>>"
)


def _text(path: Column) -> Column:
    """A missing step anywhere on the path yields an empty string."""
    return F.coalesce(path, F.lit(""))


def read_advertisers(spark: SparkSession, path: str) -> DataFrame:
    """(adv_id, contract_code), one feed document per line."""
    docs = spark.read.schema(ADVERTISERS).json(path)
    return docs.select(F.explode("data").alias("d")).select(
        F.col("d.code").alias("adv_id"), F.col("d.contractCode").alias("contract_code")
    )


def read_customer_contracts(spark: SparkSession, path: str) -> DataFrame:
    """(contract_code, adv_currency)."""
    docs = spark.read.schema(CUSTOMERS).json(path)
    return docs.select(
        F.col("code").alias("contract_code"),
        _text(F.col("data.customerContractRes.currency")).alias("adv_currency"),
    )


def read_channel_contracts(spark: SparkSession, path: str) -> DataFrame:
    """(payee_code, supplier_id, payout_currency) of the first contract in the list."""
    docs = spark.read.schema(CHANNELS).json(path)
    first = F.get(F.col("data.contractList"), F.lit(0))["channelContractRes"]
    return docs.select(
        F.col("code").alias("payee_code"),
        _text(first["code"]).alias("supplier_id"),
        _text(first["currency"]).alias("payout_currency"),
    )
