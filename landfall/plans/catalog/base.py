"""What the query modules share."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from landfall.contract import Contract, FieldRule, Policy
from landfall.functions.crypto import key_column
from landfall.functions.sql import once


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rendered(df: DataFrame, value: str, *carried: str) -> DataFrame:
    """Rows as a scan would deliver them: each text is made once, whatever is filtered later."""
    return df.selectExpr(*carried, f"{once(value)} AS value")


def feed(names: str, policy: Policy | None = None, **settings) -> Contract:
    """A contract of optional text fields, by blank-separated names."""
    fields = tuple(FieldRule(n) for n in names.split())
    return Contract(fields=fields, policy=policy or Policy(), **settings)


def money(c: str) -> str:
    """The same text of an amount in Spark and in the twin."""
    return f"cast(cast({c} as decimal(18,2)) as string)"


def day(c: str) -> str:
    return f"date_format({c}, 'yyyy-MM-dd')"


def fresh_key(spark: SparkSession) -> Column:
    return key_column(spark, random_key())


def random_key() -> str:
    return base64.b64encode(os.urandom(32)).decode()
