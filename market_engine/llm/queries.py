"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    exact_dedup,
    fixity,
    kd_shards,
    level_products,
    license_rules,
    mixing,
    packing,
    robust_outliers,
    runs,
    secrets,
    simhash,
    string_kernel,
    toxicity,
)
from .common import read


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.result(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.result(read(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.result(read(spark, folder, "documents"))


def op4_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kd_shards.result(read(spark, folder, "documents"))


def op5_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return robust_outliers.result(read(spark, folder, "documents"))


def op6_fixity(spark: SparkSession, folder: str) -> DataFrame:
    return fixity.result(read(spark, folder, "pages"))


def op7_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return license_rules.result(read(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.result(read(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.result(read(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.result(read(spark, folder, "documents"))


def op11_level_products(spark: SparkSession, folder: str) -> DataFrame:
    return level_products.result(read(spark, folder, "documents"))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.result(read(spark, folder, "documents"))


def op13_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    return string_kernel.result(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_packing,
        op3_secrets,
        op4_kd_shards,
        op5_robust_outliers,
        op6_fixity,
        op7_license_rules,
        op8_simhash,
        op9_exact_dedup,
        op10_mixing,
        op11_level_products,
        op12_runs,
        op13_string_kernel,
    )
}
