"""All layers over one set of raw tables, composed lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from . import gold, raw, silver


class Layers:
    """Raw, clean, quarantined, dimensional and fact frames of one data folder.

    Frames are plans; nothing runs until a caller acts on one, and a query only reads the
    columns and tables it needs. Stored layers (`plans.pipeline`) have the same interface.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = raw.AS_OF) -> None:
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def raw(self, table: str) -> DataFrame:
        return getattr(raw, table)(self.spark, self.sf_dir)

    def typed(self, table: str) -> DataFrame:
        if table == "sales":
            return silver.sales(self.raw("sales"), self.as_of)
        return getattr(silver, table)(self.raw(table))

    def clean(self, table: str) -> DataFrame:
        return quality.passing(self.typed(table), silver.CHECKS[table])

    def quarantined(self, table: str) -> DataFrame:
        return quality.failing(self.typed(table), silver.CHECKS[table])

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.clean("customers"))

    @cached_property
    def dim_policy(self) -> DataFrame:
        return gold.dim_policy(self.clean("policy"))

    @cached_property
    def dim_car(self) -> DataFrame:
        return gold.dim_car(self.clean("cars"))

    @cached_property
    def fact_claims(self) -> DataFrame:
        return gold.fact_claims(self.clean("claims"), self.clean("policy"),
                                self.clean("customers"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.clean("sales"), self.clean("cars"))
