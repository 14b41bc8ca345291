"""The five rollups of the star schema, kept up to date as raw batches arrive.

Each batch brings raw rows of any of the tables. Customers are reduced to their winners, so a batch
may change the region of claims that came long before; a policy or a car may arrive after the rows
that refer to it. Each rollup adds the facts of a batch's own rows; older facts that refer to what the
batch brought or changed are built as they were and as they are now, taken back and added again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as m
from ..operators import quality
from ..operators.incremental import Rollup, Runs, Winners
from . import gold, silver

TABLES = ("customers", "claims", "policy", "sales", "cars")


def _keys(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def _money(name: str, amount: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Key and sums of a money column. What no exact sum can hold is a key: it can be taken back."""
    value = F.col(amount).cast("double")
    rest = F.when(value.isNotNull() & ~(F.abs(value) < m._WHOLE), value)
    return {f"{name}_rest": rest}, {
        f"{name}_sum": F.coalesce(m.exact_sum(amount), F.lit(0).cast("decimal(38,9)")),
        f"{name}_count": F.count(value), f"{name}_whole": F.count(value) - F.count(rest)}


def _total(name: str) -> tuple[Column, Column, Column]:
    """Exact sum, rest and count of a money column from the states of one group."""
    exact = F.when(F.sum(f"{name}_whole") > 0, F.sum(f"{name}_sum"))
    rest = F.sum(F.col(f"{name}_rest") * F.col(f"{name}_count"))
    return exact.cast("decimal(38,9)"), rest, F.sum(f"{name}_count")


def _money_sum(name: str) -> Column:
    exact, rest, _ = _total(name)
    return m.money_total(exact, rest)


def _money_mean(name: str) -> Column:
    exact, rest, count = _total(name)
    return m.money_ratio(exact, rest, count)


def _whole(name: str) -> dict[str, Column]:
    return {f"{name}_sum": F.coalesce(F.sum(F.col(name).cast("decimal(18,0)")), F.lit(0)),
            f"{name}_count": F.count(name)}


def _mean(name: str, digits: int = 2) -> Column:
    return F.round(F.sum(f"{name}_sum").cast("double")
                   / F.nullif(F.sum(f"{name}_count"), F.lit(0)), digits)


def _flagged(condition: Column) -> Column:
    return F.count_if(condition)


def _rejected() -> dict[str, Column]:
    return {"rejected": F.coalesce(F.sum("is_rejected"), F.lit(0).cast("bigint"))}


def _rejection() -> Rollup:
    rest, claimed = _money("claimed", "total_claim_amount")
    keys = _keys("policy_csl", "policy_csl_tier", "region")
    return Rollup({**keys, **rest}, {**_rejected(), **claimed}, lambda parts: parts.groupBy(*keys).agg(
        F.sum("n").alias("total_claims"), F.sum("rejected").alias("rejected_claims"),
        m.percent(F.sum("rejected"), F.sum("n")).alias("rejection_rate_pct"),
        _money_mean("claimed").alias("avg_claim_amount"),
        _money_sum("claimed").alias("total_claim_amount")))


def _severity() -> Rollup:
    rest, claimed = _money("claimed", "total_claim_amount")
    keys = _keys("incident_severity")
    sums = {**_rejected(), **claimed, **_whole("bodily_injuries"),
            **_whole("number_of_vehicles_involved")}
    return Rollup({**keys, **rest}, sums, lambda parts: parts.groupBy(*keys).agg(
        F.sum("n").alias("total_claims"), F.sum("rejected").alias("rejected_claims"),
        m.percent(F.sum("rejected"), F.sum("n")).alias("rejection_rate_pct"),
        _money_sum("claimed").alias("total_claim_amount"),
        _money_mean("claimed").alias("avg_claim_amount"),
        _mean("bodily_injuries").alias("avg_bodily_injuries"),
        _mean("number_of_vehicles_involved").alias("avg_vehicles_involved")))


def _customers() -> Rollup:
    owners = {"customers_with_default": "default_flag",
              "customers_with_hh_insurance": "hh_insurance",
              "customers_with_car_loan": "car_loan"}
    sums = {**_whole("balance"), **{n: _flagged(F.col(flag) == 1) for n, flag in owners.items()}}
    return Rollup(_keys("region", "state"), sums, lambda parts: parts.groupBy("region").agg(
        F.sum("n").alias("customer_count"), F.count("state").alias("states_covered"),
        _mean("balance").alias("avg_balance"), *[F.sum(n).alias(n) for n in owners]))


def _unsold() -> Rollup:
    keys, age = _keys("car_model", "region"), F.col("days_unsold")
    risk_rest, risk = _money("risk", "revenue_at_risk")
    price_rest, price = _money("price", "original_selling_price")
    days = F.when(age.isNotNull(), F.col("n"))
    return Rollup(
        {**keys, "days_unsold": age, **risk_rest, **price_rest}, {**risk, **price},
        lambda parts: parts.groupBy(*keys).agg(
            F.sum("n").alias("unsold_count"), F.max(age).alias("max_days_unsold"),
            F.round(F.sum(age * F.col("n")).cast("double") / F.sum(days), 1).alias("avg_days_unsold"),
            F.min(age).alias("min_days_unsold"),
            _money_sum("risk").alias("total_revenue_at_risk"),
            _money_mean("price").alias("avg_listing_price"),
            *[F.coalesce(F.sum(F.when(age > limit, F.col("n"))), F.lit(0))
              .alias(f"unsold_over_{limit}_days") for limit in (60, 90)]))


def _premiums() -> Rollup:
    """Policies and claims by policy number, both in one state: claims have no tier of their own."""
    premium_rest, premium = _money("premium", "policy_annual_premium")
    claimed_rest, claimed = _money("claimed", "total_claim_amount")
    sums = {**premium, **_whole("policy_deductable"), **_whole("umbrella_limit"),
            **_rejected(), **claimed}

    def finish(parts: DataFrame) -> DataFrame:
        policies = parts.where("is_policy")
        claims = parts.where("NOT is_policy").groupBy("number").agg(
            F.sum("n").alias("filed"), F.sum("rejected").alias("turned_down"),
            *[c.alias(f"claims_{x}") for x, c in zip(("sum", "rest"), _total("claimed"), strict=False)])
        # A claim counts once for each pair of policy rows with its number, as in the full rollup.
        copies = policies.groupBy("number").agg(F.sum("n").alias("copies"))
        exposed = policies.groupBy("number", "policy_csl", "policy_csl_tier").agg(
            F.sum("n").alias("rows")).join(copies, "number").join(claims, "number") \
            .withColumn("times", F.col("rows") * F.col("copies"))
        times = F.col("times")
        per_tier = exposed.groupBy("policy_csl", "policy_csl_tier").agg(
            F.sum(F.col("filed") * times).alias("filed"),
            F.sum(F.col("turned_down") * times).alias("turned_down"),
            F.sum((F.col("claims_sum") * times.cast("decimal(19,0)")).cast("decimal(38,9)"))
            .alias("claims_sum"),
            F.sum(F.col("claims_rest") * times).alias("claims_rest"))
        tiers = policies.groupBy("policy_csl", "policy_csl_tier").agg(
            F.sum("n").alias("policy_count"), _money_mean("premium").alias("avg_annual_premium"),
            _money_sum("premium").alias("total_premium_revenue"),
            _mean("policy_deductable").alias("avg_deductable"),
            _mean("umbrella_limit").alias("avg_umbrella_limit"))
        same = (tiers["policy_csl"].eqNullSafe(per_tier["policy_csl"])
                & tiers["policy_csl_tier"].eqNullSafe(per_tier["policy_csl_tier"]))
        filed = F.coalesce("filed", F.lit(0))
        return tiers.join(per_tier, same, "left").select(
            *[tiers[c] for c in tiers.columns], filed.alias("total_claims_filed"),
            m.percent(F.coalesce("turned_down", F.lit(0)), F.greatest(filed, F.lit(1)))
            .alias("overall_rejection_rate_pct"),
            F.coalesce(m.money_total(F.col("claims_sum"), F.col("claims_rest")), F.lit(0.0))
            .alias("total_claims_exposure"))

    return Rollup({**_keys("number", "is_policy", "policy_csl", "policy_csl_tier"), **premium_rest,
                   **claimed_rest}, sums, finish)


ROLLUPS = {"rejection_by_tier_region": _rejection, "severity": _severity,
           "customers_by_region": _customers, "unsold_aging": _unsold, "premium_by_tier": _premiums}


def _policies_and_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Both as rows of one shape, by policy number."""
    return gold.dim_policy(policies).select(
        F.col("policy_number").alias("number"), F.lit(True).alias("is_policy"), "policy_csl",
        "policy_csl_tier", "policy_annual_premium", "policy_deductable", "umbrella_limit"
    ).unionByName(gold.claim_measures(claims).withColumnRenamed("policy_id", "number")
                  .withColumn("is_policy", F.lit(False)), allowMissingColumns=True)


class IncrementalGold:
    """Stored state of the clean tables and of the rollups, below one folder."""

    def __init__(self, spark: SparkSession, folder: str, as_of: str | None = None,
                 rollups: tuple[str, ...] = tuple(ROLLUPS)):
        self.spark, self.as_of = spark, as_of
        self.rollups = {name: ROLLUPS[name]() for name in rollups}
        self.state = {name: Runs(spark, f"{folder}/rollups/{name}") for name in rollups}
        self.tables = {t: Runs(spark, f"{folder}/tables/{t}") for t in TABLES}
        self.customers = Winners(self.tables["customers"], "customer_id", silver.customer_order)

    def _clean(self, without: int | None) -> dict[str, DataFrame]:
        """The clean tables with all batches, or as they were without one."""
        rows = {t: self.customers.current(without) if t == "customers" else runs.read(without)
                for t, runs in self.tables.items()}
        return {t: quality.passing(df, silver.CHECKS[t]) for t, df in rows.items() if df is not None}

    def update(self, batch: int, raw: dict[str, DataFrame]) -> None:
        """Take in raw rows of all tables; a table without new rows brings an empty frame.

        The batch that came last may be repeated, as a stream does after a failure, and replaces
        itself. An earlier one is in effect already and is left out.
        """
        if all(runs.settled(batch) for runs in self.state.values()):
            return
        for table in TABLES:
            if table == "customers":
                self.customers.update(batch, silver.harmonized_customers(raw[table]))
                continue
            typed = (silver.sales(raw[table], self.as_of) if table == "sales"
                     else getattr(silver, table)(raw[table]))
            self.tables[table].put(batch, quality.passing(typed, silver.CHECKS[table]))
        new, before, after = self._arrived(batch), self._clean(batch), self._clean(None)
        for name, rollup in self.rollups.items():
            added, removed = self._change(name, new, before, after)
            self.state[name].put(batch, rollup.partial(added, removed))

    def _arrived(self, batch: int) -> dict[str, DataFrame]:
        """The rows one batch brought; of customers, its own winners before any rule."""
        return {t: runs.run(batch) for t, runs in self.tables.items()}

    def _change(self, name: str, new: dict, before: dict, after: dict
                ) -> tuple[DataFrame, DataFrame | None]:
        """Rows that a rollup's input gains by the batch and those that it loses.

        A fact depends on its own row and on what that row refers to. So the new rows are gained, and
        an old one is taken back, and gained in its new form, only if something it refers to came
        or changed.
        """
        if name == "customers_by_region":
            ids = new["customers"].select("customer_id").distinct()
            return tuple(tables["customers"].join(ids, "customer_id", "left_semi")
                         for tables in (after, before))
        if name == "premium_by_tier":
            return _policies_and_claims(new["claims"], new["policy"]), None
        if name == "unsold_aging":
            cars = new["cars"].select("car_id").distinct()
            old = before["sales"].join(cars, "car_id", "left_semi")
            return self._around(new["sales"], old, lambda sales, tables: gold.fact_sales(
                sales, tables["cars"]).where("is_sold = 0"), before, after)
        number = new["policy"].select(F.col("policy_number").alias("policy_id"))
        if name == "rejection_by_tier_region":
            number = number.unionByName(self._rehoused(new, before, after))
        old = before["claims"].join(number.distinct(), "policy_id", "left_semi")
        return self._around(new["claims"], old, lambda claims, tables: gold.fact_claims(
            claims, tables["policy"], tables["customers"]), before, after)

    @staticmethod
    def _around(new: DataFrame, old: DataFrame, facts: Callable[[DataFrame, dict], DataFrame],
                before: dict, after: dict) -> tuple[DataFrame, DataFrame]:
        return facts(new.unionByName(old), after), facts(old, before)

    @staticmethod
    def _rehoused(new: dict, before: dict, after: dict) -> DataFrame:
        """Policies whose holder has another region or state than before the batch, or had none."""
        ids = new["customers"].select("customer_id").distinct()
        homes = [tables["customers"].join(ids, "customer_id", "left_semi").select(
            "customer_id", F.struct("region", "state").alias(when))
            for tables, when in ((before, "was"), (after, "is"))]
        moved = homes[0].join(homes[1], "customer_id", "full").where(
            ~F.col("was").eqNullSafe(F.col("is"))).select("customer_id")
        return after["policy"].join(moved, "customer_id", "left_semi").select(
            F.col("policy_number").alias("policy_id"))

    def result(self, name: str) -> DataFrame:
        return self.rollups[name].result(self.state[name])

    def compact(self) -> None:
        """Merge the runs of all tables and rollups."""
        for table, runs in self.tables.items():
            self.customers.compact() if table == "customers" else runs.compact(lambda df: df)
        for name, rollup in self.rollups.items():
            self.state[name].compact(rollup.merged)
