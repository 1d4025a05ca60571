"""Composed plans over the driver-derived ledgers.

``Warehouse`` builds the LIN star schema (staging -> dims -> dedup ->
quarantine -> fact). ``Monitoring`` holds the EVT fact with its dims and the
alert table. A property that names a shared table writes it on first touch
(``store.stored``); the others are lazy plans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, rules
from ..params import FIXTURE_RULES, RuleParams
from ..sources import ledgers
from .store import stored

# The fixture's cash-intensive occupation (lower-cased market segment).
FIXTURE_CASH_INTENSIVE = ("machinery",)


@dataclass
class Warehouse:
    spark: SparkSession
    sf_dir: str
    rule_params: RuleParams = FIXTURE_RULES
    #: False: what is made of the feed stays a lazy plan, for views that nobody may read.
    written: bool = True

    @cached_property
    def lines(self) -> DataFrame:
        # Landed once (the reference loads its staging table too): the dedup,
        # the date dimension and the controls all read it, and the derivation
        # is a large shuffle join that should not run three times.
        return self._feed_table("lin_lines", lambda: ledgers.lin_lines(self.spark, self.sf_dir))

    @cached_property
    def staging(self) -> DataFrame:
        return ledgers.lin_feed(self.lines)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return ledgers.customers_feed(self.spark, self.sf_dir)

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return ledgers.accounts_feed(self.spark, self.sf_dir)

    def _stored(self, name, build, params=()):
        return stored(self.spark, self.sf_dir, name, build, params)

    def _feed_table(self, name, build, params=()):
        return self._stored(name, build, params) if self.written else build()

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._stored("lin_dim_customer",
                            lambda: clean.customer_dim(self.stg_customers, FIXTURE_CASH_INTENSIVE))

    @cached_property
    def dim_account(self) -> DataFrame:
        return self._stored("lin_dim_account", lambda: clean.account_dim(self.stg_accounts, self.dim_customer))

    @cached_property
    def dim_country(self) -> DataFrame:
        return ledgers.country_dim(self.spark, self.sf_dir)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._feed_table("lin_dim_date", lambda: clean.date_dim(self.staging))

    @cached_property
    def dim_rule(self) -> DataFrame:
        return rules.rule_dim(self.spark)

    @cached_property
    def dedup(self) -> DataFrame:
        return ledgers.lin_feed(self._feed_table("lin_first_lines", lambda: ledgers.first_lines(self.lines, "customer_id", "counterparty_country")))

    @cached_property
    def rejected(self) -> DataFrame:
        return self._feed_table("lin_rejected", lambda: clean.quarantine(self.dedup, self.dim_account))

    @cached_property
    def fact(self) -> DataFrame:
        return self._feed_table("lin_fact", lambda: clean.fact_transactions(self.dedup, self.dim_account,
                                                                            self.dim_customer, self.dim_country))

    @cached_property
    def alerts(self) -> DataFrame:
        return self._feed_table("lin_alerts", lambda: run_rules(self.fact, self.dim_country, self.rule_params),
                                (self.rule_params,))


def run_rules(fact: DataFrame, dim_country: DataFrame, p: RuleParams) -> DataFrame:
    # R001/R002/R006/R008 share one scan and one customer_key shuffle; so do R004/R005.
    return rules.all_alerts([
        rules.customer_window_rules(fact, rules.customer_window_specs(p)), rules.rule_r003(fact, p),
        rules.customer_day_rules(fact, dim_country, p), rules.rule_r007(fact, p)])


@dataclass
class Monitoring:
    """EVT ledger: conformed fact, dims, alerts."""
    spark: SparkSession
    sf_dir: str
    rule_params: RuleParams = FIXTURE_RULES

    @cached_property
    def fact(self) -> DataFrame:
        return stored(self.spark, self.sf_dir, "evt_fact", lambda: ledgers.evt_transactions(self.spark, self.sf_dir))

    @cached_property
    def dim_country(self) -> DataFrame:
        return ledgers.country_dim(self.spark, self.sf_dir)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return clean.customer_dim(ledgers.customers_feed(self.spark, self.sf_dir),
                                  FIXTURE_CASH_INTENSIVE, key="source_key")

    @cached_property
    def dim_account(self) -> DataFrame:
        return ledgers.evt_accounts(self.spark, self.sf_dir)

    @cached_property
    def dim_date(self) -> DataFrame:
        # One row per active day; written once, read by every mart.
        return stored(self.spark, self.sf_dir, "evt_dim_date", lambda: ledgers.evt_date_dim(self.spark, self.sf_dir))

    @cached_property
    def dim_rule(self) -> DataFrame:
        return rules.rule_dim(self.spark)

    @cached_property
    def alerts(self) -> DataFrame:
        return stored(self.spark, self.sf_dir, "evt_alerts",
                      lambda: run_rules(self.fact, self.dim_country, self.rule_params), (self.rule_params,))


def sup_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "sup_fact", lambda: ledgers.sup_transactions(spark, sf_dir))


def money_out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Expose exact money columns as doubles for reporting."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
