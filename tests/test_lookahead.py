"""Point-in-time checks on alerts (O-116 applied to the rules, trap T-3) and
agreement of the fused rule plans with the one-rule plans."""

import pytest
from conftest import SF_SMALL
from helpers import fact
from pyspark.sql import functions as F

from ledgerhound.operators import rules
from ledgerhound.params import FIXTURE_RULES, RuleParams
from ledgerhound.plans.warehouse import Monitoring, Warehouse, run_rules


def _with_future_day(f):
    """Copy every customer's last-day transactions to the following day."""
    last = f.groupBy("customer_key").agg(F.max("date_key").alias("_last"))
    future = (f.join(last, "customer_key").filter(F.col("date_key") == F.col("_last"))
              .withColumn("date_key", F.col("date_key") + 1)
              .withColumn("txn_id", F.concat(F.col("txn_id"), F.lit("-future")))
              .select(*f.columns))
    return f.unionByName(future), last


@pytest.mark.parametrize("ledger", ["LIN", "EVT"])
def test_backward_rules_ignore_future_rows(spark, ledger):
    w = Warehouse(spark, SF_SMALL) if ledger == "LIN" else Monitoring(spark, SF_SMALL)
    bumped, last = _with_future_day(w.fact)
    # R003 (outflow in the 72 h after a credit) and R007 (volume over the 6 days
    # after reactivation) look forward from their alert date by definition.
    keep = ~F.col("rule_id").isin("R003", "R007")
    base = run_rules(w.fact, w.dim_country, FIXTURE_RULES).filter(keep)
    new = (run_rules(bumped, w.dim_country, FIXTURE_RULES).filter(keep)
           .join(last, "customer_key").filter(F.col("date_key") <= F.col("_last")).select(*base.columns))
    assert base.count() > 0
    assert base.exceptAll(new).count() == 0
    assert new.exceptAll(base).count() == 0


def test_r007_looks_ahead_like_the_reference(spark):
    """T-3: R007's volume runs over the alert day and the 6 days after it, so a
    later transaction can create an alert dated before it."""
    p = RuleParams()
    before = [(0, 9, 10, "credit", "cash"), (70, 9, 20000, "credit", "cash")]
    assert rules.rule_r007(fact(spark, before), p).count() == 0
    after = before + [(74, 9, 6000, "credit", "cash")]
    r = rules.rule_r007(fact(spark, after), p).collect()
    assert [(x["date_key"], x["detail"]) for x in r] == [(70, "reactivated after 70 dormant days")]


def test_r003_dates_the_alert_at_the_credit(spark):
    """R003's outflow comes after the credit, but the alert carries the credit's
    date: a debit two days later changes an alert dated before it."""
    p = RuleParams()
    credit = [(10, 9, 20000, "credit", "wire")]
    assert rules.rule_r003(fact(spark, credit), p).count() == 0
    r = rules.rule_r003(fact(spark, credit + [(12, 9, 17000, "debit", "wire")]), p).collect()
    assert [x["date_key"] for x in r] == [10]


@pytest.mark.parametrize("ledger", ["LIN", "EVT"])
def test_fused_rule_plans_equal_single_rule_plans(spark, ledger):
    w = Warehouse(spark, SF_SMALL) if ledger == "LIN" else Monitoring(spark, SF_SMALL)
    p, f = FIXTURE_RULES, w.fact
    fused = rules.all_alerts([rules.customer_window_rules(f, rules.customer_window_specs(p)),
                              rules.customer_day_rules(f, w.dim_country, p)])
    single = rules.all_alerts([rules.rule_r001(f, p), rules.rule_r002(f, p), rules.rule_r006(f, p),
                               rules.rule_r008(f, p), rules.rule_r004(f, w.dim_country, p), rules.rule_r005(f, p)])
    assert fused.count() == single.count() > 0
    assert fused.exceptAll(single).count() == 0
    assert single.exceptAll(fused).count() == 0
