"""Portable bootstrap draws, rule overlap with many rules, feeds with lines that don't parse."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from ledgerhound.operators import clean
from ledgerhound.operators import evaluate as ev
from ledgerhound.operators.rule_analytics import rule_overlap
from ledgerhound.params import EvalParams
from ledgerhound.sources import feeds, sinks


@pytest.mark.parametrize("n, p", [(1, 0.5), (7, 0.01), (40, 0.3), (500, 0.999), (3000, 0.02)])
def test_binomial_quantiles(n, p):
    pmf = [math.comb(n, k) * p ** k * (1 - p) ** (n - k) if n < 900 else math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                                                                                  + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(n + 1)]
    below = np.cumsum(pmf)
    for u in [1e-9, 0.001, 0.1234, 0.5, 0.77, 0.999, 1 - 1e-9]:
        assert ev.binomial_quantile(n, p, u) == min(int(np.searchsorted(below, u)), n)
    assert (ev.binomial_quantile(n, 0.0, 0.5), ev.binomial_quantile(n, 1.0, 0.5), ev.binomial_quantile(0, p, 0.5)) == (0, n, 0)


def test_large_binomials_have_their_mean_and_spread():
    n, p = 10 ** 9, 0.25
    draws = [ev.binomial_quantile(n, p, ev.uniform(1, k, 0)) for k in range(200)]
    sd = math.sqrt(n * p * (1 - p))
    assert abs(np.mean(draws) - n * p) < 4 * sd / math.sqrt(200) and 0.8 < np.std(draws) / sd < 1.2


def test_bootstrap_is_the_same_every_time_and_brackets_the_figure(spark):
    rows = [(k % 3 == 0, 0.9 if k % 7 else 0.1) for k in range(400)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], "is_true_positive int, score double")
    ep = EvalParams(bootstrap_iterations=300)
    a, b = (ev.bootstrap_ci(spark, df.repartition(n), 0.5, ep).first() for n in (1, 5))
    assert a == b and a.draws == 300
    recall = sum(y and s > 0.5 for y, s in rows) / sum(y for y, _ in rows)
    assert a.recall_ci_low < recall < a.recall_ci_high
    assert ev.bootstrap_ci(spark, df.limit(0), 0.5, ep).first().draws == 0


def test_overlap_of_two_hundred_rules(spark):
    rng = random.Random(3)
    ids = [f"Q{k:03d}" for k in range(200)]
    rows = [(rng.choice(ids[:190]), rng.randrange(15), rng.randrange(6)) for _ in range(2500)] + [("other", 1, 1)]
    df = spark.createDataFrame(rows, "rule_id string, customer_key long, date_key int")
    got = rule_overlap(df, ids)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    events = defaultdict(set)
    for r, c, d in rows:
        events[r].add((c, d))
    fired = [r for r in ids if events[r]]
    want = {(a, b): (len(events[a]), len(events[b]), len(events[a] & events[b])) for a, b in combinations(fired, 2)}
    assert {(r.rule_a, r.rule_b): (r.alerts_a, r.alerts_b, r.overlapping_events) for r in got.collect()} == want
    assert rule_overlap(df.limit(0), ids).collect() == []


def test_lines_that_do_not_parse_are_kept_aside(spark):
    lines = ["txn_id,account_id,customer_id,day_index,hour,amount_cad,direction,channel,counterparty_country,counterparty_id,txn_date",
             "T1,A1,C1,3,9,10.50,credit,cash, fr ,P1,2024-01-04", "T2,A1,C1,x3,9,10.50,credit,cash,FR,P1,2024-01-04", "T3,A1,C1,3,9", "T4,A1,C1,3,9,ten,credit,cash,FR,P1,2024-01-04",
             "T5,A1,C1,3,9,-4,debit,cash,,P1,2024-01-04"]
    path = sinks.export_dir(spark, "bad_lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good = feeds.stage_csv(spark, path, "transactions")
    assert good.columns == [f.name for f in feeds.TRANSACTIONS.fields]
    assert {r.txn_id: r.counterparty_country for r in good.collect()} == {"T1": " fr ", "T5": None}
    assert good.count() == 2 and good.select("txn_id").count() == 2
    bad = clean.unparsable(feeds.unparsable_csv(spark, path, "transactions"))
    assert Counter((r.txn_id, r.reject_reason, r.raw_payload) for r in bad.collect()) == Counter((x[:2], "unparsable_row", x) for x in lines[2:5])
