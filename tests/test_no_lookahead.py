"""The point-in-time check must be able to fail."""

from conftest import SF_MID
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerhound.operators import features as fe
from ledgerhound.plans.q_marts import lookahead_violations
from ledgerhound.plans.q_features import FP
from ledgerhound.plans.q_scoring import Evaluation


def test_check_passes_and_catches_a_leaky_frame(spark):
    e = Evaluation(spark, SF_MID)
    clean = {r[0]: r[1] for r in lookahead_violations(e).collect()}
    assert clean["planted_transactions"] > 0 and clean["compared_alerts"] > 0 and clean["no_lookahead"] == 0

    def leaky(fact):
        daily = fe.customer_day(fact, e.dim_country, FP)
        base = Window.partitionBy("customer_key").orderBy("date_key").rangeBetween(-29, 5)
        rolls = fe.rolling_features(daily, FP).join(
            daily.select("customer_key", "date_key", F.sum("vol_total").over(base).alias("leak")), ["customer_key", "date_key"])
        rolls = rolls.withColumn("vol_total_30d", F.col("leak")).drop("leak")
        frame = fe.alert_context(e.alerts).join(rolls, ["customer_key", "date_key"], "left")
        frame = frame.join(e.dim_customer.select("customer_key", *fe.CUSTOMER_FEATURES), "customer_key", "left")
        return fe.add_ratios(frame, FP.epsilon)

    leaks = {r[0]: r[1] for r in lookahead_violations(e, leaky).collect()}
    assert leaks["no_lookahead"] > 0
