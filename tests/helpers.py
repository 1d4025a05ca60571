from decimal import Decimal

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("account_key", T.LongType()),
    T.StructField("customer_key", T.LongType()),
    T.StructField("counterparty_country", T.StringType()),
    T.StructField("counterparty_id", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("amount_cad", T.DecimalType(18, 2)),
    T.StructField("direction", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("signed_amount_cad", T.DecimalType(18, 2)),
])


def fact(spark, rows):
    """rows: (date_key, hour, amount, direction, channel[, account, customer, country])"""
    out = []
    for i, r in enumerate(rows):
        d, h, amt, direction, channel = r[:5]
        acct = r[5] if len(r) > 5 else 1
        cust = r[6] if len(r) > 6 else 1
        country = r[7] if len(r) > 7 else "CA"
        a = Decimal(str(amt)).quantize(Decimal("0.01"))
        out.append((f"T{i}", d, acct, cust, country, f"P{i % 3}", h, a, direction, channel,
                    a if direction == "credit" else -a))
    return spark.createDataFrame(out, FACT_SCHEMA)
