import random

from ledgerhound.llm.histogram import side, splitters
from pyspark.sql import functions as F


def test_splitters_meet_targets_and_split_heavy_keys(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-10 ** 15, 10 ** 15), k, rng.randrange(1, 50)) for k in range(3000)]
    rows += [(77, 10_000 + k, 20) for k in range(3000)]  # one key with over a third of the weight
    df = spark.createDataFrame(rows, "k long, tie long, w int")
    total = sum(r[2] for r in rows)
    targets = [total * i // 5 for i in range(1, 5)]
    for cut, target in zip(splitters(df, "k", "tie", "w", targets, 0), targets, strict=True):
        below = df.filter(~side("k", "tie", cut)).agg(F.sum("w")).first()[0]
        assert abs(below - target) <= 50


def test_unit_weights_are_exact(spark):
    df = spark.createDataFrame([(k % 7, k, 1) for k in range(100)], "k long, tie long, w int")
    for n in (1, 50, 99):
        cut = splitters(df, "k", "tie", "w", [n], 0)[0]
        assert df.filter(~side("k", "tie", cut)).count() == n
