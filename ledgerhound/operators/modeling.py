"""Model preparation, logistic regression on MLlib and leaf-wise boosted trees (O-60..O-63).

Preparation is plain column expressions: numeric inputs are standardised with
the training mean and population standard deviation, categoricals are one-hot
encoded over the levels seen at least ``min_category_rows`` times in training
(rarer levels pool into one ``infrequent`` slot; levels that training never had,
and nulls, encode as all zeros). Only the fitted statistics (two numbers per
numeric input, the level lists) and the model coefficients reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import ModelParams
from . import boosting

Y = "is_true_positive"
INFREQUENT = "infrequent"
#: Relative to the mean, a deviation that is rounding noise: the input is constant and only centred.
CONSTANT = 1e-9
#: How far a value of a constant input may be from the mean and still be that constant.
NOISE = 1e-6
#: Levels of all categorical inputs together that a model may have.
MAX_LEVELS = 20_000


@dataclass
class Prep:
    num_cols: list[str]
    cat_cols: list[str]
    means: dict[str, float]
    stds: dict[str, float]
    levels: dict[str, list[str]]
    pooled: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        out = list(self.num_cols)
        for c in self.cat_cols:
            out += [f"{c}_{v}" for v in self.levels[c]]
            if self.pooled[c]:
                out.append(f"{c}_{INFREQUENT}")
        return out

    @property
    def inputs(self) -> list[str]:
        """The column that each of ``names`` comes from."""
        return [*self.num_cols, *[c for c in self.cat_cols for _ in range(len(self.levels[c]) + bool(self.pooled[c]))]]


def fit_prep(train: DataFrame, num_cols: list[str], cat_cols: list[str], mp: ModelParams = ModelParams()) -> Prep:
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in num_cols],
                      *[F.stddev_pop(c).alias(f"s_{c}") for c in num_cols]).first()
    means = {c: float(stats[f"m_{c}"] or 0.0) for c in num_cols}
    stds = {c: float(stats[f"s_{c}"] or 0.0) for c in num_cols}
    levels, pooled = {c: [] for c in cat_cols}, {c: [] for c in cat_cols}
    if cat_cols:
        # One job for every categorical input: (input, level) counts.
        pairs = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v"))
                                                  for c in cat_cols])).alias("p"))
        counts = pairs.filter("p.v IS NOT NULL").groupBy("p.k", "p.v").count().limit(MAX_LEVELS + 1).collect()
        if len(counts) > MAX_LEVELS:
            raise ValueError(f"the categorical inputs {cat_cols} have more than {MAX_LEVELS} levels; free text is no categorical")
        for r in counts:
            (levels if r["count"] >= mp.min_category_rows else pooled)[r["k"]].append(r["v"])
        levels, pooled = ({c: sorted(v) for c, v in x.items()} for x in (levels, pooled))
    return Prep(num_cols, cat_cols, means, stds, levels, pooled)


def transform(df: DataFrame, prep: Prep, out: str = "features") -> DataFrame:
    cols = []
    for c in prep.num_cols:
        # A constant input is exactly 0: its rounding noise would be scaled up again inside the solver.
        constant = prep.stds[c] <= CONSTANT * max(1.0, abs(prep.means[c]))
        centred = F.col(c).cast("double") - prep.means[c]
        cols.append((F.when(F.abs(centred) <= NOISE * max(1.0, abs(prep.means[c])), F.lit(0.0)).otherwise(centred) if constant
                     else centred / prep.stds[c]).alias(f"_x_{len(cols)}"))
    for c in prep.cat_cols:
        v = F.col(c).cast("string")
        for lvl in prep.levels[c]:
            cols.append((v == lvl).cast("double").alias(f"_x_{len(cols)}"))
        if prep.pooled[c]:
            cols.append(v.isin(*prep.pooled[c]).cast("double").alias(f"_x_{len(cols)}"))
    x = df.select("*", *[F.coalesce(c, F.lit(0.0)) for c in cols])
    names = [f"_x_{i}" for i in range(len(cols))]
    x = x.toDF(*df.columns, *names)
    return VectorAssembler(inputCols=names, outputCol=out).transform(x).drop(*names)


def class_weights(train: DataFrame) -> tuple[float, float]:
    """Balanced weights n / (2 n_c) for classes 0 and 1."""
    r = train.agg(F.count(F.lit(1)).alias("n"), F.sum(Y).alias("p")).first()
    n, p = float(r["n"]), float(r["p"] or 0)
    neg = n - p
    return (n / (2 * neg) if neg else 1.0, n / (2 * p) if p else 1.0)


def with_weight(df: DataFrame, w: tuple[float, float]) -> DataFrame:
    return df.withColumn("w", F.when(F.col(Y) == 1, F.lit(w[1])).otherwise(F.lit(w[0])))


def fit_logistic(train_x: DataFrame, mp: ModelParams = ModelParams()):
    """O-61: L2 logistic regression. The penalty C * sum(w * loss) + |b|^2 / 2
    equals MLlib's mean-weighted loss + regParam |b|^2 / 2 with
    regParam = 1 / (C * sum(w)); with balanced weights sum(w) = n."""
    n = train_x.count()
    lr = LogisticRegression(featuresCol="features", labelCol=Y, weightCol="w", maxIter=mp.logistic_max_iter,
                            regParam=1.0 / (mp.logistic_c * n), elasticNetParam=0.0, standardization=False)
    return lr.fit(train_x)


def fit_gbt(train_x: DataFrame, mp: ModelParams = ModelParams()) -> boosting.BoostedTrees:
    """O-62: gradient boosted trees, grown leaf by leaf."""
    return boosting.fit(train_x, Y, mp.n_estimators, mp.learning_rate, mp.num_leaves, mp.min_child_samples)


def score(model, df_x: DataFrame, name: str) -> DataFrame:
    if isinstance(model, boosting.BoostedTrees):
        return boosting.score(model, df_x, name)
    return model.transform(df_x).withColumn(name, vector_to_array("probability")[1]) \
        .drop("rawPrediction", "probability", "prediction")


def feature_importance(gbt_model: boosting.BoostedTrees, prep: Prep, spark) -> DataFrame:
    """O-63: each original feature's share of all split gains (the slots of a categorical add up), sorted descending."""
    total = dict.fromkeys([*prep.num_cols, *prep.cat_cols], 0.0)
    gains = gbt_model.gains(len(prep.inputs))
    for column, v in zip(prep.inputs, (gains / (gains.sum() or 1.0)).tolist(), strict=True):
        total[column] += float(v)
    return spark.createDataFrame(list(total.items()), "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def prepared_values(df_x: DataFrame, prep: Prep) -> DataFrame:
    """O-60 as rows: (alert_id, input, column, value) of every numeric input and every set categorical slot."""
    slots = F.array(*[F.struct(F.lit(n).alias("input"), F.lit(c).alias("column")) for n, c in zip(prep.names, prep.inputs, strict=True)])
    z = df_x.select("alert_id", F.explode(F.arrays_zip(slots.alias("s"), vector_to_array("features").alias("value"))).alias("e"))
    numeric = F.col("column").isin(*prep.num_cols)
    return z.select("alert_id", "e.s.input", "e.s.column", "e.value").filter(numeric | (F.col("value") != 0))
