"""Quality selection by importance resampling.

Texts are bags of hashed word and word-pair features. Two generative models, the target's (texts labelled as good) and the
raw corpus' (all texts), are smoothed multinomials over the feature buckets; a text's importance weight is the ratio of its
probabilities under the two. Gumbel top-k on the log weights then draws ``k`` texts without replacement: each log weight gets
a Gumbel number made from a hash of the row, and the ``k`` largest sums stay, found by exact histogram refinement.

The raw model counts every text. The target model and the cut-off are fitted on a bounded sample of labelled rows,
``LABELLED`` of each label (those of the smallest id hash). ``k`` is the number of texts in the whole corpus whose log weight
reaches the cut-off that separates the two labels best in the sample, so it follows the corpus, not a quota.

Null, empty and wordless texts have weight 0 and are judged like others. Without good labels there is no target and every text
stays; without bad labels there is no cut-off and every text stays. Repeated rows get the same weight and number, so they stay or
go together. Rows with a null doc_id are raw text like others. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, fresh, materialize, row_hash, table, text_rows
from .histogram import key62, side, splitters
from .registry import register

BUCKETS = 1 << 16
LABELLED = 20_000
#: The one feature of all pairs that repeat a word.
REPEAT = np.uint64(0x2545F4914F6CDD1D)
#: Pseudo-count of a feature; large enough that features that are rare in both models weigh little.
SMOOTHING = 20.0
SEED = 7
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Words whose hash a task keeps at hand.
CACHE = 200_000
TEMPERATURE = 1.0


class Features:
    """Bucket numbers of a text's words and word pairs."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        if len(self.known) >= CACHE:
            self.known.clear()
        h = self.known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), SEED)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = TOKEN.findall((text or "").lower())
        get, make = self.known.get, self._hash
        h = np.fromiter((get(w) or make(w) for w in words), np.uint64, len(words))
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        pair[h[:-1] == h[1:]] = REPEAT
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        return np.concatenate([h >> shift, pair >> shift]).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This partition's feature counts, of all texts and of the target's."""
    feats, total = Features(), np.zeros((2, BUCKETS), np.int64)
    for text, good in arrow_rows(batches, "text", "good"):
        own = np.bincount(feats(text), minlength=BUCKETS)
        total[0] += own
        if good == 1:
            total[1] += own
    at = np.flatnonzero(total[0])
    yield pa.record_batch([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["bucket", "raw", "target"])


def log_weight(features: np.ndarray, good: int | None, raw: np.ndarray, target: np.ndarray) -> float:
    """Log ratio of a text's probabilities, the text itself left out of the models that it was counted in.

    Both models have the same smoothing relative to their size, so a feature without evidence weighs nothing.
    """
    at, n = np.unique(features, return_counts=True)
    rest = raw[at] - n
    share = (target.sum() - n.sum() * (good == 1)) / max(1, raw.sum() - n.sum())
    return round(float((n * (np.log(target[at] - n * (good == 1) + SMOOTHING) - np.log(rest * share + SMOOTHING))).sum()), 6)


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feats, (raw, target) = Features(), shared.value
        for batch in batches:
            logs = [log_weight(feats(t), good, raw, target) for t, good in arrow_rows([batch], "text", "good")]
            yield pa.record_batch([batch.column(n) for n in ("doc_id", "text_hash", "good")] + [pa.array(logs, pa.float64())],
                                  names=["doc_id", "text_hash", "good", "log_weight"])
    return run


def labelled_ids(labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(l_id, good): at most ``labelled`` ids of each label; conflicting labels of one id count as bad."""
    ids = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.min("quality").alias("good"))
    some = [ids.filter(F.col("good") == g).orderBy(F.xxhash64("l_id"), "l_id").limit(labelled) for g in (0, 1)]
    return some[0].unionByName(some[1])


def cut_off(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that separates the labelled rows with the fewest errors, as shares of each label; middle of the best gap."""
    values = np.unique(np.concatenate([good, bad]))
    edges = np.concatenate([values[:1] - 1, (values[1:] + values[:-1]) / 2, values[-1:] + 1])
    lost = np.searchsorted(np.sort(good), edges) / len(good)
    caught = np.searchsorted(np.sort(bad), edges) / len(bad)
    best = np.flatnonzero((caught - lost) >= (caught - lost).max() - 1e-12)
    return float(edges[best[len(best) // 2]])


def weigh(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, text_hash, good, log_weight) of every row; two passes over the whole texts."""
    spark = docs.sparkSession
    ids = materialize(labelled_ids(labels, labelled), "labelled")
    rows = (text_rows(docs).join(F.broadcast(ids), F.col("doc_id") == F.col("l_id"), "left")  # at most 2 * labelled ids
            .select("doc_id", "text", row_hash(F.col("text")).alias("text_hash"), "good"))
    counted = rows.select("text", "good").mapInArrow(_counts, "bucket long, raw long, target long")
    got = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = got["bucket"].to_numpy(np.int64)
    raw[at], target[at] = got["raw"].to_numpy(np.int64), got["target"].to_numpy(np.int64)
    if not target.any():
        return rows.select("doc_id", "text_hash", "good", F.lit(0.0).alias("log_weight"))
    return rows.mapInArrow(_scores(spark.sparkContext.broadcast((raw, target))), "doc_id long, text_hash long, good int, log_weight double")


def select(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, k: int | None = None) -> DataFrame:
    """(doc_id, text_hash, log_weight, perturbed, kept) of every row; ``k``: how many to draw, None for the cut-off's number."""
    weights = materialize(weigh(docs, labels, labelled), "weights")
    total = weights.count()
    if k is None:
        known = weights.filter("good IS NOT NULL").groupBy("doc_id", "good").agg(F.min("log_weight").alias("w")).toPandas()  # bounded by labelled
        good, bad = (known.loc[known["good"] == g, "w"].to_numpy(float) for g in (1, 0))
        k = weights.filter(F.col("log_weight") >= cut_off(good, bad)).count() if len(good) and len(bad) else total
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(SEED)), 11) + 0.5) / float(1 << 53)
    noisy = weights.withColumn("perturbed", F.round(F.col("log_weight") / TEMPERATURE - F.log(-F.log(u)), 6))
    keyed = (noisy.withColumn("k", F.round(F.col("perturbed") * 1e6).cast("long"))
             .withColumn("tie", key62(F.xxhash64("doc_id", "text_hash"))).withColumn("one", F.lit(1)))
    if k >= total:
        return keyed.withColumn("kept", F.lit(True)).drop("k", "tie", "one", "good")
    cut = splitters(keyed, "k", "tie", "one", [total - k], 0)[0]
    return keyed.withColumn("kept", side("k", "tie", cut)).drop("k", "tie", "one", "good")


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are drawn, with its columns; repeated rows all stay or all go."""
    k_id, k_hash = fresh(docs, "kept_id", "kept_hash")
    kept = select(docs, labels).filter("kept").select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & (row_hash(F.col("text").cast("string")) == F.col(k_hash))
    return docs.join(kept, same, "left_semi")


@register("op10_quality")
def op10_quality(spark, sf_dir):
    got = select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "log_weight", "perturbed", "kept")
