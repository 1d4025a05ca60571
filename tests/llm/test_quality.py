import numpy as np
from ledgerhound.llm import quality as op

from .cases import corpus, frame, labels


def junk(rows, limit=60):
    """Every fourth id below the limit becomes junk."""
    return [(i, "!! ".join((t or "").upper().split()) + " !!" if i is not None and i % 4 == 0 and i < limit else t, x) for i, t, x in rows]


def test_weights_against_brute_force(spark):
    rows = junk(corpus())
    docs, marks = frame(spark, rows), labels(spark, rows)
    good = {r.l_id: r.good for r in op.labelled_ids(marks).collect()}
    feats = op.Features()
    per = [np.bincount(feats(t), minlength=op.BUCKETS) for _, t, _ in rows]
    raw, target = sum(per), sum(p for p, r in zip(per, rows, strict=True) if good.get(r[0]) == 1)
    want = []
    for (i, _, _), own in zip(rows, per, strict=True):
        mine = own * (good.get(i) == 1)
        rest_raw, rest_target = raw - own, target - mine
        share = rest_target.sum() / rest_raw.sum()
        want.append((str(i), round(float((own * (np.log(rest_target + op.SMOOTHING) - np.log(rest_raw * share + op.SMOOTHING))).sum()), 3)))
    got = [(str(r.doc_id), round(r.log_weight, 3)) for r in op.weigh(docs, marks).collect()]
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 0.01 for a, b in zip(sorted(got), sorted(want), strict=True))


def test_top_k_is_exact(spark):
    rows = corpus()
    docs, marks = frame(spark, rows), labels(spark, rows)
    got = op.select(docs, marks, k=20).collect()
    ranked = sorted((r.perturbed for r in got), reverse=True)
    kept = [r.perturbed for r in got if r.kept]
    assert 18 <= len(kept) <= 22  # repeated rows stay or go together
    assert sorted(kept, reverse=True) == ranked[:len(kept)]


def test_junk_goes_and_clean_stays(spark):
    rows = junk(corpus(n=400), 400)
    docs, marks = frame(spark, rows), labels(spark, rows)
    got = [r for r in op.select(docs, marks).collect() if r.doc_id is not None and r.doc_id < 400]
    wrong = [r.doc_id for r in got if r.kept == (r.doc_id % 4 == 0)]
    assert len(wrong) <= 0.03 * len(got)
    left = op.drop_rejected(docs, marks)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in op.select(docs, marks).collect())


def test_without_labels_all_stay(spark):
    rows = corpus()
    docs, marks = frame(spark, rows), labels(spark, rows)
    assert all(r.kept for r in op.select(docs, marks.limit(0)).collect())
    assert all(r.kept for r in op.select(docs, marks.filter("quality = 1")).collect())
    assert op.select(docs.limit(0), marks).collect() == []


def test_cut_off_separates():
    assert -1 < op.cut_off(np.array([3.0, 4.0, 5.0]), np.array([-9.0, -1.0])) < 3
