import hashlib
from collections import Counter, defaultdict

import pytest
from ledgerhound.llm import exact_dedup as op

from .cases import corpus, frame

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[(text or "").translate(BLANKS)].append((i, text or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for i, _ in members:
            out.append((i, best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("fan, leaf", [(2, 5), (8, 500_000)])
def test_against_brute_force(spark, fan, leaf):
    rows = corpus()
    got = op.exact_dedup(frame(spark, rows), fan, leaf).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(brute(rows))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {x[3] for x in brute(rows)}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_longest_original_wins_then_smallest_id(spark):
    got = {r.doc_id: r for r in op.exact_dedup(frame(spark, [(1, "ab", None), (2, "a b", None), (3, "a b", None), (4, "a b", None)])).collect()}
    assert [got[i].keep_id for i in (1, 2, 3, 4)] == [2, 2, 2, 4]


def test_drop_copies_keeps_columns_and_one_row_a_text(spark):
    rows = corpus()
    docs = frame(spark, rows)
    left = op.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter((r.text or "").translate(BLANKS) for r in left.collect()) == Counter({(t or "").translate(BLANKS) for _, t, _ in rows})


def test_empty_table(spark):
    docs = frame(spark, corpus()).limit(0)
    assert op.exact_dedup(docs).collect() == [] and op.drop_copies(docs).collect() == []
