import zlib
from collections import Counter, defaultdict

from ledgerhound.llm import shards as op

from .cases import corpus, frame


def test_sizes_slots_and_whole_rows(spark):
    rows = [(i, "x" * (1 + i % 7) + str(i % 211), None) for i in range(3000)] + corpus()
    got = op.shard(frame(spark, rows), 8).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots, load = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 8 for _, t, _ in rows)
    assert set(load) <= set(range(8)) and max(load.values()) - min(load.values()) <= 2 * largest


def test_hot_group_is_split_and_others_stay_whole(spark):
    rows = [(i, "the same text", None) for i in range(2000)] + [(5000 + i, f"other {i // 2}", None) for i in range(4000)]
    got = op.shard(frame(spark, rows), 6).collect()
    load, places = Counter(), defaultdict(set)
    for r in got:
        load[r.shard] += r["size"]
        places[r.text_crc32].add(r.shard)
    mean = sum(load.values()) / 6
    assert all(abs(x - mean) < 0.01 * mean for x in load.values())
    assert sum(len(p) > 1 for p in places.values()) <= 5


def test_slots_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(op, "ROWS_PER_BUCKET", 50)
    got = op.shard(frame(spark, [(i, str(i), None) for i in range(1000)]), 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_repeated_rows_empty_and_few_rows(spark):
    got = op.shard(frame(spark, [(1, "a", None)] * 5), 3).collect()
    assert len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(5))
    assert op.shard(frame(spark, corpus()).limit(0), 3).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = frame(spark, corpus())
    op.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and set(docs.columns) < set(back.columns)
