import bisect
import math
import random
import zlib
from collections import defaultdict

from faultloom.llm import sharding


def first_principles(items, capacity):
    bins, rooms = [], []
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= size]
        if not fits:
            bins.append([])
            rooms.append(capacity)
            fits = [(capacity, len(bins) - 1)]
        _, at = min(fits)
        bins[at].append(key)
        rooms[at] -= size
    return bins


def test_best_fit_equals_scan():
    rng = random.Random(1)
    for _ in range(30):
        items = [(rng.randint(1, 100), i) for i in range(400)]
        assert sharding.best_fit_decreasing(items, 128) == first_principles(items, 128)


def laws(rows, docs, shards):
    assert len(rows) == len(docs)
    sizes, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    text = dict(docs)
    for r in rows:
        t = (text[r.doc_id] or "").encode()
        assert r["size"] == len(t) + 16 and r.text_crc32 == zlib.crc32(t) and r.law == "bytes"
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        homes[t].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return sizes, homes


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    sizes, homes = laws(sharding.shard(docs, 8).collect(), pairs, 8)
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    assert all(len(h) == 1 for h in homes.values())


def test_hot_group_and_edges(spark):
    pairs = [(i, "same text " * 9) for i in range(500)] + [(500 + i, "x" * (i % 50)) for i in range(500)]
    pairs += [(2000, None), (2001, "")]
    df = spark.createDataFrame([(*p, 1) for p in pairs], "doc_id long, text string, shard int")
    sizes, homes = laws(sharding.shard(df, 10).collect(), pairs, 10)
    assert max(sizes.values()) < 1.05 * min(sizes.values())
    assert len(homes[b""]) == 1
    assert sharding.shard(df.limit(0), 10).count() == 0
    doubled = df.filter("doc_id > 1990").union(spark.createDataFrame([(None, "y", 1), (None, "y", 1)], df.schema))
    assert sharding.shard(doubled, 2).count() == 4


def test_tree_stays_balanced():
    rng = random.Random(2)
    tree, bins = sharding.RoomTree(), 100_000
    for at in range(bins):
        tree.put(at, at)
    assert tree.height <= 1.45 * math.log2(bins)
    rooms = list(range(bins))
    for _ in range(2_000):
        size = rng.randrange(bins)
        room, at = tree.take(size)
        k = bisect.bisect_left(rooms, size)
        assert room == rooms.pop(k)
        tree.put(room // 3, at)
        bisect.insort(rooms, room // 3)
    assert tree.take(bins) is None
    while rooms:
        assert tree.take(0)[0] == rooms.pop(0) if len(rooms) < 500 else tree.take(rooms.pop())
        assert tree.height <= 1.45 * math.log2(len(rooms) + 2) + 1
    assert tree.take(0) is None


def test_rows_without_ids_are_dealt_like_others(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 100)
    pairs = [(None, "one text of many rows")] * 3_000 + [(7, "another text, one id")] * 3_000
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    rows = sharding.shard(df, 10).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(rows) == 6_000 and len(sizes) == 10
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
