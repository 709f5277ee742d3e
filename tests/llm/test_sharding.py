import math
import struct
import zlib

import xxhash
from small import documents, hard_rows

from costwatch.llm import sharding


def draw(key, shard, weight):
    seed = 42
    for size, value in (("<q", key), ("<i", shard)):
        if value is not None:
            seed = xxhash.xxh64_intdigest(struct.pack(size, value), seed=seed)
    return -math.log(((seed >> 11) + 0.5) * 2.0**-53) / weight


def winner(key, shards):
    return min((draw(key, n, w), n) for n, w in shards)[1]


def test_shards_as_by_hand(spark):
    shards = [(n, 1.0 + n % 3) for n in range(7)]
    rows = sharding.assign_shards(spark.range(500), "id", shards).collect()
    assert [r["shard"] for r in rows] == [winner(r["id"], shards) for r in rows]


def test_weights_and_moves(spark):
    before, after = [(0, 1.0), (1, 2.0), (2, 1.0)], [(0, 1.0), (1, 2.0), (2, 1.0), (3, 1.0)]
    frame = sharding.assign_shards(spark.range(8000), "id", before, "old")
    rows = sharding.assign_shards(frame, "id", after, "new").collect()
    share = sum(r["old"] == 1 for r in rows) / len(rows)
    assert abs(share - 0.5) < 0.03
    assert all(r["new"] in (r["old"], 3) for r in rows)
    assert abs(sum(r["new"] == 3 for r in rows) / len(rows) - 0.2) < 0.03


def test_digest_of_hard_rows(spark):
    rows = hard_rows() + [(i, f"t{i}", "en", "a") for i in range(100, 400)]
    out = sharding.shard_documents(documents(spark, rows, extra=True), 5).collect()
    assert len(out) == len(rows)
    shards = [(n, 1.0) for n in range(5)]
    want = sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), winner(i, shards))
        for i, t, _, _ in rows
    )
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"]) for r in out) == want
    for shard in range(5):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 5) and r["law"] == "key" for r in out)


def test_empty(spark):
    assert sharding.shard_documents(documents(spark, []), 5).count() == 0


def test_rows_without_a_key_are_dealt_over_buckets(spark):
    rows = [(None, f"t{i}", "en", "a") for i in range(4000)] + [(7, f"u{i}", "en", "a") for i in range(2000)]
    frame = sharding.assign_shards(documents(spark, rows), "doc_id", [(n, 1.0) for n in range(5)])
    out = sharding.number_slots(frame, "doc_id", ["source", "text"], buckets=64).collect()
    assert len(out) == 6000
    for shard in {r["shard"] for r in out}:
        slots = {r["text"]: r["slot"] for r in out if r["shard"] == shard}
        assert sorted(slots.values()) == list(range(len(slots)))
        # Numbered by bucket, so not in the order that one sort of all rows would give.
        assert [t for t, _ in sorted(slots.items(), key=lambda x: x[1])] != sorted(slots)
