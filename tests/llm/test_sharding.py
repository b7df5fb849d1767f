from railyard.llm import sharding


def test_shards_of_odd_rows(frame, odd_rows):
    rows = odd_rows + [(1000 + i, f"{i} " * (1 + i % 90), "s") for i in range(400)]
    out = sharding.shard_by_bytes(frame(rows), shards=5).collect()
    assert len(out) == len(rows)
    assert {r["shard"] for r in out} <= set(range(5))  # the long text outweighs a shard
    for shard in range(5):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    sizes = sorted(len((t or "").encode()) + 1 for _, t, _ in rows)
    assert sorted(r["size"] for r in out) == sizes
    homes = {}
    for r in out:
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in homes.values())
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
    assert sharding.shard_by_bytes(frame([])).count() == 0


def test_near_equal_bytes(frame):
    rows = [(i, f"{i * 7919 % 1000} " * (1 + i * i % 40), "s") for i in range(3000)]
    out = sharding.shard_by_bytes(frame(rows)).collect()
    held = [sum(r["size"] for r in out if r["shard"] == s) for s in range(16)]
    assert max(held) - min(held) <= 4 * max(r["size"] for r in out)


def test_a_group_that_outweighs_a_shard_is_split(frame):
    rows = [(i, "the same text", "s") for i in range(300)] + [(1000 + i, f"other {i}", "s") for i in range(100)]
    out = sharding.shard_by_bytes(frame(rows), shards=8).collect()
    held = [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]
    assert max(held) - min(held) <= 30
