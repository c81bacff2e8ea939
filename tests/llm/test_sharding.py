"""Sharding: balance, places, map versions and rebalancing."""

import zlib
from collections import defaultdict

from inkspring.llm import sharding
from inkspring.llm.common import table


def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = sharding.shard(docs).collect()
    assert len(got) == len(rows)
    held, places = defaultdict(int), defaultdict(list)
    for r in got:
        raw = (rows[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes" and r["grown_shard"] is None
        held[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert set(held) == set(range(24))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(r["size"] for r in got)
    assert max(held.values()) <= sum(held.values()) / 24 + largest
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in got}


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "é", 6), (2, "", 7)], "doc_id long, text string, vslot long")
    got = sharding.shard(df, shards=2, slots=16).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == [(False, 1, 8), (False, 1, 8), (False, 2, 8), (True, 0, 10)]
    assert sharding.shard(df.limit(0)).count() == 0


def test_rebalance_moves_little_and_versions_stay(spark, tmp_path):
    sizes = [(s, 100 + s % 7, 1) for s in range(256)]
    one = sharding.build_map(sizes, 4, 256)
    two = sharding.rebalance(one, sizes, 5)
    load = defaultdict(int)
    for s, b, _ in sizes:
        load[two[s]] += b
    assert set(load) == set(range(5)) and max(load.values()) - min(load.values()) < 400
    assert sum(one[s] != two[s] for s in one) <= 256 // 5 + 8
    sharding.save_map(sharding.map_table(spark, one, sizes, 1), str(tmp_path / "m"))
    sharding.save_map(sharding.map_table(spark, two, sizes, 2), str(tmp_path / "m"))
    now = sharding.load_map(spark, str(tmp_path / "m"))
    assert {r["vslot"]: r["shard"] for r in now.collect()} == two


def test_placement_is_that_of_the_map(spark, sf):
    """Every row's shard and place computed again from the slots alone."""
    docs = sharding.records(table(spark, sf, "documents"), 64)
    rows = [r.asDict() for r in docs.collect()]
    held = defaultdict(int)
    for r in rows:
        held[r["vslot"]] += r["size"]
    load, owner = [0] * 5, {}
    for s in sorted(range(64), key=lambda s: (-held[s], s)):
        k = min(range(5), key=lambda k: (load[k], k))
        owner[s] = k
        load[k] += held[s]
    want, next_place = {}, defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["vslot"], r["doc_id"], r["text_crc32"])):
        k = owner[r["vslot"]]
        want[r["doc_id"]] = (k, next_place[k], r["vslot"], 1)
        next_place[k] += 1
    got = sharding.shard(table(spark, sf, "documents"), shards=5, slots=64).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"], r["virtual_slot"], r["map_version"]) for r in got} == want


def test_a_stored_map_is_edited(spark, sf, tmp_path):
    docs, path = table(spark, sf, "documents"), str(tmp_path / "map")
    one = {r["doc_id"]: r for r in sharding.shard(docs, shards=4, slots=512, path=path).collect()}
    two = {r["doc_id"]: r for r in sharding.shard(docs, shards=5, slots=512, path=path).collect()}
    assert {r["map_version"] for r in one.values()} == {1} and {r["map_version"] for r in two.values()} == {2}
    moved = [i for i in one if one[i]["shard"] != two[i]["shard"]]
    assert 0 < len(moved) < 0.4 * len(one) and {r["shard"] for r in two.values()} == set(range(5))
    assert {r["version"] for r in spark.read.parquet(path).select("version").distinct().collect()} == {1, 2}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, f"t{i}", "a", 7, 8, 9) for i in range(6)], "doc_id long, text string, shard string, slot int, slot_before int, vslot int")
    assert sharding.shard(df, shards=2, slots=16).count() == 6
    out = sharding.shard_documents(df, shards=2, slots=16)
    assert out.columns == ["doc_id", "text", "shard_before", "slot_before_", "slot_before", "vslot", "shard", "slot"]
    assert {tuple(r)[2:6] for r in out.collect()} == {("a", 7, 8, 9)}


def test_a_row_that_a_third_of_all_rows_repeat(spark):
    """No slot and no shard is filled by one row, whatever the partitions are."""
    rows = [(7, "one row of some length that is repeated " * 10)] * 1_000 + [(None, "a row without an id")] * 200 + [(1_000 + i, f"own text {i} " * (i % 50)) for i in range(1_800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(df.repartition(7)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted((i or 0, len(t) + 8) for i, t in rows)
    held, places, slots = defaultdict(int), defaultdict(list), defaultdict(int)
    for r in got:
        held[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        slots[r["virtual_slot"]] += r["doc_id"] == 7
    assert max(held.values()) <= sum(held.values()) / 24 + max(r["size"] for r in got) and max(slots.values()) <= 5
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    plain = lambda rows: sorted(tuple(r[c] if r[c] is not None else -1 for c in ("doc_id", "size", "shard", "slot")) for r in rows)
    assert plain(sharding.shard(df.repartition(3)).collect()) == plain(got)
    whole = sharding.shard_documents(df.withColumn("_k1", sharding.F.lit(1)), shards=4).collect()
    assert len(whole) == len(rows) and {r["_k1"] for r in whole} == {1} and {r["shard"] for r in whole} == {0, 1, 2, 3}


def test_very_long_texts(spark):
    got = sharding.shard(spark.createDataFrame([(1, "é" * 500_000), (2, "x")], "doc_id long, text string"), shards=2).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == [(1, 1_000_008), (2, 9)] and {r["shard"] for r in got} == {0, 1}
