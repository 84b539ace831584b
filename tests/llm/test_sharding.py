from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arborsync.llm import sharding as s


def model(spark, rows, shards, slack=0.0):
    """Keys one by one in the order of their hash, each to the first shard clockwise with room."""
    ring = s.Ring.build(spark, shards)
    room = s.capacities(len(rows), shards, slack)
    out = {}
    for row in sorted(rows, key=lambda r: r["order"]):
        shard = next(x for x in ring.preferences[row["cell"]] if room[x] > 0)
        room[shard] -= 1
        out[row["doc_id"]] = shard
    return out


def hashed(df):
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null"))]
    return df.select("doc_id", F.pmod(s._hash(key, "place"), F.lit(s.CELLS)).alias("cell"), s._hash(key, "order").alias("order")).collect()


@pytest.mark.parametrize("count, shards, followed, slack", [(300, 8, 10_000, 0.0), (300, 5, 3, 0.0), (300, 8, 10_000, 0.2), (3, 8, 10_000, 0.0)])
def test_matches_the_sequential_model(spark, monkeypatch, count, shards, followed, slack):
    monkeypatch.setattr(s, "FOLLOWED", followed)
    df = spark.range(count).select(F.col("id").alias("doc_id"))
    rows = s.assign_shards(df, ["doc_id"], shards, slack=slack).collect()
    assert {r["doc_id"]: r["shard"] for r in rows} == model(spark, hashed(df), shards, slack)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    if not slack:
        sizes = [len(by[k]) for k in range(shards)]
        assert max(sizes) - min(sizes) <= 1


def test_one_key_may_hold_most_rows(spark, monkeypatch):
    monkeypatch.setattr(s, "FOLLOWED", 5)
    df = spark.range(400).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).alias("doc_id"))
    rows = s.assign_shards(df, ["doc_id"], 4).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert sorted(r["n"] for r in rows) == [100] * 4 and all(r["n"] == r["d"] == r["m"] + 1 for r in rows)


def test_few_keys_move_when_a_shard_is_added(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"))
    before = {r["doc_id"]: r["shard"] for r in s.assign_shards(df, ["doc_id"], 8, slack=0.25).collect()}
    after = {r["doc_id"]: r["shard"] for r in s.assign_shards(df, ["doc_id"], 9, slack=0.25).collect()}
    assert sum(before[k] != after[k] for k in before) < 2000 * 0.35


def test_odd_rows(odd):
    rows = s.assign_shards(odd, ["doc_id", "text"], 4)
    assert rows.columns.count("slot") == 1 and rows.count() == 12
    assert sorted(r["count"] for r in rows.groupBy("shard").count().collect()) == [3] * 4


def test_empty_table(docs):
    assert s.assign_shards(docs([]), ["doc_id"], 3).count() == 0
