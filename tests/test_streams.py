"""Keyed state: version chains that are repaired, and a queue by priority."""

import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import events, versions
from recordloom.streaming import increments


@pytest.mark.parametrize("stretch", [3, 1024])
def test_versions_in_any_order_give_the_pairs_of_a_batch(spark, tmp_path, stretch):
    rows = [(id, v) for id, top in (("a", 40), ("b", 1), ("c", 7)) for v in range(1, top + 1) if v % 5] + [("a", 5000), ("d", -3), ("d", 4), (None, 1), ("c", None), ("a", 1), ("a", 1)]
    random.Random(5).shuffle(rows)
    for n in range(0, len(rows), 16):
        spark.createDataFrame(rows[n : n + 16], "id string, version long").coalesce(1).write.parquet(f"{tmp_path}/in/{n:03}")
    with increments.rocks(spark):
        stream = spark.readStream.schema("id string, version long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        increments.drain(increments.pair_changes(stream, stretch), f"{tmp_path}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")).awaitTermination()
    changes = spark.read.schema(increments.PAIR_CHANGES).parquet(f"{tmp_path}/out")
    index = spark.createDataFrame(rows, "id string, version long").dropna().distinct()
    want = {tuple(r) for r in versions.pairs(index).select("id", "prev_version", "curr_version").collect()}
    got = [tuple(r) for r in increments.standing_pairs(changes.unionByName(changes)).collect()]  # a batch that came twice
    assert len(got) == len(set(got)) and set(got) == want
    assert changes.where("op = '-'").count() > 0


def test_state_of_pairs_is_kept_for_many_ids_at_once(spark, tmp_path):
    rows = [(f"r{i}", v) for i in range(200) for v in range(1, 2 + i % 5)] + [("r7", 2000)]
    random.Random(3).shuffle(rows)
    for n in range(0, len(rows), 250):
        spark.createDataFrame(rows[n : n + 250], "id string, version long").coalesce(1).write.parquet(f"{tmp_path}/in/{n:03}")
    with increments.rocks(spark):
        stream = spark.readStream.schema("id string, version long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        query = increments.drain(increments.pair_changes(stream, lanes=3), f"{tmp_path}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"))
        query.awaitTermination()
    got = [tuple(r) for r in increments.standing_pairs(spark.read.schema(increments.PAIR_CHANGES).parquet(f"{tmp_path}/out")).collect()]
    want = {tuple(r) for r in versions.pairs(spark.createDataFrame(rows, "id string, version long")).select("id", "prev_version", "curr_version").collect()}
    assert len(got) == len(want) and set(got) == want
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 3  # one per id before


def test_no_versions_no_pairs(spark):
    assert increments.standing_pairs(spark.createDataFrame([], increments.PAIR_CHANGES)).count() == 0


def test_queue_by_priority_gives_turns_in_the_order_of_the_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.choice("xy"), rng.choice(["IMMEDIATE", "NORMAL", "LOW", None]), rng.choice([None, f"2024-01-{1 + i % 9:02} 0{i % 7}:00:00"])) for i in range(60)]
    jobs = spark.createDataFrame([*rows, rows[3], (None, "x", "NORMAL", None)], "id long, dept string, priority string, created_at string").withColumn("created_at", F.to_timestamp("created_at"))
    jobs.write.parquet(f"{tmp_path}/in")
    turns: list[list[tuple]] = []
    with increments.rocks(spark):
        stream = increments.landings(spark, f"{tmp_path}/in", "id long, dept string, priority string, created_at timestamp")
        query = increments.prioritized(stream, f"{tmp_path}/queue", lambda now, n: turns.append([tuple(r) for r in now.orderBy("rank", "created_at", "id").collect()]), 10, "x", lanes=3)
        query.processAllAvailable()
        late = spark.createDataFrame([(900, "x", "IMMEDIATE", None), (901, "y", "IMMEDIATE", None)], "id long, dept string, priority string, created_at timestamp")
        late.write.mode("append").parquet(f"{tmp_path}/in")  # comes when the queue is empty
        query.processAllAvailable()
        query.stop()
    pending = jobs.where("id is not null").distinct().withColumn("status", F.lit("PENDING"))
    want = [r["id"] for r in events.next_jobs(pending, 1000, "x").collect()]
    assert [id for turn in turns[:-1] for id, *_ in turn] == want
    assert all(len(turn) == 10 for turn in turns[:-2]) and [id for id, *_ in turns[-1]] == [900]


def test_a_batch_of_the_queue_does_many_turns(spark, tmp_path):
    jobs = spark.range(95).selectExpr("id", "'x' as dept", "if(id % 3 = 0, 'NORMAL', 'LOW') as priority", "timestamp_seconds(id % 40 * 50000) as created_at")
    jobs.write.parquet(f"{tmp_path}/in")
    batches: list[list] = []
    with increments.rocks(spark):
        stream = increments.landings(spark, f"{tmp_path}/in", "id long, dept string, priority string, created_at timestamp")
        query = increments.prioritized(stream, f"{tmp_path}/queue", lambda now, n: batches.append(now.collect()), 10, lanes=3, turns=6)
        query.processAllAvailable()
        query.stop()
    want = [r["id"] for r in events.next_jobs(jobs.withColumn("status", F.lit("PENDING")), 1000).collect()]
    assert {r["id"]: r["turn"] for batch in batches for r in batch} == {id: i // 10 for i, id in enumerate(want)}
    assert [len(batch) for batch in batches] == [60, 35]  # a batch per turn before
