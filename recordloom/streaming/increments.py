"""The same work on streams: new landings, late copies, version pairs by key, a queue."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import events, versions

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAIRS = "id string, prev_version long, curr_version long"
PAIR_CHANGES = "id string, stretch long, op string, prev_version long, curr_version long"
OFFERS = "lane int, rank int, created long, id long"
NO_DATE = -(2**63)
DAY = 86_400_000_000


@contextmanager
def rocks(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own setting comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def landings(spark: SparkSession, path: str, schema: str, files: int | None = None) -> DataFrame:
    """New files of a folder; ``files`` bounds a batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def without_late_copies(stream: DataFrame, time: str, keys: list[str], late: str = "10 days") -> DataFrame:
    """Drops rows whose keys came before, within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def drain(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give all that is new to ``apply`` in batches, then stop; nothing new is no batch. ``apply`` may see a batch again and must be idempotent."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


class VersionChain(StatefulProcessor):
    """Keeps the newest version of a key; emits a pair for every newer one. Older ones that come late are left to the batch run."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "version long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get()[0] if self.last.exists() else None
        versions = sorted({int(v) for batch in rows for v in batch["version"].dropna()})
        found = []
        for v in versions:
            if known is not None and v > known:
                found.append((key[0], known, v))
            known = v if known is None else max(known, v)
        if known is not None:
            self.last.update((known,))
        if found:
            yield pd.DataFrame(found, columns=["id", "prev_version", "curr_version"])

    def close(self) -> None:
        pass


def version_pairs(stream: DataFrame) -> DataFrame:
    """Pairs of consecutive versions of a stream (id, version), with the newest version of each id as state (RocksDB)."""
    return stream.groupBy("id").transformWithStateInPandas(VersionChain(), outputStructType=PAIRS, outputMode="append", timeMode="None")


class RepairedChains(StatefulProcessor):
    """Keeps the versions of the stretches of a lane, in order; a version that comes late takes back the pair it falls into and gives two."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "ids array<string>, stretches array<bigint>, counts array<int>, versions array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list[int]] = {}
        if self.known.exists():
            ids, stretches, counts, versions = self.known.get()
            at = 0
            for id, stretch, n in zip(ids, stretches, counts):
                known[id, stretch] = versions[at : at + n]
                at += n
        came: dict[tuple, set[int]] = {}
        for batch in rows:
            for id, stretch, version in zip(*(batch[c].tolist() for c in ("id", "stretch", "version"))):
                came.setdefault((id, stretch), set()).add(version)
        found: list[tuple] = []
        for place, some in came.items():
            old = known.get(place, [])
            new = sorted(some.union(old))
            if len(new) == len(old):
                continue
            known[place] = new
            was, now = set(zip(old, old[1:])), set(zip(new, new[1:]))
            found += [(*place, "-", *p) for p in was - now] + [(*place, "+", *p) for p in now - was] + [(*place, "ends", new[0], new[-1])]
        if found:
            self.known.update(([i for i, _ in known], [s for _, s in known], [len(v) for v in known.values()], [v for some in known.values() for v in some]))
            yield pd.DataFrame(found, columns=["id", "stretch", "op", "prev_version", "curr_version"])

    def close(self) -> None:
        pass


def pair_changes(stream: DataFrame, stretch: int = 1024, lanes: int = 256) -> DataFrame:
    """What new versions (id, version) in any order change about the pairs of consecutive versions.

    ``+`` and ``-`` rows are pairs that begin and cease to stand, ``ends`` rows the least and greatest version of a
    stretch of ``stretch`` version numbers. The stretches of all ids are dealt to ``lanes``, so that the versions of one id
    are never in one task. State is kept, read and written by lane: a call, which takes some milliseconds by itself, serves many
    ids, and a batch costs at most what its lanes hold. So ``lanes`` should grow with the versions, some ten thousand to
    a lane, and stay the same for a checkpoint. Rows without id or version are left out, repeated ones change nothing.
    """
    rows = stream.where("id is not null and version is not null").select(F.col("id").cast("string").alias("id"), F.expr(f"cast(version as bigint) div {int(stretch)}").alias("stretch"), F.col("version").cast("long").alias("version"))
    lane = F.pmod(F.xxhash64("id", "stretch"), F.lit(lanes)).alias("lane")
    return rows.select(lane, "id", "stretch", "version").groupBy("lane").transformWithStateInPandas(RepairedChains(), outputStructType=PAIR_CHANGES, outputMode="append", timeMode="None")


def standing_pairs(changes: DataFrame) -> DataFrame:
    """The pairs that stand after all ``changes``, in whatever order and however often they come.

    Versions are only ever added: a pair that was taken back never stands again, and the ends of a stretch only move
    apart. Pairs across a border of stretches come from the ends, one row per stretch.
    """
    pairs = changes.where("op <> 'ends'").groupBy("id", "prev_version", "curr_version").agg(F.max(F.col("op") == "-").alias("_gone")).where("not _gone").drop("_gone")
    ends = changes.where("op = 'ends'").groupBy("id", "stretch").agg(F.min("prev_version").alias("first"), F.max("curr_version").alias("last"))
    borders = versions.pairs(ends, version="stretch", carry=("first", "last"))
    return pairs.unionByName(borders.select("id", F.col("prev_last").alias("prev_version"), F.col("curr_first").alias("curr_version")))


class PendingJobs(StatefulProcessor):
    """The pending jobs of a lane by priority and day; offers the first ``limit`` of them whenever jobs come or were taken."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.jobs = handle.getMapState("jobs", "rank int, day bigint", "created array<bigint>, ids array<bigint>")
        self.places = handle.getValueState("places", "ranks array<int>, days array<bigint>")

    def held(self, place: tuple) -> set:
        jobs = self.jobs.getValue(place)
        return set(zip(*jobs)) if jobs else set()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        moved: dict[tuple, tuple[set, set]] = {}
        for batch in rows:
            for rank, created, id, taken in zip(*(batch[c].tolist() for c in ("rank", "created", "id", "taken"))):
                moved.setdefault((rank, created // DAY), (set(), set()))[taken].add((created, id))
        places = set(zip(*self.places.get())) if self.places.exists() else set()
        known: dict[tuple, list] = {}  # a place is read from the state once
        for place, (came, taken) in moved.items():
            jobs = sorted((self.held(place) - taken) | came) if place in places else sorted(came)
            if jobs:
                self.jobs.updateValue(place, ([c for c, _ in jobs], [i for _, i in jobs]))
                places.add(place)
                known[place] = jobs
            elif place in places:
                self.jobs.removeKey(place)
                places.remove(place)
        order = sorted(places)
        self.places.update(([r for r, _ in order], [d for _, d in order]))
        offer: list[tuple] = []
        for rank, day in order:
            if len(offer) >= self.limit:
                break
            jobs = known[rank, day] if (rank, day) in known else sorted(self.held((rank, day)))
            offer += [(rank, created, id) for created, id in jobs[: self.limit - len(offer)]]
        yield pd.DataFrame([(*key, *job) for job in offer or [(None, None, None)]], columns=["lane", "rank", "created", "id"]).astype({"rank": "Int32", "created": "Int64", "id": "Int64"})

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """``rows`` with their place in ``order``, from 0, as ``number``: tasks sort stretches of them, each begins where the one before it ends. ``path`` holds them meanwhile."""
    spark = rows.sparkSession
    rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    found = spark.read.schema(f"{OFFERS}, _at long").parquet(path).withColumn("_part", F.shiftright("_at", 33))
    sizes = found.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))  # one row per task
    number = F.col("_start") + F.col("_at") - F.shiftleft("_part", 33)
    return found.join(F.broadcast(starts), "_part").select(*rows.columns, number.alias("number"))


def prioritized(jobs: DataFrame, home: str, work: Callable[[DataFrame, int], None], limit: int, dept: str | None = None, lanes: int = 32, turns: int = 1) -> StreamingQuery:
    """A queue on a stream of jobs (id, dept, priority, created_at): ``work`` gets at most ``limit`` pending jobs a turn,
    those that ``events.next_jobs`` would take, until none is left.

    Jobs wait in keyed state, dealt to ``lanes`` by id. A lane that changed offers its first jobs; the first of all
    offers are worked on and then come back to their lanes as taken, through a stream of files. A batch of the stream
    does up to ``turns`` turns: ``work`` gets their jobs at once, with the number of each one's turn (from 0), and what lands
    meanwhile waits for the next batch. So a batch costs the offers, at most ``lanes * limit * turns`` rows, not the
    queue, and a long queue costs few batches. ``work`` may see a batch again after a failure and must be idempotent.
    Jobs without id are left out; one that lands twice while it waits is one job.
    """
    spark = jobs.sparkSession
    spark.createDataFrame([], OFFERS).write.mode("ignore").parquet(f"{home}/taken/start")
    spark.createDataFrame([], OFFERS).write.mode("ignore").parquet(f"{home}/offers/1")
    spark.createDataFrame([(0,)], "done long").write.mode("ignore").parquet(f"{home}/turns/1")
    rows = jobs.where("id is not null") if dept is None else jobs.where("id is not null").where(F.col("dept") == dept)
    lane = F.pmod(F.hash("id"), F.lit(lanes)).alias("lane")
    rows = rows.withColumn("id", F.col("id").cast("long")).select(lane, events.priority_rank().alias("rank"), F.coalesce(F.unix_micros("created_at"), F.lit(NO_DATE)).alias("created"), "id", F.lit(False).alias("taken"))
    back = spark.readStream.schema(OFFERS).parquet(f"{home}/taken/*").withColumn("taken", F.lit(True))
    most = limit * turns
    offers = rows.unionByName(back).groupBy("lane").transformWithStateInPandas(PendingJobs(most), outputStructType=OFFERS, outputMode="append", timeMode="None")

    def written(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def turn(batch: DataFrame, n: int) -> None:  # two folders in turn: a batch reads what the one before it left
        came = written(batch, f"{home}/came")
        stay = spark.read.schema(OFFERS).parquet(f"{home}/offers/{(n + 1) % 2}").join(came.select("lane").distinct(), "lane", "left_anti")
        open = in_order(stay.unionByName(came.where("id is not null")), ["rank", "created", "id"], f"{home}/order")
        done = spark.read.schema("done long").parquet(f"{home}/turns/{(n + 1) % 2}").first()[0]
        now = written(open.where(F.col("number") < most).withColumn("turn", F.lit(done) + F.expr(f"number div {int(limit)}")), f"{home}/now")
        written(open.where(F.col("number") >= most).drop("number"), f"{home}/offers/{n % 2}")
        count = now.count()
        spark.createDataFrame([(done + -(-count // limit),)], "done long").write.mode("overwrite").parquet(f"{home}/turns/{n % 2}")
        if count:
            work(now.select("id", "rank", F.timestamp_micros(F.expr(f"nullif(created, {NO_DATE + 1} - 1)")).alias("created_at"), "turn"), n)
            written(now.select("lane", "rank", "created", "id"), f"{home}/taken/{n}")

    return offers.writeStream.option("checkpointLocation", f"{home}/checkpoint").outputMode("append").foreachBatch(turn).start()
