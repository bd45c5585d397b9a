"""Operator 8: sharding over fixed virtual slots.

Rows are hashed by doc_id into a fixed number of virtual slots; bytes and rows are added
up per slot; a versioned map names the shard of each slot. The map is small (one row per
slot), so it is built on the driver and broadcast. It is stored: a later call on the same
map folder looks the newest version up and edits it, moving as few whole slots as balance
asks for, and writes the edited map as the next version. The law of the query is ``bytes``.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.llm.shared import located, shared_dir, stage

#: Fixed for good: changing it would move every row.
SLOTS = 8192
MAP_SCHEMA = "version int, vslot int, shard int, slot_bytes long, slot_rows long, base long"
OVERHEAD = 16
#: How far above the mean a shard may be before an edited map takes slots from it.
SLACK = 0.01
#: Rows that may share a doc_id and its slot.
HOT = 1000


def slotted(docs: DataFrame, slots: int = SLOTS, hot: int = HOT) -> DataFrame:
    """doc_id, size, text_crc32, locator and virtual slot of each row. Null texts have no bytes.

    The slot depends on doc_id alone, so that an edited text stays where it is. Rows without
    doc_id, and those of a doc_id that more than ``hot`` rows share, would fill one slot:
    they are spread by their place in the table.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        located(docs, "doc_id", "text").select(
            "doc_id",
            (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            "locator",
        ),
        "rows",
    )
    shared = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > hot) & F.col("doc_id").isNotNull())
    marked = rows.join(shared.select(F.col("doc_id").alias("shared_id")), F.col("doc_id") == F.col("shared_id"), "left")
    alone = F.col("doc_id").isNotNull() & F.col("shared_id").isNull()
    key = F.when(alone, F.xxhash64("doc_id")).otherwise(F.xxhash64("locator"))
    return marked.select("doc_id", "size", "text_crc32", "locator", F.pmod(key, F.lit(slots)).cast("int").alias("vslot"))


def _fill(slots: Iterable[int], loads: dict[int, int], chosen: dict[int, int], shards: int) -> dict[int, int]:
    """``chosen`` plus ``slots``: heaviest first, each to the lightest shard so far; then empty ones to shards with fewest slots."""
    filled, count = Counter(), Counter(chosen.values())
    for slot, shard in chosen.items():
        filled[shard] += loads.get(slot, 0)
    order = sorted(slots, key=lambda v: (-loads.get(v, 0), v))
    heap = [(filled[s], count[s], s) for s in range(shards)]
    heapq.heapify(heap)
    while order and loads.get(order[0], 0):
        slot = order.pop(0)
        load, own, shard = heapq.heappop(heap)
        chosen[slot] = shard
        heapq.heappush(heap, (load + loads[slot], own + 1, shard))
    # What such slots will hold can't be known: they are spread evenly.
    heap = [(own, s) for _, own, s in heap]
    heapq.heapify(heap)
    for slot in order:
        own, shard = heapq.heappop(heap)
        chosen[slot] = shard
        heapq.heappush(heap, (own + 1, shard))
    return chosen


def assign(loads: dict[int, int], shards: int) -> dict[int, int]:
    """First map (ties: fewer slots, lower numbers)."""
    return _fill(loads, loads, {}, shards)


def rebalance(loads: dict[int, int], before: dict[int, int], shards: int) -> dict[int, int]:
    """Edited map for ``shards`` shards; hardly more bytes move than must.

    Slots of shards that are gone, and the lightest slots of shards more than ``SLACK`` above
    the new mean, go to the emptiest shards; all other slots stay where they are.
    """
    mean = sum(loads.values()) / shards
    held, homeless = defaultdict(list), []
    for slot in sorted(before, key=lambda v: (-loads.get(v, 0), v)):
        (held[before[slot]] if before[slot] < shards else homeless).append(slot)
    after, filled = {}, dict.fromkeys(range(shards), 0)
    for shard, own in held.items():
        for slot in own:
            if filled[shard] and filled[shard] + loads.get(slot, 0) > mean * (1 + SLACK):
                homeless.append(slot)
            else:
                after[slot], filled[shard] = shard, filled[shard] + loads.get(slot, 0)
    return _fill(homeless, loads, after, shards)


def slot_map(spark: SparkSession, stats: list, chosen: dict[int, int], version: int = 1) -> DataFrame:
    """The map as a table: shard, bytes, rows, and the place of the slot's first row in its shard."""
    start, rows, found = defaultdict(int), [], {slot: (size, count) for slot, size, count in stats}
    for slot in sorted(chosen):
        size, count = found.get(slot, (0, 0))
        rows.append((version, slot, chosen[slot], size, count, start[chosen[slot]]))
        start[chosen[slot]] += count
    return spark.createDataFrame(rows, MAP_SCHEMA)


def newest(spark: SparkSession, folder: str) -> tuple[int, dict[int, int]]:
    """Number of the newest complete version in a map folder and its slot-to-shard map; (0, {}) if there is none."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in store.listStatus(fs_path)] if store.exists(fs_path) else []
    versions = sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)
    for version in versions:
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/version={version}/_SUCCESS")
        if store.exists(done):  # a version whose writer was lost is passed over
            rows = spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}").select("vslot", "shard").collect()
            return version, dict(map(tuple, rows))
    return 0, {}


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, map_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their shard and place in it, and the stored version of the map that holds now.

    Without a map in ``map_dir`` (default: a fresh folder) the first version is built; else
    the newest one is edited for the present bytes and ``shards``: every slot keeps its shard
    unless balance or a changed number of shards asks for a move. Places are gapless from 0
    in each shard. Empty tables give empty frames; rows that repeat are kept and each gets a
    place of its own. Rows of equal texts may be in different shards, as their doc_ids say.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = stage(slotted(docs, slots), "slotted")
    # At most ``slots`` rows reach the driver, whatever the input.
    stats = [tuple(r) for r in rows.groupBy("vslot").agg(F.sum("size"), F.count(F.lit(1))).collect()]
    loads = dict.fromkeys(range(slots), 0) | {s: size for s, size, _ in stats}
    folder = map_dir.rstrip("/") if map_dir else f"{shared_dir(spark)}/slot_map"
    version, before = newest(spark, folder)
    chosen = rebalance(loads, before, shards) if before else assign(loads, shards)
    version += 1  # versions are never overwritten
    path = f"{folder}/version={version}"
    slot_map(spark, stats, chosen, version).write.mode("overwrite").parquet(path)
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "locator")
    placed = rows.withColumn("at", F.row_number().over(order) - 1)
    return placed.join(F.broadcast(table), "vslot").withColumn("slot", F.col("base") + F.col("at")), table
