"""Sharding by fixed virtual slots.

A record's hash gives one of ``n_slots`` virtual slots; bytes and rows are summed
per slot; the slots (at most ``n_slots`` rows, so they may be collected) are given
to shards largest first, each to the shard with fewest bytes, and the
slot-to-shard map is stored as a numbered version.  Growing or rebalancing edits
the map: version k + 1 moves as few slots as needed and no record is hashed anew.
A map names all slots, those without rows too, so that later rows have their place.

Defined results: a null text has no bytes (size 8, the record's fixed cost); a
null id hashes as null with its text; identical rows share a slot; an empty table
gives an empty result and a map of empty slots; input columns named like an output are
replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, shared_folder, with_outputs

N_SLOTS = 8192
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, n_rows long, row_base long"


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               n_slots: int = N_SLOTS) -> DataFrame:
    text = F.coalesce(pick(text_col).cast("string"), F.lit(""))
    return docs.withColumns({
        "__sh_size": F.octet_length(text).cast("long") + 8,
        "__sh_crc": F.crc32(text.cast("binary")),
        "__sh_id": pick(id_col),
    }).withColumn("__sh_hash", F.xxhash64("__sh_id", "__sh_crc", "__sh_size")) \
      .withColumn("__sh_slot", F.pmod("__sh_hash", F.lit(n_slots)).cast("int"))


def slot_totals(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of the used slots: at most ``n_slots`` tuples."""
    totals = rows.groupBy("__sh_slot").agg(F.sum("__sh_size").alias("b"), F.count(F.lit(1)).alias("n"))
    return sorted((r["__sh_slot"], r["b"], r["n"]) for r in totals.collect())


def balanced_map(totals, n_shards: int) -> dict[int, int]:
    """slot -> shard, largest slot first to the lightest shard."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for slot, size, _ in sorted(totals, key=lambda t: (-t[1], t[0])):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def grown_map(shards: dict[int, int], totals, n_shards: int) -> dict[int, int]:
    """The map edited for one more shard: slots move into the new shard only,
    from the heaviest shard each time, until it holds its part of the bytes."""
    size = {slot: b for slot, b, _ in totals}
    load = [0] * n_shards
    members: list[list[int]] = [[] for _ in range(n_shards)]
    for slot, shard in shards.items():
        load[shard] += size[slot]
        members[shard].append(slot)
    for m in members:
        m.sort(key=lambda s: (size[s], s))
    goal, got, out = sum(load) / (n_shards + 1), 0, dict(shards)
    while got < goal and any(members):
        shard = max((s for s in range(n_shards) if members[s]), key=lambda s: (load[s], -s))
        slot = members[shard].pop()
        if got + size[slot] > goal and got + size[slot] - goal > goal - got:
            if got > 0.9 * goal:
                break
            continue
        out[slot] = n_shards
        load[shard] -= size[slot]
        got += size[slot]
    return out


def _map_rows(shards: dict[int, int], totals) -> list[tuple]:
    """``MAP_SCHEMA`` of every slot; ``row_base`` is the number of rows in the lower
    slots of the same shard."""
    base: dict[int, int] = {}
    rows, known = [], {slot: (size, n) for slot, size, n in totals}
    for slot in sorted(shards):
        shard, (size, n) = shards[slot], known.get(slot, (0, 0))
        rows.append((slot, shard, size, n, base.get(shard, 0)))
        base[shard] = base.get(shard, 0) + n
    return rows


def store_map(spark: SparkSession, folder: str, version: int, shards: dict[int, int], totals) -> DataFrame:
    """Write one version of the map and read it back."""
    path = f"{folder}/version={version}"
    spark.createDataFrame(_map_rows(shards, totals), MAP_SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.schema(MAP_SCHEMA).parquet(path)


def newest_version(spark: SparkSession, folder: str) -> int:
    """The number of the newest stored map, 0 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit()), default=0)


def stored_map(spark: SparkSession, folder: str, version: int, n_slots: int = N_SLOTS) -> dict[int, int]:
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}").collect()
    shards = {row["virtual_slot"]: row["shard"] for row in rows}
    if sorted(shards) != list(range(n_slots)):
        raise ValueError(f"version {version} is not a map of {n_slots} slots")
    return shards


def rebalance(docs: DataFrame, n_shards: int, map_folder: str, id_col: str = "doc_id", text_col: str = "text",
              n_slots: int = N_SLOTS) -> int:
    """Grow the newest stored map from ``n_shards`` by one shard, by the bytes of
    ``docs``, and store it as the next version, whose number is returned."""
    spark = docs.sparkSession
    version = newest_version(spark, map_folder)
    if not version:
        raise ValueError(f"no stored map in {map_folder}")
    shards = stored_map(spark, map_folder, version, n_slots)
    known = {slot: (size, n) for slot, size, n in slot_totals(with_slots(docs, id_col, text_col, n_slots))}
    totals = [(slot, *known.get(slot, (0, 0))) for slot in range(n_slots)]
    store_map(spark, map_folder, version + 1, grown_map(shards, totals, n_shards), totals)
    return version + 1


def assign_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  n_slots: int = N_SLOTS, map_folder: str | None = None, version: int | None = None) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``text_crc32``, ``virtual_slot``,
    ``shard`` and ``slot`` (its place in the shard, gapless from 0).  The shard of a
    row follows the stored map in ``map_folder``: ``version`` of it, by default the
    newest; where there is none, version 1 is made, balanced by bytes."""
    spark = docs.sparkSession
    rows = with_slots(docs, id_col, text_col, n_slots)
    totals = slot_totals(rows)
    folder = map_folder or shared_folder(spark, "slot_maps")
    version = version or (newest_version(spark, map_folder) if map_folder else 0)
    if version:
        stored = stored_map(spark, folder, version, n_slots)
        table = spark.createDataFrame(_map_rows(stored, totals), MAP_SCHEMA)
    else:
        shards = {slot: slot % n_shards for slot in range(n_slots)} | balanced_map(totals, n_shards)
        table = store_map(spark, folder, 1, shards, totals)
    table = table.select(
        F.col("virtual_slot").alias("__sh_vslot"), F.col("shard").alias("__sh_shard"),
        F.col("row_base").alias("__sh_base"))
    place = Window.partitionBy("__sh_slot").orderBy("__sh_hash", F.col("__sh_id"))
    rows = rows.withColumn("__sh_no", F.row_number().over(place) - 1)
    rows = rows.join(F.broadcast(table), F.col("__sh_slot") == F.col("__sh_vslot"))
    rows = rows.withColumn("__sh_pos", F.col("__sh_base") + F.col("__sh_no"))
    return with_outputs(rows, {"size": "__sh_size", "text_crc32": "__sh_crc", "virtual_slot": "__sh_slot",
                               "shard": "__sh_shard", "slot": "__sh_pos"}, docs.columns)


def write_shards(assigned: DataFrame, path: str, tasks_per_shard: int = 4) -> None:
    """One folder per shard, its rows in order of ``slot``; a shard is dealt over
    several tasks by slot range so that none holds a whole shard."""
    (assigned.repartition(F.col("shard"), F.pmod(F.col("virtual_slot"), F.lit(tasks_per_shard)))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
