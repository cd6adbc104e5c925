"""Sharding through fixed virtual slots.

A record's key is hashed into one of ``SLOTS`` slots for good. Which shard
holds a slot is data: a versioned map, an array with a shard per slot. A first
map deals the slots round; ``grow`` hands slots to new shards and moves none
between old ones; ``rebalance`` edits a map after the measured bytes per slot.
So a record's shard depends on its key and the map's version only, and a change
of the map moves whole slots.

Defined results: a null key is hashed as the string 'null'; a null text has 16
bytes of overhead only and CRC 0 (that of the empty text); repeated rows go to the same
shard and each have a position of their own; extra columns are kept by
``assign``; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm.common import new_path, remove

SLOTS = 4096
OVERHEAD = 16
#: A slot's rows are numbered in this many parts, so that a key that holds many rows is no single task.
PARTS = 16


@dataclass(frozen=True)
class SlotMap:
    """Version and shard of each slot."""

    version: int
    shards: tuple[int, ...]

    @property
    def n_shards(self) -> int:
        return max(self.shards) + 1

    @staticmethod
    def initial(n_shards: int, slots: int = SLOTS) -> SlotMap:
        """Slots dealt round the shards."""
        if not 0 < n_shards <= slots:
            raise ValueError("there are at least one shard and no more shards than slots")
        return SlotMap(1, tuple(s % n_shards for s in range(slots)))

    def grow(self) -> SlotMap:
        """One more shard, which takes an equal share of slots, each from the shard that has most left."""
        owned: dict[int, list[int]] = {}
        for slot, shard in enumerate(self.shards):
            owned.setdefault(shard, []).append(slot)
        new, shards = self.n_shards, list(self.shards)
        for _ in range(len(shards) // (new + 1)):
            giver = max(owned, key=lambda s: (len(owned[s]), -s))
            shards[owned[giver].pop()] = new
        return SlotMap(self.version + 1, tuple(shards))

    def rebalance(self, slot_bytes: dict[int, int], tolerance: float = 0.02) -> SlotMap:
        """Moves slots from the fullest to the emptiest shard until no shard exceeds the mean by ``tolerance`` or no move helps."""
        shards, load = list(self.shards), [0] * self.n_shards
        owned: list[set[int]] = [set() for _ in load]
        for slot, shard in enumerate(shards):
            load[shard] += slot_bytes.get(slot, 0)
            owned[shard].add(slot)
        mean, moved = sum(load) / len(load), False
        while True:
            full, free = max(range(len(load)), key=load.__getitem__), min(range(len(load)), key=load.__getitem__)
            gap = load[full] - load[free]
            fit = [s for s in owned[full] if 0 < slot_bytes.get(s, 0) < gap]
            if load[full] <= mean * (1 + tolerance) or not fit:
                break
            slot = min(fit, key=lambda s: (abs(slot_bytes[s] - gap / 2), s))
            owned[full].remove(slot)
            owned[free].add(slot)
            shards[slot], moved = free, True
            load[full] -= slot_bytes[slot]
            load[free] += slot_bytes[slot]
        return SlotMap(self.version + 1, tuple(shards)) if moved else self

    def rows(self, spark: SparkSession) -> DataFrame:
        """The map as a table (version, virtual_slot, shard), to be stored."""
        return spark.range(len(self.shards)).select(F.lit(self.version).alias("version"), F.col("id").cast("int").alias("virtual_slot"), self.shard_of(F.col("id").cast("int")).alias("shard"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the map store at ``path``; other versions stay."""
        self.rows(spark).coalesce(1).write.mode("error").parquet(f"{path}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version}").select("virtual_slot", "shard").collect()  # a row per slot
        return SlotMap(version, tuple(r["shard"] for r in sorted(rows)))

    def shard_of(self, slot: Column) -> Column:
        """The shard of a slot; the map is one string literal, which folds into a constant array."""
        return F.get(F.split(F.lit(",".join(map(str, self.shards))), ",").cast("array<int>"), slot)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 32 bits of the key's MD5, modulo the number of slots; the same in any engine."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, plus the overhead of a record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def assign(df: DataFrame, key_col: str, slot_map: SlotMap, grown: SlotMap | None = None) -> DataFrame:
    """``df`` with virtual_slot and shard, and grown_shard under a second map. Moves no row."""
    out = df.withColumn("virtual_slot", slot_of(F.col(key_col), len(slot_map.shards))).withColumn("shard", slot_map.shard_of(F.col("virtual_slot")))
    return out.withColumn("grown_shard", grown.shard_of(F.col("virtual_slot"))) if grown else out


def slot_sizes(df: DataFrame, key_col: str, text_col: str, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, rows, bytes): what ``rebalance`` is fed with; a row per slot."""
    return df.groupBy(slot_of(F.col(key_col), slots).alias("virtual_slot")).agg(F.count("*").alias("rows"), F.sum(record_size(F.col(text_col))).alias("bytes"))


def stored_maps(documents: DataFrame, n_shards: int, key_col: str = "doc_id", text_col: str = "text") -> tuple[SlotMap, SlotMap, SlotMap]:
    """The first map, the one grown by a shard, and the first edited after the bytes that ``documents`` have in each slot; each written to a map store in the shared folder and read back."""
    spark, store = documents.sparkSession, new_path(documents.sparkSession, "slot-maps")
    first = SlotMap.initial(n_shards)
    sizes = {r["virtual_slot"]: r["bytes"] for r in slot_sizes(documents, key_col, text_col).collect()}  # a row per slot
    even = first.rebalance(sizes)
    for name, x in (("first", first), ("grown", first.grow()), ("even", even)):
        x.save(spark, f"{store}/{name}")
    out = [SlotMap.load(spark, f"{store}/{name}", version) for name, version in (("first", first.version), ("grown", first.version + 1), ("even", even.version))]
    remove(spark, store)
    return tuple(out)


def report(documents: DataFrame, n_shards: int = 40) -> DataFrame:
    """The columns that query op5 returns, under the law ``key``; beside them the virtual slot, and the shard under a map that was rebalanced after the measured bytes per slot.

    ``slot`` is the row's position in its shard: equal rows are folded
    first, each part of a virtual slot is numbered on its own, and a table of
    counts per part, of at most SLOTS * PARTS rows, gives where each begins.
    """
    first, grown, even = stored_maps(documents, n_shards)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = documents.select("doc_id", record_size(F.col("text")).alias("size"), crc.alias("text_crc32"))
    each = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    each = assign(each, "doc_id", first, grown).withColumn("balanced_shard", even.shard_of(F.col("virtual_slot"))).withColumn("part", F.pmod(F.col("text_crc32"), F.lit(PARTS)).cast("int"))
    counts = each.groupBy("shard", "virtual_slot", "part").agg(F.sum("copies").alias("rows"))
    order = ["virtual_slot", "part"]
    before = Window.partitionBy("shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(*order, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy(*order).orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("earlier", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(F.broadcast(begins), order)
    start = F.col("begin") + F.col("earlier")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(start, start + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
        "virtual_slot",
        "balanced_shard",
    )
