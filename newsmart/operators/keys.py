"""Which keys a table holds, without reading the table.

Keys lie in two tables beside the one they belong to. New ones are appended to the recent keys, a small table that is
read whole. From time to time the recent keys move to the old ones, which lie by bucket of their hash. In front of
the old keys are Bloom filters made of Spark's bitmaps, one or more bitmaps a slot of the hash: keys that these rule
out aren't there, and only the buckets of the others are read. When the filters get too full, all keys are written
anew with more slots. The same key in several places counts once, so each step can be repeated after a stop; which
tables count is noted in the ledger.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.operators.tables import by_folder, current

#: Folders of the old keys, and positions that a key sets in its bitmap of BITS bits, meant for SLOT_KEYS keys.
BUCKETS, POSITIONS, BITS, SLOT_KEYS = 32, 4, 8 * 4096, 2_700
#: Batches or rows after which recent keys become old ones.
RECENT_BATCHES, RECENT_ROWS = 64, 1 << 20
#: Keys that pass the filters and whose buckets are looked up; with more, all old keys are read.
FEW = 10_000


@dataclass
class KeyState:
    """Versions of the tables in use (0: none yet), slots of the filters, old keys; what was added since, and stopped."""

    old: int = 0
    recent: int = 1
    slots: int = 0
    old_rows: int = 0
    recent_batches: int = 0
    recent_rows: int = 0
    undone: list[str] = field(default_factory=list)

    def text(self) -> str:
        return f"{self.old} {self.recent} {self.slots} {self.old_rows}"

    @staticmethod
    def of(text: str) -> KeyState:
        return KeyState(*map(int, text.split()))


def _hash(key: str, seed: int, size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(size)).cast("bigint")


def has_bit(bits: str, position: Column) -> Column:
    """Whether the bitmap has the position."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.call_function("shiftright", byte, position.bitwiseAND(F.lit(7)).cast("int")), F.lit(2)) == 1


class KeyIndex:
    """Keys of a table whose batches are in a ledger. Null keys are not in it."""

    def __init__(self, spark: SparkSession, target: str, key: str) -> None:
        self.spark, self.target, self.key = spark, target, key

    def old_name(self, version: int) -> str:
        return f"{self.target}_keys_{version}"

    def bits_name(self, version: int) -> str:
        return f"{self.target}_key_bits_{version}"

    def recent_name(self, version: int) -> str:
        return f"{self.target}_recent_keys_{version}"

    def _counted(self, name: str, state: KeyState) -> DataFrame:
        """Keys of a table, without attempts that were taken back."""
        rows = current(self.spark, name)
        return rows.where(~F.col("load_id").isin(state.undone)) if state.undone else rows

    def not_ruled_out(self, keys: DataFrame, state: KeyState) -> DataFrame:
        """Those of the keys that a bitmap of their slot has, with their bucket."""
        there = F.lit(True)
        for i in range(POSITIONS):
            there = there & has_bit("bits", _hash(self.key, i + 1, BITS))
        asked = keys.withColumn("slot", _hash(self.key, 0, state.slots))
        bits = current(self.spark, self.bits_name(state.old))
        return asked.join(bits, "slot").where(there).select(self.key, _hash(self.key, 9, BUCKETS).cast("int").alias("bucket")).distinct()

    def known(self, source: DataFrame, state: KeyState) -> DataFrame:
        """Keys that the table holds, at least all those that the source asks for; the table itself isn't read."""
        found = source.select(self.key).where(F.lit(False))
        if self.spark.catalog.tableExists(self.recent_name(state.recent)):
            found = self._counted(self.recent_name(state.recent), state).select(self.key)
        if not state.old:
            return found
        old = self._counted(self.old_name(state.old), state)
        asked = source.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        few = self.not_ruled_out(asked, state).limit(FEW + 1).collect()
        if len(few) <= FEW:
            old = old.where(F.col("bucket").isin(sorted({r.bucket for r in few})))
        return found.unionByName(old.select(self.key))

    def add(self, rows: DataFrame, state: KeyState) -> None:
        """Notes the keys of rows (key, load_id) that are about to be part of the table."""
        keys = rows.where(F.col(self.key).isNotNull()).select(self.key, "load_id")
        keys.write.format("parquet").mode("append").saveAsTable(self.recent_name(state.recent))

    def is_crowded(self, state: KeyState) -> bool:
        return state.recent_batches >= RECENT_BATCHES or state.recent_rows >= RECENT_ROWS

    def flush(self, state: KeyState) -> KeyState:
        """Makes the recent keys old ones: appended, or with all others written anew where the filters would be too full.

        Without recent keys, as right after a batch moved them, nothing moves.
        """
        if not self.spark.catalog.tableExists(self.recent_name(state.recent)):
            return KeyState(state.old, state.recent, state.slots, state.old_rows)
        recent = self._counted(self.recent_name(state.recent), state)
        rows = state.old_rows + state.recent_rows
        after = KeyState(state.old, state.recent + 1, state.slots, rows)
        if state.old and rows <= state.slots * SLOT_KEYS:
            self._write_old(recent, after, "append")
            return after
        if state.old:
            columns = [self.key, "load_id"]
            recent = recent.select(columns).unionByName(self._counted(self.old_name(state.old), state).select(columns))
        after.old, after.slots = state.old + 1, max(16, 1 << (2 * rows // SLOT_KEYS).bit_length())
        self._write_old(recent, after, "overwrite")
        return after

    def _write_old(self, rows: DataFrame, state: KeyState, mode: str) -> None:
        rows = rows.select(self.key, "load_id", _hash(self.key, 9, BUCKETS).cast("int").alias("bucket"))
        # filters first: keys that no filter knows would count as absent
        positions = F.explode(F.array(*[_hash(self.key, i + 1, BITS) for i in range(POSITIONS)]))
        marks = rows.select(_hash(self.key, 0, state.slots).alias("slot"), positions.alias("position"))
        bits = marks.groupBy("slot").agg(F.bitmap_construct_agg("position").alias("bits"))
        bits.write.format("parquet").mode(mode).saveAsTable(self.bits_name(state.old))
        dealt = by_folder(rows, "bucket").sortWithinPartitions("bucket", self.key)
        dealt.write.format("parquet").mode(mode).partitionBy("bucket").saveAsTable(self.old_name(state.old))

    def drop_replaced(self, before: KeyState, after: KeyState) -> None:
        names = [self.recent_name(before.recent)] if after.recent != before.recent else []
        if before.old and after.old != before.old:
            names += [self.old_name(before.old), self.bits_name(before.old)]
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
