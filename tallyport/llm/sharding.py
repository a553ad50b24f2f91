"""Sharding by fixed virtual slots.

Every record is hashed into one of thousands of virtual slots, whose number never changes. Bytes are summed by slot,
and a versioned slot-to-shard map says where each slot lives. Rebalancing or adding a shard edits the map (and so
moves whole slots); records are never hashed anew.

The map is a table with a row for each version and slot. A run at a path that holds a map loads its latest version and
edits that: slots move only where the shards' bytes have drifted apart, and a run that moves nothing adds no version.

Defined results: a null text has no bytes (size 1) and crc32 0; a null doc_id is hashed like any other value; within a
slot rows are in order of doc_id (null last), crc32, size and a hash of all columns that are kept, so only rows that are
alike throughout may change places; rows that repeat share a slot and take different places in their shard; input
columns with names of the result are kept as input_<name>; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import insort
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm.common import fresh_path, row_hash, table

SLOTS = 4096
#: Each slot is numbered in this many independent parts, so that no task has to order a whole slot.
PARTS = 16
SHARDS = 16
#: Rebalancing ends when the fullest and the emptiest shard differ by at most this part of the mean.
NEAR = 5000
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version")


@dataclass
class SlotMap:
    """Shard of each virtual slot, with the version that an edit raises."""

    shards: int
    shard_of: list[int]
    version: int = 1
    bytes_of: list[int] = field(default_factory=list)

    @classmethod
    def initial(cls, slots: int, shards: int) -> SlotMap:
        return cls(shards, [slot % shards for slot in range(slots)], 1, [0] * slots)

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += self.bytes_of[slot]
        return out

    def rebalanced(self, bytes_of: list[int]) -> SlotMap:
        """Next version: slots go from the fullest to the emptiest shard while that narrows their difference."""
        out = SlotMap(self.shards, list(self.shard_of), self.version + 1, list(bytes_of))
        held: list[list[tuple[int, int]]] = [[] for _ in range(out.shards)]
        for slot, shard in enumerate(out.shard_of):
            if bytes_of[slot]:
                insort(held[shard], (bytes_of[slot], slot))
        load = out.loads()
        enough = sum(load) // (NEAR * out.shards)
        for _ in range(len(out.shard_of)):
            full = max(range(out.shards), key=lambda s: (load[s], -s))
            empty = min(range(out.shards), key=lambda s: (load[s], s))
            gap = load[full] - load[empty]
            if gap <= enough:
                break
            moved = out._move(held, full, empty, gap) or out._swap(held, full, empty, gap)
            if not moved:
                break
            load[full] -= moved
            load[empty] += moved
        return out

    def _move(self, held: list[list[tuple[int, int]]], full: int, empty: int, gap: int) -> int:
        """Move the slot nearest to half the gap; bytes moved, 0 if none narrows it."""
        best = min((x for x in held[full] if x[0] < gap), key=lambda x: (abs(2 * x[0] - gap), x[1]), default=None)
        if best is None:
            return 0
        held[full].remove(best)
        insort(held[empty], best)
        self.shard_of[best[1]] = empty
        return best[0]

    def _swap(self, held: list[list[tuple[int, int]]], full: int, empty: int, gap: int) -> int:
        """Swap a larger slot of the full shard for a smaller one of the empty shard; net bytes moved."""
        best: tuple[int, tuple[int, int], tuple[int, int]] | None = None
        for a in held[full]:
            for b in held[empty]:
                net = a[0] - b[0]
                if 0 < net < gap and (best is None or abs(2 * net - gap) < abs(2 * best[0] - gap)):
                    best = (net, a, b)
        if best is None:
            return 0
        net, a, b = best
        held[full].remove(a)
        held[empty].remove(b)
        insort(held[empty], a)
        insort(held[full], b)
        self.shard_of[a[1]], self.shard_of[b[1]] = empty, full
        return net

    def grown(self) -> SlotMap:
        """Next version with one more shard: each old shard gives up its last slots, no slot moves between old ones."""
        out = SlotMap(self.shards + 1, list(self.shard_of), self.version + 1, list(self.bytes_of))
        share = len(self.shard_of) // (self.shards + 1)
        for shard in range(self.shards):
            own = [slot for slot, at in enumerate(self.shard_of) if at == shard]
            give = share // self.shards + (shard < share % self.shards)
            for slot in own[max(0, len(own) - give) :]:
                out.shard_of[slot] = self.shards
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, slot, shard, self.bytes_of[slot]) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "map_version int, shards int, virtual_slot int, shard int, slot_bytes long").coalesce(1)

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the map's table; earlier versions stay readable. A version is stored once: one that is
        there must have the same rows."""
        known = self.stored(spark, path)
        if known is not None and known.version >= self.version:
            if self.load(spark, path, self.version) != self:
                raise ValueError(f"version {self.version} of the map at {path} is another one")
            return
        # A run that failed midway may have left a part of this version.
        self.frame(spark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("map_version").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, by default the latest. The table has a row for each slot and version only."""
        found = spark.read.parquet(path)
        version = version or found.agg(F.max("map_version")).first()[0]
        rows = found.where(F.col("map_version") == version).orderBy("virtual_slot").collect()
        if not rows:
            raise LookupError(f"the map at {path} has no version {version}")
        return cls(rows[0].shards, [row.shard for row in rows], version, [row.slot_bytes for row in rows])

    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> SlotMap | None:
        """The latest version at `path`, or None where no map is."""
        try:
            return cls.load(spark, path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def edited(self, bytes_of: list[int], shards: int) -> SlotMap:
        """The map for these bytes by slot and that many shards: new shards are added one by one, then slots move. This
        very map if nothing has to."""
        if shards < self.shards:
            raise ValueError(f"the map has {self.shards} shards; slots of a shard that goes have to be moved by hand")
        out = self
        while out.shards < shards:
            out = out.grown()
        out = out.rebalanced(bytes_of)
        return self if (out.shards, out.shard_of, out.bytes_of) == (self.shards, self.shard_of, self.bytes_of) else SlotMap(out.shards, out.shard_of, self.version + 1, out.bytes_of)


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard(df: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (all by default) with size, text_crc32, law, shard, slot (place in the shard), grown_shard,
    virtual_slot and map_version. The slot map is kept at `path`: the one found there is edited, else one is made."""
    spark = df.sparkSession
    keep = df.columns if keep is None else keep
    names = {c: c for c in keep}
    for c in keep:
        while names[c] in RESULT or [*names.values()].count(names[c]) > 1:
            names[c] = f"input_{names[c]}"
    text = F.col(f"`{text_col}`")
    hashed = F.xxhash64(F.col(f"`{id_col}`"), F.crc32(text))
    marked = df.select(
        F.struct(*(F.col(f"`{c}`").alias(names[c]) for c in keep)).alias("_kept"),
        row_hash(df, keep).alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        text_size(text).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot"),
        F.pmod(F.shiftright(hashed, 32), F.lit(PARTS)).cast("int").alias("_part"),
    )
    counts = marked.groupBy("virtual_slot", "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_bytes")).collect()
    bytes_of = [0] * slots
    for row in counts:
        bytes_of[row.virtual_slot] += row._bytes
    known = SlotMap.stored(spark, path)
    if known is None:
        known = SlotMap.initial(slots, shards)
        known.save(spark, path)
    if len(known.shard_of) != slots:
        raise ValueError(f"the map at {path} has {len(known.shard_of)} slots, whose number never changes")
    slot_map = known.edited(bytes_of, shards)
    slot_map.save(spark, path)
    # Where each part of a slot begins in its shard: slots * PARTS rows at most, whatever the input.
    begins, at = [], [0] * shards
    for row in sorted(counts, key=lambda r: (r.virtual_slot, r._part)):
        to = slot_map.shard_of[row.virtual_slot]
        begins.append((row.virtual_slot, row._part, to, at[to]))
        at[to] += row._n
    placed = spark.createDataFrame(begins, "virtual_slot int, _part int, shard int, _begin long")
    order = Window.partitionBy("virtual_slot", "_part").orderBy(F.col("_id").asc_nulls_last(), "text_crc32", "size", "_row")
    return (
        marked.withColumn("_nth", F.row_number().over(order))
        .join(F.broadcast(placed), ["virtual_slot", "_part"])
        .select(
            "_kept.*",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_begin") + F.col("_nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(slot_map.version).alias("map_version"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), fresh_path(spark, "slot-map"), keep=["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the corpus pipeline: all columns of the documents, and where each row lives."""
    return shard(docs, fresh_path(spark, "slot-map"))
