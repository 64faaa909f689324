"""Operator 3: sharding by a hierarchical weighted hash tree.

Every document descends region, rack and shard.  At each level every child
draws ``-ln(u) / weight`` with ``u`` a hash of (key, child name); the least draw
wins.  A child's draw does not depend on its siblings, so when a weight
changes, a key moves only into (weight up) or out of (weight down) the changed
subtree; subtrees whose weights stay the same exchange nothing.

Shards are added as a region of their own (:meth:`Topology.grown`): the only
changed subtree at the root is the new one, so a grown topology takes rows only
into the new shard (law ``key``).

Cases: a null id is one key like any other; repeated rows share a shard and get
slots of their own; null text has size 1 and a null-text crc32 of 0 (as the empty
text); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.tables import table


@dataclass(frozen=True)
class Topology:
    """regions[i][j][k] is the weight of shard k of rack j of region i; shards number in this order."""

    regions: tuple

    @staticmethod
    def regular(n: int, per_rack: int = 2, per_region: int = 2) -> Topology:
        """``n`` shards of weight 1, filled rack by rack and region by region."""
        racks = [tuple(1.0 for _ in range(min(per_rack, n - i))) for i in range(0, n, per_rack)]
        return Topology(tuple(tuple(racks[i: i + per_region]) for i in range(0, len(racks), per_region)))

    def grown(self, weight: float = 1.0) -> Topology:
        """One more shard, in a region and rack of its own."""
        return Topology((*self.regions, ((weight,),)))

    def levels(self):
        """Children with their weight: of the root, of each region, of each rack (shards as leaf numbers)."""
        root, racks, shards, leaf = [], {}, {}, 0
        for i, region in enumerate(self.regions):
            rname = f"region{i}"
            root.append((rname, sum(map(sum, region))))
            for j, rack in enumerate(region):
                kname = f"{rname}/rack{j}"
                racks.setdefault(rname, []).append((kname, sum(rack)))
                for k, w in enumerate(rack):
                    shards.setdefault(kname, []).append((f"{kname}/shard{k}", w, leaf))
                    leaf += 1
        return root, racks, shards


def _draw(key: Column, child: Column) -> Column:
    """Least wins; u lies strictly between 0 and 1, and equal draws fall to the smaller name."""
    u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
    return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"), child["leaf"].alias("leaf"))


def _children(items) -> Column:
    return F.array(*[F.struct(F.lit(x[0]).alias("name"), F.lit(float(x[1])).alias("weight"),
                              F.lit(x[2] if len(x) > 2 else -1).alias("leaf")) for x in items if x[1] > 0])


def _pick(key: Column, children: Column) -> Column:
    return F.array_min(F.transform(children, lambda c: _draw(key, c)))


def place(key: Column, topology: Topology) -> Column:
    """Shard number of ``key`` (a string column without nulls)."""
    root, racks, shards = topology.levels()
    live = lambda d: {k: v for k, v in d.items() if any(x[1] > 0 for x in v)}

    def table_of(d):
        return F.create_map(*[x for k, v in live(d).items() for x in (F.lit(k), _children(v))])

    region = _pick(key, _children(root))["name"]
    rack = _pick(key, F.element_at(table_of(racks), region))["name"]
    return _pick(key, F.element_at(table_of(shards), rack))["leaf"].cast("int")


def shard_documents(df: DataFrame, topology: Topology, rows_per_bucket: int = 50_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, and a gapless slot inside it, of every row.

    Slots number buckets of a shard one after the other (bucket: a hash of the
    id), so numbering a shard takes many tasks; only the counts by bucket meet."""
    n_shards = sum(len(rack) for region in topology.regions for rack in region)
    n_buckets = max(1, math.ceil(df.count() / (n_shards * rows_per_bucket)))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("\0null"))
    base = df.select(F.col(id_col).alias("doc_id"), key.alias("_key"),
                     (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
                     F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    base = (base.withColumn("shard", place(F.col("_key"), topology))
                .withColumn("_bucket", F.pmod(F.xxhash64(F.lit("slot"), "_key"), F.lit(n_buckets))))
    counts = base.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    return (base.withColumn("_row", F.row_number().over(inside) - 1)
                .join(offsets, ["shard", "_bucket"])
                .withColumn("slot", (F.col("_off") + F.col("_row")).cast("long")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    topology = Topology.regular(16)
    out = shard_documents(table(spark, sf_dir, "documents"), topology)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      place(F.col("_key"), topology.grown()).alias("grown_shard"))
