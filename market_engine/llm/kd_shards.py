"""Sharding by a k-d tree over the documents' metadata, with leaves of nearly equal bytes.

A node with k leaves is cut along its widest dimension (source, language, length) at the weighted quantile that
leaves k // 2 leaves' bytes on the left. Quantiles are found together for all nodes of a level, by histograms of
bytes in 1024 bins, each pass within the bin that the last one ended in. Only the histograms, of a
size fixed by the number of shards, reach the driver. A coordinate ends in bits of the text's and the doc_id's hash,
so that cuts can pass through documents that are alike, equal texts lying side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunk_count, chunk_of, hash31, running_total, store, text_of

SHARDS = 24
OVERHEAD = 8
DIMENSIONS = ("source", "lang", "length")
TIE_BITS = 31
BINS = 1024
#: A cut may be off by this share of a leaf's bytes, unless a single coordinate weighs more.
TOLERANCE = 0.0005


@dataclass
class Tree:
    """Nodes are numbered from 1; the children of i are 2i and 2i + 1. cuts: node -> (dimension, last key on the
    left); leaves: node -> shard."""

    cuts: dict[int, tuple[str, int]] = field(default_factory=dict)
    leaves: dict[int, int] = field(default_factory=dict)

    def node(self, at: int = 1) -> Column:
        """The node a row has come down to."""
        if at not in self.cuts:
            return F.lit(at)
        dimension, last = self.cuts[at]
        return F.when(F.col(dimension) <= F.lit(last), self.node(2 * at)).otherwise(self.node(2 * at + 1))

    def shard(self, at: int = 1) -> Column:
        if at not in self.cuts:
            return F.lit(self.leaves[at])
        dimension, last = self.cuts[at]
        return F.when(F.col(dimension) <= F.lit(last), self.shard(2 * at)).otherwise(self.shard(2 * at + 1))


def coordinates(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, a key per dimension and a hash; 31 bits of coordinate, then 31 for ties."""
    text = text_of()
    raw = text.cast("binary")
    number = F.col("doc_id").cast("long")
    size = F.octet_length(text).cast("long") + OVERHEAD
    # 20 bits of the text's hash, then 11 of the document's.
    tie = F.shiftleft(F.shiftright(hash31(text), 11), 11) + F.shiftright(hash31(number, text), 20)

    def named(column: str) -> Column:
        return F.coalesce(F.shiftright(F.crc32(F.col(column).cast("string").cast("binary")), 1), F.lit(0))

    length = F.floor(F.log2(size.cast("double")) * F.lit(float(1 << 25))).cast("long")
    places = {"source": named("source"), "lang": named("lang"), "length": length}
    keys = [(F.shiftleft(place.cast("long"), TIE_BITS) + tie).alias(name) for name, place in places.items()]
    return docs.select(
        number.alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"), *keys, hash31(number, raw).alias("hash")
    )


def _per_node(values: dict[int, int], default: int = 0) -> Column:
    out = F.lit(default).cast("long")
    for node, value in values.items():
        out = F.when(F.col("_node") == node, F.lit(value).cast("long")).otherwise(out)
    return out


def grow(rows: DataFrame, shards: int = SHARDS) -> Tree:
    """The tree over stored coordinates."""
    tree = Tree()
    open_nodes, first = {1: shards}, {1: 0}
    spread: dict[str, int] = {}
    leaf = None
    while open_nodes:
        for node in [n for n, k in open_nodes.items() if k == 1]:
            tree.leaves[node] = first[node]
            del open_nodes[node]
        if not open_nodes:
            break
        stats = rows.select("size", *DIMENSIONS, tree.node().alias("_node")).groupBy("_node")
        ends = [f(F.col(d)).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)]
        found = {r["_node"]: r for r in stats.agg(F.sum("size").alias("bytes"), *ends).collect()}

        def extent(node: int, dimension: str) -> int:
            row = found[node]
            return (row[f"max_{dimension}"] >> TIE_BITS) - (row[f"min_{dimension}"] >> TIE_BITS)

        if not spread and found:
            spread = {d: max(extent(1, d), 1) for d in DIMENSIONS}
            leaf = found[1]["bytes"] / shards
        chosen, low, high, goal, before = {}, {}, {}, {}, {}
        for node, k in open_nodes.items():
            if node not in found:  # no rows: any cut will do
                tree.cuts[node] = (DIMENSIONS[0], 0)
                continue
            d = max(DIMENSIONS, key=lambda d: extent(node, d) / spread[d])
            chosen[node], low[node], high[node] = d, found[node][f"min_{d}"], found[node][f"max_{d}"]
            goal[node], before[node] = found[node]["bytes"] * (k // 2) / k, 0
        parents = rows.select("size", *DIMENSIONS, tree.node().alias("_node"))
        while chosen:
            width = {n: -(-(high[n] - low[n] + 1) // BINS) for n in chosen}
            key = F.lit(None).cast("long")
            for node, dimension in chosen.items():
                key = F.when(F.col("_node") == node, F.col(dimension)).otherwise(key)
            inside = parents.select("_node", "size", key.alias("_key")).where(
                (F.col("_key") >= _per_node(low)) & (F.col("_key") <= _per_node(high))
            )
            binned = inside.withColumn("_low", _per_node(low)).withColumn("_width", _per_node(width, 1))
            counted = binned.groupBy("_node", F.expr("(_key - _low) div _width").alias("_bin")).agg(F.sum("size").alias("bytes"))
            bins: dict[int, dict[int, int]] = {}
            for r in counted.collect():  # at most BINS rows for each node of the level
                bins.setdefault(r["_node"], {})[r["_bin"]] = r["bytes"]
            for node in list(chosen):
                total = before[node]
                for at in sorted(bins[node]):
                    if total + bins[node][at] >= goal[node]:
                        break
                    total += bins[node][at]
                start = low[node] + at * width[node]
                if width[node] == 1 or bins[node][at] <= TOLERANCE * leaf:
                    over = total + bins[node][at] - goal[node]
                    last = start + width[node] - 1 if over <= goal[node] - total else start - 1
                    tree.cuts[node] = (chosen.pop(node), last)
                else:
                    before[node], low[node] = total, start
                    high[node] = min(high[node], start + width[node] - 1)
        for node, k in list(open_nodes.items()):
            del open_nodes[node]
            open_nodes[2 * node], open_nodes[2 * node + 1] = k // 2, k - k // 2
            first[2 * node], first[2 * node + 1] = first[node], first[node] + k // 2
    return tree


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, shard, slot.

    The number of shards is given, or follows from the bytes a shard should have. size is the UTF-8 length of the text
    (NULL as empty) plus 8. NULL in source, lang or doc_id is a value of its own. slot counts the documents of a shard
    from 0. Rows alike in doc_id and text lie together and are interchangeable. An empty table gives an
    empty result; other columns play no part.
    """
    rows = store(coordinates(docs), "coordinates")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes)) if target_bytes else SHARDS
    tree = grow(rows, shards)
    chunk = chunk_of(F.col("hash"), chunk_count(rows.count()), 31)
    placed = rows.select("doc_id", "size", "text_crc32", "hash", tree.shard().alias("shard"), chunk.alias("_chunk"))
    numbered = running_total(placed, ["shard"], "_chunk", ["hash", "doc_id"], F.lit(1), "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")


def result(docs: DataFrame) -> DataFrame:
    return shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
