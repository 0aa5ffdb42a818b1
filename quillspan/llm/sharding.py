"""Consistent-hash ring with virtual nodes and bounded loads (operator 9), in DataFrame operations only.

Keys are hashes of the text, so equal texts stand at one place of the ring. Every shard owns ``vnodes`` arcs. A shard
takes at most its share of the rows (shares differ by one); an arc's rows beyond that continue clockwise to the next
shard with room. Capacities add up to the number of rows, so the law ``rows`` holds exactly, and only rows of
overfull shards stand elsewhere than at home.

Only counts per arc and salt reach the driver: at most ``shards * vnodes * SALTS`` integers, whatever the number of rows.
A row's place within its arc is (offset of its salt) + (rank within its salt), so a group of equal texts that holds a
third of all rows is ranked in ``SALTS`` parts.

Defined results: a null text has size 1 and crc32 0 and is placed like the empty text; repeated rows are
placed one by one; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import local_rows, table

SHARDS, VNODES, SALTS, SEED = 8, 64, 64, "ring-1"


def ring(shards: int, vnodes: int, seed: str = SEED) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise; places are 32-bit."""
    from hashlib import blake2b

    at = lambda s, v: int.from_bytes(blake2b(f"{seed}/{s}/{v}".encode(), digest_size=4).digest(), "big")
    return sorted({at(s, v): s for s in range(shards) for v in range(vnodes)}.items())


def place_arcs(counts: dict[int, int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Split each arc's rows over shards: (arc, first rank, rows, shard, first slot).

    Arcs offer their rows to their own shard first; what is left moves on, round by round, to the next arc's shard.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, out = [0] * shards, []
    left = {a: n for a, n in sorted(counts.items()) if n}
    done: dict[int, int] = defaultdict(int)
    for step in range(len(owners)):
        for arc in list(left):
            shard = owners[(arc + step) % len(owners)]
            take = min(left[arc], room[shard] - used[shard])
            if take:
                out.append((arc, done[arc], take, shard, used[shard]))
                used[shard] += take
                done[arc] += take
                left[arc] -= take
                if not left[arc]:
                    del left[arc]
        if not left:
            break
    return out


def shard_rows(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, salts: int = SALTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    nodes = ring(shards, vnodes)
    places, owners = [p for p, _ in nodes], [s for _, s in nodes]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )
    place = F.shiftrightunsigned(F.col("key"), 32)
    # the arc is the first node at or after the key's place; beyond the last node the ring begins again
    arc = F.expr(_search("place", places))
    salt = F.pmod(F.xxhash64("doc_id", "key"), F.lit(salts)).cast("int")
    arcs = keyed.withColumn("place", place).withColumn("arc", arc).withColumn("salt", salt).drop("place")
    found = {(r.arc, r.salt): r.n for r in arcs.groupBy("arc", "salt").agg(F.count("*").alias("n")).collect()}  # bounded: see above
    per_arc: dict[int, int] = defaultdict(int)
    offsets = []
    for (a, s), n in sorted(found.items()):
        offsets.append((a, s, per_arc[a]))
        per_arc[a] += n
    pieces = place_arcs(per_arc, owners, shards)
    starts: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for a, first, n, shard, slot in pieces:
        starts[a].append((first, shard, slot - first))
    columns = {"arc": "int", "salt": "int", "offset": "long", "firsts": "array<long>", "homes": "array<int>", "shifts": "array<long>"}
    rows = [(a, s, offset, *([x[i] for x in starts[a]] for i in range(3))) for a, s, offset in offsets]
    plan = local_rows(spark, rows, columns)
    ranked = arcs.withColumn("in_salt", F.row_number().over(Window.partitionBy("arc", "salt").orderBy("key", "doc_id", "size", "text_crc32")))
    joined = ranked.join(F.broadcast(plan), ["arc", "salt"]).withColumn("rank", F.col("offset") + F.col("in_salt") - 1)
    joined = joined.withColumn("piece", F.size(F.filter("firsts", lambda x: x <= F.col("rank"))))
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.element_at("homes", F.col("piece")).alias("shard"),
        (F.element_at("shifts", F.col("piece")) + F.col("rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _search(name: str, places: list[int], low: int = 0, high: int | None = None) -> str:
    """A binary search over the places as nested SQL conditions: the index of the first place not below ``name``."""
    high = len(places) if high is None else high
    if low == high:
        return str(low % len(places))
    mid = (low + high) // 2
    return f"if({name} <= {places[mid]}L, {_search(name, places, low, mid)}, {_search(name, places, mid + 1, high)})"


def arc_of(place: int, places: list[int]) -> int:
    return bisect.bisect_left(places, place) % len(places)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))
