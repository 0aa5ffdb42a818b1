"""SimHash near-duplicates by pigeonhole blocks (operator 2).

A fingerprint's 64 bits are cut into blocks. Two fingerprints that differ in at most four bits differ in at most four blocks,
so at least two of six blocks are equal: with one key for each of the 15 pairs of blocks, every close pair shares a key. Larger
tables take seven blocks and keys of three, or eight and keys of four, so that keys grow with the table and buckets don't. Equal
fingerprints are first merged; members of a key are verified by Hamming distance, and each bucket gives only the edges of a spanning
forest, never all its pairs. A bucket of more than ``CHUNK`` fingerprints is split into chunks and every pair of chunks verified
by a task of its own, so no task holds more than ``2 * CHUNK`` fingerprints.

``drop_near_duplicates`` looks for similarity instead: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or
more. Their fingerprints have 1024 bits over the different shingles of a text. Pairs that share two of six blocks in one of the first
``BLOCKED`` words of 64 bits are verified by the Hamming distance of the first ``CHECKED`` words, then of all. What differs in so few
bits that the similarity is certain is linked; for pairs near the limit the sets themselves decide. So no link is below 0.8. Forests of a bucket's pairs come first,
then all pairs of what they leave apart; the blocks find most pairs above 0.8, not all: README has the measured recall.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other; fewer words than a shingle
give one shingle of all words; rows that repeat a doc_id are one node, of which every fingerprint links; rows without a doc_id
link like any other, and have a null component where no row of theirs has a doc_id (below 2**62); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, partitions, small_batches, spare, table
from .components import FILE_ROWS, Forest as Forest, components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: For similarity: words of a shingle, 64-bit words of a fingerprint, how many of them give keys and how many are checked in a bucket.
SIMILAR_SHINGLE, WIDE, BLOCKED, CHECKED = 5, 16, 6, 4
#: Bits in which pairs may differ in a bucket and in all words, and up to which they are similar without doubt. Sets with a similarity
#: of 0.8 have an angle with a cosine of 8/9, so they differ in 0.1515 of the bits: 39 of 256 and 155 of 1024, with deviations of 6 and 11.5.
CHECKED_BITS, WIDE_BITS, SURE_BITS = 51, 190, 110
#: Fingerprints in a table from which on it takes one block more.
MORE_BLOCKS = (1 << 24, 1 << 30)
CHUNK, SMALL = 4096, 24
#: Pairs of a bucket that a task holds at a time.
PAIRS = 1 << 20
#: Fingerprints a task multiplies by their keys.
SPREAD_ROWS = 1 << 16
#: Fingerprints of rows without a doc_id go by numbers from here on.
NO_ID = 2**62
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None, shingle: int, seed: int) -> np.ndarray:
    """Unsigned hashes of all shingles of a whole text, repeats included."""
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    digest = xxhash.xxh64_intdigest
    k = min(shingle, len(words))
    return np.fromiter((digest(line[a : b - 1], seed) for a, b in zip(starts[:n], starts[k:], strict=True)), np.uint64, n)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text; shingles weigh as often as they occur."""
    hashes = shingle_hashes(text, shingle, seed)
    return majority(hashes) if len(hashes) else 0


def wide_fingerprint(text: str | None, shingle: int = SIMILAR_SHINGLE, seed: int = SEED, words: int = WIDE) -> np.ndarray:
    """SimHash of 64 * ``words`` bits over the different shingles of a whole text, as unsigned 64-bit words."""
    hashes = np.unique(shingle_hashes(text, shingle, seed))
    ones = np.zeros(64 * words, np.int64)
    steps = np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(hashes), 255):  # so that a byte counts a block
        h = hashes[i : i + 255, None] + steps
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits that are 1 in over half of the hashes; counted in blocks of bounded size."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def wide_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, w0 .. w15) as signed longs, the hash of the whole text; one pass over the texts (doc_id, text)."""
    names = [f"w{i}" for i in range(WIDE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([wide_fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).reshape(-1, WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], ["doc_id", "hash", *names])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    return rows.mapInArrow(run, "doc_id long, hash long, " + ", ".join(f"{n} long" for n in names))


def blocks(n: int) -> list[tuple[int, int]]:
    """First bit and width of ``n`` blocks of 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def block_keys(n: int = 6, bits: int = MAX_BITS, word: str | Column = "fp") -> list[Column]:
    """One key per choice of the ``n - bits`` blocks that a close pair shares at least: the choice's number above the bits of its blocks."""
    out = []
    for i, chosen in enumerate(combinations(blocks(n), n - bits)):
        key, at = F.lit(i << 40).cast("long"), 0
        for start, width in chosen:
            key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned(word, start).bitwiseAND((1 << width) - 1), at))
            at += width
        out.append(key)
    return out


def bucket_edges(fps: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Spanning-forest edges (local indices) of the links within one bucket, by breadth-first search over unvisited members.

    ``fps``: one row per word of the fingerprints. Each member is compared once with those not yet reached, so a bucket of close copies takes few steps.
    """
    out, rest = [], np.arange(fps.shape[1])
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = _far(fps[:, rest], fps[:, x : x + 1]) <= bits
            if near.any():
                hit = rest[near]
                out += [(int(x), int(y)) for y in hit]
                front += list(hit)
                rest = rest[~near]
    return out


def bucket_pairs(fps: np.ndarray, group: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All close pairs (local indices) of different groups within one bucket, some at a time; the largest group is not compared with itself."""
    kinds, of, sizes = np.unique(group, return_inverse=True, return_counts=True)
    order = np.argsort(of == np.argmax(sizes), kind="stable")
    fps, of, held, n = fps[:, order], of[order], [], 0
    for i in range(len(order) - int(sizes.max())):
        near = np.flatnonzero((_far(fps[:, i + 1 :], fps[:, i : i + 1]) <= bits) & (of[i + 1 :] != of[i])) + i + 1
        if len(near):
            held.append((np.full(len(near), order[i]), order[near]))
            n += len(near)
        if n >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints with one row per word."""
    return np.bitwise_count(a ^ b).sum(axis=0, dtype=np.int32)


def links(prints: DataFrame, keys: Column, words: tuple[str, ...] = ("fp",), bits: int = MAX_BITS, files: int = 1, whole: bool = False) -> DataFrame:
    """Edges (u, v) between representatives ``rep`` of distinct fingerprints (rep, ``words``) that together connect all pairs that share a key and are close.

    With a column ``group``, only edges between different groups. ``whole``: all such pairs, for those who may reject some of them; a forest
    holds one way to each fingerprint, which a rejected edge would cut. Then rows are (u, v, key, part), as :func:`_pairs_or_members` has them.
    """
    group = F.col("group") if "group" in prints.columns else F.col("rep")
    keyed = prints.select("rep", group.alias("group"), *words, F.explode(keys).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > CHUNK).select(F.col("key"), F.ceil(F.col("count") / CHUNK).cast("int").alias("parts"))
    hot = materialise(hot.coalesce(files), "hot-keys")  # at most one for CHUNK keys of fingerprints
    marked = keyed.join(hot, "key", "left")
    mine = F.pmod(F.xxhash64(*words), F.col("parts")).cast("int")
    spread = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(mine, j) * F.col("parts") + F.greatest(mine, j))
    )
    dealt = marked.select("rep", "key", F.explode(spread).alias("part"), "group", *words)
    sorted_ = dealt.repartition("key", "part").sortWithinPartitions("key", "part", "rep")

    if whole:
        return sorted_.mapInArrow(lambda batches: _by_bucket(batches, lambda x: _pairs_or_members(x, bits)), "u long, v long, key long, part int")
    return sorted_.mapInArrow(lambda batches: _by_bucket(batches, lambda x: _edges_of(x, bits)), "u long, v long")


def _by_bucket(batches: Iterator[pa.RecordBatch], edges: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """``edges`` of rows (rep, key, part, ...) that are sorted by bucket (key, part), always given whole buckets."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
        last = (held[1] == held[1][-1]) & (held[2] == held[2][-1])
        cut = int(np.argmax(last))  # sorted, so the last bucket begins at its first row
        if cut:
            yield from edges([x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held:
        yield from edges(held)


def all_links(prints: DataFrame, keys: Column, files: int) -> tuple[DataFrame, DataFrame]:
    """All pairs of different groups that share a key and may be similar, of representatives (rep, group, w0 .. w15): candidates (u, v) and (u, v, far).

    A bucket with more pairs than members in them gives those members instead, and these are compared by all words of their
    fingerprints: pairs near the limit in a large group of near copies become rows only where all words say that they are close.
    """
    names = [f"w{i}" for i in range(WIDE)]
    near = materialise(links(prints.select("rep", "group", *names[:BLOCKED]), keys, tuple(names[:CHECKED]), CHECKED_BITS, files, True), "pairs")
    crowded = near.filter("v is null").select(F.col("u").alias("rep"), "key", "part")
    dealt = crowded.join(prints, "rep").select("rep", "key", "part", "group", *names).repartition("key", "part").sortWithinPartitions("key", "part", "rep")
    return near.filter("v is not null").select("u", "v"), dealt.mapInArrow(lambda batches: _by_bucket(batches, _close_of), "u long, v long, far int").distinct()


def _close_of(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(u, v, far) with u < v for all pairs of whole buckets that are close by all words."""
    rep, key, part, group = columns[:4]
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
    for s, e in zip(starts, np.r_[starts[1:], len(key)], strict=True):
        fps, own = np.array([c[s:e] for c in columns[4:]]).view(np.uint64), rep[s:e]
        for i, j in bucket_pairs(fps, group[s:e], WIDE_BITS):
            ends, far = (np.minimum(own[i], own[j]), np.maximum(own[i], own[j])), _far(fps[:, i], fps[:, j])
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in ends), pa.array(far, pa.int32())], ["u", "v", "far"])


def _pairs_or_members(columns: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """(u, v, null, null) for the pairs of whole buckets, or (rep, null, key, part) for the members in them where these are fewer."""
    rep, key, part = columns[:3]
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
    sizes = np.diff(np.r_[starts, len(key)])
    large = np.repeat(sizes > SMALL, sizes)
    for batch in _edges_of([x[~large] for x in columns], bits) if not large.all() else ():
        yield _pairs(batch.column(0), batch.column(1))
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        own = slice(s, s + n)
        held, found, paired = [], 0, np.zeros(n, bool)
        for i, j in bucket_pairs(np.array([c[own] for c in columns[4:]]).view(np.uint64), columns[3][own], bits):
            paired[i] = paired[j] = True
            found += len(i)
            held = [*held, (i, j)] if found <= n else []
        if found > paired.sum():
            members = pa.array(rep[own][paired], pa.int64())
            k = len(members)
            yield pa.RecordBatch.from_arrays([members, pa.nulls(k, pa.int64()), pa.array(np.full(k, key[s]), pa.int64()), pa.array(np.full(k, part[s]), pa.int32())], ["u", "v", "key", "part"])
        else:
            for i, j in held:
                yield _pairs(pa.array(rep[own][i], pa.int64()), pa.array(rep[own][j], pa.int64()))


def _pairs(u: pa.Array, v: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([u, v, pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.int32())], ["u", "v", "key", "part"])


def _edges_of(columns: list[np.ndarray], bits: int, whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Edges of whole buckets, which stand one after another: small ones by shifted comparison, others one by one, by a forest or (``whole``) all pairs."""
    rep, key, part, group = columns[:4]
    fp = np.array(columns[4:]).view(np.uint64)
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
    sizes = np.diff(np.r_[starts, len(key)])
    size_of = np.repeat(sizes, sizes)
    bucket = np.repeat(np.arange(len(starts)), sizes)
    us, vs = [], []
    small = np.flatnonzero(size_of <= SMALL)
    for shift in range(1, min(SMALL, int(sizes[sizes <= SMALL].max(initial=1)))):
        i, j = small[:-shift], small[shift:]
        keep = bucket[i] == bucket[j]
        i, j = i[keep], j[keep]
        near = (_far(fp[:, i], fp[:, j]) <= bits) & (group[i] != group[j])
        us.append(rep[i[near]])
        vs.append(rep[j[near]])
    for s in np.flatnonzero(sizes > SMALL):
        own = slice(starts[s], starts[s] + sizes[s])
        if whole:
            for i, j in bucket_pairs(fp[:, own], group[own], bits):
                yield _edges(rep[own][i], rep[own][j])
        elif found := bucket_edges(fp[:, own], bits):
            i, j = np.array(found).T
            apart = group[own][i] != group[own][j]
            us.append(rep[own][i[apart]])
            vs.append(rep[own][j[apart]])
    u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, vs))
    yield _edges(u, v)


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Deal a small table to enough tasks that multiplying its rows is shared."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, rows // SPREAD_ROWS), key)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, bits: int = MAX_BITS, n_blocks: int | None = None) -> DataFrame:
    """doc_id, fp (signed long), component_id for every row of ``docs`` (doc_id, text); ``n_blocks``: by the table's size unless given."""
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    n = prints.count()
    files = 1 + n // FILE_ROWS  # small tables get few files
    rep = F.coalesce(F.min("doc_id"), F.shiftrightunsigned("fp", 2) + F.lit(NO_ID)).alias("rep")
    distinct = materialise(prints.groupBy("fp").agg(rep).coalesce(files), "distinct-fingerprints")
    n_blocks = n_blocks or bits + 2 + sum(n >= m for m in MORE_BLOCKS)
    roots = components(links(_spread(distinct, n, "fp"), F.array(*block_keys(n_blocks, bits)), bits=bits, files=files), files)
    classes = distinct.join(roots, distinct.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    classes = classes.withColumn("component_id", F.expr(f"if(component_id < {NO_ID}, component_id, null)"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(rep, shingles) with the different hashes of each text's shingles, of rows (rep, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(t, SIMILAR_SHINGLE, SEED)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["rep", "shingles"])

    return rows.mapInArrow(run, "rep long, shingles array<long>")


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, group) of every row of ``docs`` (doc_id, text): rows that similar texts connect have the same number as group."""
    names = [f"w{i}" for i in range(WIDE)]
    prints = materialise(wide_fingerprints(docs), "wide-fingerprints")
    n, files = prints.count(), partitions(docs)
    # a fingerprint goes by its smallest doc_id; by a number below all those where it has none or shares it with another fingerprint
    distinct = prints.groupBy(names).agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("hash"))).alias("row")).select("row.doc_id", "row.hash", *names)
    alone = F.count("*").over(Window.partitionBy("doc_id")) == 1
    own = F.when(F.col("doc_id").isNotNull() & alone, F.col("doc_id")).otherwise(F.shiftrightunsigned(F.xxhash64(*names), 2) + F.lit(-(2**63)))
    distinct = materialise(distinct.withColumn("rep", own).coalesce(files), "distinct-fingerprints")
    # the first word's blocks connect most of a large group of close copies; the others are then searched for what they connect beyond that.
    # A forest's edges may turn out not to be similar and leave texts apart that other pairs connect, so all pairs of groups still apart come last
    groups = None
    for words, whole in ((range(1), False), (range(1, BLOCKED), False), (range(BLOCKED), True)):
        known = distinct.select("rep", *names, F.col("rep").alias("group"))
        if groups is not None:
            known = materialise(known.drop("group").join(groups, known.rep == groups.node, "left").select("rep", *names, F.coalesce("root", "rep").alias("group")).coalesce(files), "known")
        # written once for all words: a plan with an expression for each word and key takes much of the driver's memory
        keys = F.flatten(F.transform(F.array(*(f"w{i}" for i in words)), lambda w, i: F.array(*(k.bitwiseOR(F.shiftleft(i.cast("long"), 48)) for k in block_keys(6, 4, w)))))
        dealt = _spread(known, n, "rep")
        found, measured = all_links(dealt, keys, files) if whole else (links(dealt, keys, tuple(names[:CHECKED]), CHECKED_BITS, files), None)
        found = found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        groups = _connected(docs, distinct, found, groups, files, measured)
    classes = distinct.join(groups, distinct.rep == groups.node, "left").select(*names, F.coalesce("root", "rep").alias("group"))
    return prints.join(classes, names).select("doc_id", "hash", "group")


def _connected(docs: DataFrame, distinct: DataFrame, found: DataFrame, groups: DataFrame | None, files: int, measured: DataFrame | None = None) -> DataFrame:
    """(node, root) of ``groups`` and those of the candidate pairs ``found`` and of ``measured`` (u, v, far) that are similar."""
    left, right = (distinct.select(F.col("rep").alias(end), F.array(*(f"w{i}" for i in range(WIDE))).alias(f"{end}_bits")) for end in "uv")
    far = F.expr("aggregate(zip_with(u_bits, v_bits, (a, b) -> bit_count(a ^ b)), 0, (s, x) -> s + x)")
    close = found.join(left, "u").join(right, "v").select("u", "v", far.alias("far")).filter(F.col("far") <= WIDE_BITS)
    if measured is not None:
        close = close.union(measured).distinct()
    close = materialise(close.coalesce(files), "close")
    sure = close.filter(F.col("far") <= SURE_BITS).select("u", "v")
    if groups is not None:
        sure = sure.union(groups.select("node", "root"))
    surely = components(sure, files)
    # what is not connected without doubt is decided by the sets
    ends = [surely.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in "uv"]
    doubtful = close.filter(F.col("far") > SURE_BITS).join(ends[0], "u", "left").join(ends[1], "v", "left")
    doubtful = doubtful.select("u", "v", F.coalesce("u_root", "u").alias("u_root"), F.coalesce("v_root", "v").alias("v_root")).filter("u_root <> v_root")
    doubtful = materialise(doubtful.coalesce(files), "doubtful")
    nodes = doubtful.select("u").union(doubtful.select("v")).distinct().withColumnRenamed("u", "rep").join(distinct.select("rep", F.col("doc_id").alias("id"), "hash"), "rep")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    sets = shingle_sets(docs.select("doc_id", "text").join(nodes, same).select("rep", "text")).groupBy("rep").agg(F.first("shingles").alias("shingles"))
    sets = materialise(sets.coalesce(files), "shingle-sets")
    left, right = (sets.select(F.col("rep").alias(end), F.col("shingles").alias(f"{end}_set")) for end in "uv")
    both = F.size(F.array_intersect("u_set", "v_set"))
    decided = doubtful.join(left, "u").join(right, "v").filter(5 * both >= 4 * (F.size("u_set") + F.size("v_set") - both))
    return components(surely.select(F.col("node").alias("u"), F.col("root").alias("v")).union(decided.select("u", "v")), files)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group of similar texts, the one with the smallest doc_id, with all its columns.

    Rows with the same doc_id and text leave one row. Rows with the same doc_id and different texts are documents of their own; so are
    rows without a doc_id, which stay only where no row of their group has one. Texts without words are alike.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("hash"))).alias("first")
    kept, hashed, place = spare(docs, "_kept"), spare(docs, "_hashed"), spare(docs, "_place")
    keep = similar_groups(docs).groupBy("group").agg(first).select(F.coalesce("first.doc_id", F.lit(-(2**63))).alias(kept), F.col("first.hash").alias(hashed))
    rows = docs.withColumn(kept, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn(hashed, F.xxhash64("text"))
    rest = rows.join(keep, [kept, hashed], "left_semi")
    one = F.row_number().over(Window.partitionBy(kept, hashed).orderBy(F.col(hashed)))
    return rest.withColumn(place, one).filter(F.col(place) == 1).drop(place, kept, hashed).coalesce(partitions(docs))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
