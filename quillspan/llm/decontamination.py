"""Benchmark decontamination by an FM-index per training shard (operator 7).

A window is ten consecutive words of a benchmark item (all words of a shorter one). Documents are read in shards of a few
megabytes. In each shard, stretches that cannot hold a window are cut first: a stretch must be as long as the shortest window and
each of its word pairs must be a pair of some window. What remains is indexed; all windows are searched backwards through
the wavelet ranks at once, their occurrences located by sampled suffix positions, and the spans merged.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words, each broadcast and searched by a job of its own, so what is
broadcast is bounded whatever the benchmark's size.

Defined results: null or wordless texts have no words and no hits; a null or wordless item has no windows; an item with a null
id hits words but is not counted; repeated items count once; repeated documents give repeated rows; an empty benchmark leaves
every document clean; extra columns are ignored (``remove_passages`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches, spare, table
from .fm_index import FMIndex

WINDOW = 10
BLOCK_WORDS = 1 << 20
#: Letters a-z, digits and everything beyond ASCII belong to words; A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


@dataclass
class Windows:
    """The windows of one block of benchmark items, numbered words, and the items that hold each window."""

    vocabulary: dict[bytes, int]
    patterns: np.ndarray  # rows filled with -1 on the left
    items: list[list[str]]
    pairs: np.ndarray
    shortest: int

    @classmethod
    def of(cls, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> Windows:
        vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                holders.setdefault(tuple(ids[i : i + size]), set()).update([] if item is None else [item])
        keys = sorted(holders)
        patterns = np.full((len(keys), window), -1, np.int64)
        for row, key in zip(patterns, keys, strict=True):
            row[window - len(key) :] = key
        base = len(vocabulary) + 1
        pairs = np.unique([a * base + b for k in keys for a, b in zip(k, k[1:], strict=False)]).astype(np.int64)
        return cls(vocabulary, patterns, [sorted(holders[k]) for k in keys], pairs, min(map(len, keys), default=0))


def find(texts: list[list[bytes]], w: Windows) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """For each text of a shard its merged hit spans, in words, and the items found there."""
    none: list[tuple[list[tuple[int, int]], list[str]]] = [([], []) for _ in texts]
    if not len(w.patterns) or not texts:
        return none
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.r_[0, np.cumsum(sizes)]
    flat = np.zeros(starts[-1], np.int64)
    get = w.vocabulary.get
    for s, t in zip(starts[:-1], texts, strict=True):
        flat[s : s + len(t)] = np.fromiter(map(get, t, repeat(0)), np.int64, len(t))
    # stretches of words whose neighbouring pairs all stand in windows, at least as long as the shortest window
    base = len(w.vocabulary) + 1
    both = (flat[:-1] > 0) & (flat[1:] > 0)
    linked = np.zeros(len(flat), bool)  # to the word before
    code = (flat[:-1] * base + flat[1:])[both]
    at = np.minimum(np.searchsorted(w.pairs, code), max(0, len(w.pairs) - 1))
    linked[1:][both] = w.pairs[at] == code if len(w.pairs) else False
    heads = np.flatnonzero(~linked)
    lengths = np.diff(np.r_[heads, len(flat)])
    keep = (lengths >= w.shortest) & (flat[heads] > 0)
    heads, lengths = heads[keep], lengths[keep]
    if not len(heads):
        return none
    offsets = np.r_[0, np.cumsum(lengths + 1)]
    source = np.repeat(heads - offsets[:-1], lengths + 1) + np.arange(offsets[-1])  # where each kept word came from
    words = flat[np.minimum(source, len(flat) - 1)]
    words[offsets[1:] - 1] = 0
    index = FMIndex(words[:-1])
    low, high = index.search(w.patterns)
    hit = np.flatnonzero(low < high)
    counts = (high - low)[hit]
    which = np.repeat(hit, counts)
    rows = np.repeat(low[hit] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    begin = source[index.locate(rows)]
    length = (w.patterns[which] >= 0).sum(axis=1)
    covered = np.zeros(len(flat) + 1, np.int64)
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + length, -1)
    inside = np.r_[0, (np.cumsum(covered) > 0).astype(np.int8), 0]
    edges = np.flatnonzero(np.diff(inside))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        text = int(np.searchsorted(starts, a, side="right")) - 1
        none[text][0].append((a - int(starts[text]), b - int(starts[text])))
    owner = np.searchsorted(starts, begin, side="right") - 1
    seen: dict[int, set[str]] = {}
    for text, pattern in set(zip(owner.tolist(), which.tolist(), strict=True)):
        seen.setdefault(text, set()).update(w.items[pattern])
    for text, items in seen.items():
        none[text][1].extend(sorted(items))
    return none


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS) -> Iterator[Windows]:
    """Blocks of items with at most ``limit`` words (or one item), read partition by partition; at least one block."""
    held, words, any_ = [], 0, False
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text")).toLocalIterator():
        own = words_of(row.text)
        if held and words + len(own) > limit:
            yield Windows.of(held)
            any_, held, words = True, [], 0
        held.append((row.item_id, own))
        words += len(own)
    if held or not any_:
        yield Windows.of(held)


SPANS = "array<struct<first:int,last:int>>"


def _search(docs: DataFrame, windows: Windows) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            found = find(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), batch.column(2),
                 pa.array([[{"first": a, "last": b} for a, b in spans] for spans, _ in found], span), pa.array([items for _, items in found], pa.list_(pa.string()))],
                ["doc_id", "n_words", "text_hash", "spans", "items"],
            )

    small_batches(docs.sparkSession)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    return picked.mapInArrow(run, f"doc_id long, n_words long, text_hash long, spans {SPANS}, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, text_hash, spans (of words, first inclusive, last exclusive) and items of every row of ``docs``."""
    blocks = benchmark_blocks(benchmark, block_words)
    first, second = next(blocks), next(blocks, None)
    found = _search(docs, first)
    if second is None:
        return found
    parts = []
    while second is not None:  # one written table of hits per block
        part = _search(docs, second).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
        parts.append(materialise(part.select("doc_id", "text_hash", "spans", "items"), "hits"))
        second = next(blocks, None)
    more = parts[0]
    for p in parts[1:]:
        more = more.union(p)
    more = more.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    both = found.join(more.withColumnRenamed("doc_id", "_d").withColumnRenamed("text_hash", "_h"), F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("text_hash").eqNullSafe(F.col("_h")), "left")
    merged = f"""aggregate(sort_array(concat(spans, coalesce(more_spans, array()))), cast(array() as {SPANS}), (a, s) ->
        if(size(a) > 0 and s.first <= element_at(a, -1).last,
           concat(slice(a, 1, size(a) - 1), array(named_struct('first', element_at(a, -1).first, 'last', greatest(element_at(a, -1).last, s.last)))),
           concat(a, array(named_struct('first', s.first, 'last', s.last)))))"""
    return both.select("doc_id", "n_words", "text_hash", F.expr(merged).alias("spans"), F.expr("array_sort(array_distinct(concat(items, coalesce(more_items, array()))))").alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    found = contamination(docs, benchmark, block_words)
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + (s.last - s.first))")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given spans of words (with what stands between a span's words)."""
    raw = text.encode()
    inside = np.frombuffer(raw.translate(FOLD), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    begins, ends, out, at = edges[::2], edges[1::2], [], 0
    for first, last in spans:
        out.append(raw[at : begins[first]])
        at = ends[last - 1]
    return b"".join([*out, raw[at:]]).decode()


def remove_passages(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark passages; all rows and columns stay, ``n_chars`` (if there) follows the text.

    A benchmark of one block is searched and cut in one pass; of more, each block is searched for itself and the spans join the texts.
    """
    blocks = benchmark_blocks(benchmark, block_words)
    first, more = next(blocks), next(blocks, None) is not None
    columns, place = docs.columns, docs.columns.index("text")
    if more:
        own, hash_, key = spare(docs, "_spans"), spare(docs, "_hash"), spare(docs, "_key")
        found = contamination(docs, benchmark, block_words).filter(F.size("spans") > 0).groupBy(F.col("doc_id").alias(key), F.col("text_hash").alias(hash_)).agg(F.first("spans").alias(own))
        docs = docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(hash_)), "left").select(*columns, own)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            if more:
                spans = [[(x["first"], x["last"]) for x in s or ()] for s in batch.column(len(columns)).to_pylist()]
            else:
                spans = [s for s, _ in find([words_of(t) for t in texts], shared.value)]
            fresh = [t if not s else cut_spans(t, merge(s)) for t, s in zip(texts, spans, strict=True)]
            out = list(batch.columns)[: len(columns)]
            out[place] = pa.array(fresh, batch.schema.field(place).type)
            if "n_chars" in columns:
                i = columns.index("n_chars")
                out[i] = pa.array([n if t is u else len(u or "") for n, t, u in zip(out[i].to_pylist(), texts, fresh, strict=True)], batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(out, names=columns)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.select(*columns).schema)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def brute_force(texts: dict[int, str | None], items: dict[object, str | None], window: int = WINDOW) -> dict[int, tuple[int, int, int, str, bool]]:
    """The report by comparing every window with every place; for tests."""
    out = {}
    for doc, text in texts.items():
        words, hit, seen = words_of(text), set(), set()
        for item, other in items.items():
            own = words_of(other)
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == own[i : i + size]:
                        hit.update(range(j, j + size))
                        seen.add(str(item))
        out[doc] = (len(words), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit))
    return out


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
