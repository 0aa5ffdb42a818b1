"""Removal of repeated 100-byte strings by bounded Burrows-Wheeler expansion (operator 8).

A string that repeats anywhere must first meet its copies. Every string of ``length`` bytes has an anchor, the leftmost
smallest hash among its 32-byte grams, which depends on its bytes alone; the strings around one anchor are neighbours, so a
text gives one context per anchor (about one in 32 bytes). Copies of a string lie at the same place of contexts of equal
anchors.

1. One pass over the texts gives contexts as hashes. Contexts that are equal as a whole are settled there: all but the first
   are repeats. This merges exact copies before anything is indexed, first within a batch, then by anchor.
2. Different contexts of one anchor are indexed. Their bytes are fetched, and each is dealt by the half in which a repeated
   string must extend beyond the anchor (34 bytes on the left, 35 on the right), so contexts of a common phrase that share
   no long string separate. Each shard of contexts gets its transform and :mod:`bwt_lcp` finds the strings that are equal.
3. A group of contexts too large for one shard is cut into shards. What repeats within a shard is settled there; contexts with
   strings that don't are dealt again by the bytes farther out, in halves of the places a string can begin at, until groups fit or
   the key is the whole string, of which the first is then kept. So a common phrase costs a few passes over its contexts.
4. Spans to remove are gathered by document and cut out.

Every string is compared, whatever the number of its copies. Workers stream sorted rows: one holds a batch, or a shard of
``shard`` bytes, never a group. An anchor or key that fills a good part of a batch is spread over the cluster: its
contexts go to the index at once, and its key to several parts, which meet in the next deal.

Defined results: null and empty texts have no bytes; texts of fewer bytes than ``length`` stay whole; rows without a doc_id
come before all others, in the order of a hash of their texts, and equal ones count as one document; rows that repeat a doc_id
are one document, so they don't remove each other; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bwt_lcp import GAP, long_prefix_rows
from .common import materialise, partitions, small_batches, table

LENGTH, GRAM = 100, 32
#: Bytes of contexts in one index, and of texts in one batch; both decide what a Python worker holds.
SHARD_BYTES, BATCH_BYTES = 1 << 20, 2 << 20
#: Contexts of one anchor, and rows of one key, that a task may meet, as far as a batch tells; beyond, they are spread. Fewer than
#: ``FEW`` in a batch never are.
SPREAD_CONTEXTS, SPREAD_ROWS, FEW = 1 << 18, 1 << 13, 32
#: Rows without a doc_id get numbers below this.
NO_ID = -(2**62)
_ODD, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` bytes (a power of two)."""
    with np.errstate(over="ignore"):
        h, base, n = (data.astype(np.uint64) + np.uint64(1)) * _ODD, _STEP, 1
        while n < gram:
            h = h[:-n] * base + h[n:]
            base, n = base * base, n * 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For every start the place of the first smallest of ``width`` values."""

    def both(value, place, step, n):
        less = value[step : step + n] < value[:n]
        return np.where(less, value[step : step + n], value[:n]), np.where(less, place[step : step + n], place[:n])

    value, place, n = h, np.arange(len(h), dtype=np.int32), 1
    while 2 * n <= width:
        value, place = both(value, place, n, len(value) - n)
        n *= 2
    if n < width:
        value, place = both(value, place, width - n, len(value) - (width - n))
    return place


def contexts(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first string, strings, lead, anchor hash, context hash) of every context; first counts bytes of the text, lead those from the first string to the anchor; equal hashes mean equal lead, too."""
    import xxhash

    sizes = np.array([len(t) for t in texts])
    starts = np.r_[0, np.cumsum(sizes)]
    whole = b"".join(texts)
    empty = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, np.int64))
    if len(whole) < length:
        return empty
    h = gram_hashes(np.frombuffer(whole, np.uint8), gram)
    place = leftmost_minima(h, length - gram + 1)
    n = len(place)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[:n]
    valid = np.arange(n) + length <= starts[owner + 1]
    turn = np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(valid & turn)
    if not len(first):
        return empty
    following = np.r_[np.flatnonzero(turn)[1:], n]
    last = np.minimum(following[np.searchsorted(np.flatnonzero(turn), first)] - 1, starts[owner[first] + 1] - length)
    digest = xxhash.xxh3_64_intdigest
    shape = (place[first] - first) << 8 | (last - first + 1)
    hashes = np.fromiter((digest(whole[a:b], s) for a, b, s in zip(first.tolist(), (last + length).tolist(), shape.tolist(), strict=True)), np.uint64, len(first))
    text = owner[first].astype(np.int64)
    return text, first - starts[text], last - first + 1, place[first] - first, h[place[first]].view(np.int64), hashes.view(np.int64)


def keep_first(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort contexts; returns (order, is the first of its equals, repeats an earlier place)."""
    order = np.lexsort((first, doc, context, anchor))
    return order, *_firsts(anchor[order], context[order], doc[order], first[order])


def _firsts(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted contexts, (is the first of its equals, repeats an earlier place)."""
    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return fresh, (doc != doc[head]) | (first != first[head])


def _rows(*columns: np.ndarray, names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], list(names))


_WIRE = ("anchor", "context", "doc", "spot")
_FOUND = ("doc", "first", "last", "anchor", "lead")
#: In ``spot`` the low 16 bits hold lead and number of strings. These leads mark a settled span whose end is in ``context``, and an
#: anchor whose contexts are all to be indexed; ``_OPEN`` beside the number marks such a context, with its anchor in ``context``.
_SETTLED, _BUSY, _OPEN = 255, 254, 128


def _scan(length: int, gram: int, spread: float):
    """Contexts as hashes. ``spread``: the contexts of one anchor in a batch beyond which they go to the index as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            text, first, strings, lead, anchor, context = contexts([t.encode() if t else b"" for t in batch.column(1).to_pylist()], length, gram)
            if not len(text):
                continue
            doc = ids[text]
            order, fresh, again = keep_first(anchor, context, doc, first)
            kept, gone = order[fresh], np.sort(order[again])
            a, spot = anchor[kept], first[kept] << 16 | lead[kept] << 8 | strings[kept]
            heads = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            sizes = np.diff(np.r_[heads, len(a)])
            busy = np.repeat(sizes > spread, sizes)
            yield _rows(a[~busy], context[kept][~busy], doc[kept][~busy], spot[~busy], names=_WIRE)
            if busy.any():
                route = (doc[kept] * 31 + first[kept])[busy]
                yield _rows(route, a[busy], doc[kept][busy], spot[busy] | _OPEN, names=_WIRE)
                marks = heads[sizes > spread]
                yield _rows(a[marks], np.zeros(len(marks)), doc[kept][marks], np.full(len(marks), _BUSY << 8), names=_WIRE)
            if len(gone):  # neighbouring spans of a text as one
                s, e, d, t = first[gone], first[gone] + strings[gone] - 1 + length, doc[gone], text[gone]
                new = np.r_[True, (t[1:] != t[:-1]) | (s[1:] > e[:-1])]
                at = np.flatnonzero(new)
                yield _rows(d[at] * 31 + s[at], np.maximum.reduceat(e, at), d[at], s[at] << 16 | _SETTLED << 8, names=_WIRE)

    return run


def _settle(length: int):
    """Spans of contexts that equal an earlier one, and one of each different context of anchors that have several.

    Rows come sorted by anchor, context, doc and spot; of what came before, one row is held: the head of the last equals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opened = None, False
        for batch in batches:
            anchor, context, doc, spot = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lead, strings = spot >> 8 & 255, spot & 255
            done, through = lead == _SETTLED, strings & _OPEN > 0
            first, none = spot >> 16, np.full(int(done.sum()), -1)
            yield _rows(doc[done], first[done], context[done], none, none, names=_FOUND)
            if through.any():
                yield _rows(doc[through], first[through], (first + (strings & ~_OPEN) - 1 + length)[through], context[through], lead[through], names=_FOUND)
            rest = ~(done | through)
            anchor, context, doc, spot = (x[rest] if held is None else np.r_[h, x[rest]] for x, h in zip((anchor, context, doc, spot), held or (0,) * 4, strict=True))
            if not len(anchor):
                continue
            first, lead, strings = spot >> 16, spot >> 8 & 255, spot & 255
            mark = lead == _BUSY
            fresh, again = _firsts(anchor, context, doc, first)
            gone = again & ~mark
            none = np.full(int(gone.sum()), -1)
            yield _rows(doc[gone], first[gone], (first + strings - 1 + length)[gone], none, none, names=_FOUND)
            heads = np.flatnonzero(fresh)
            a = anchor[heads]
            sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, a[1:] != a[:-1]]), len(a)])
            out = np.repeat(sizes > 1, sizes)
            last = opened if len(heads) == 1 else bool(out[-1])
            out[0] &= not (held is not None and opened)
            out &= ~mark[heads]
            open_ = heads[out]
            yield _rows(doc[open_], first[open_], (first + strings - 1 + length)[open_], anchor[open_], lead[open_], names=_FOUND)
            h = heads[-1]
            held, opened = (anchor[h], context[h], doc[h], spot[h]), last

    return run


_DEALT = "key long, part long, doc long, first long, lead long, anchor long, a long, b long, bytes binary"
_INDEXED = "doc long, first long, last long, lead long, anchor long, a long, b long, bytes binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "bytes" else pa.int64()) for c, n in zip(columns, names, strict=True)], names)


class Dealer:
    """Deals contexts by the places a string in them can begin at: ``a`` to ``b`` bytes before the anchor.

    All strings of a deal hold the bytes from ``a`` before the anchor to ``length - b`` behind it, whose hash is the key.
    """

    def __init__(self, length: int, share: float, least: float):
        import xxhash

        self.length, self.share, self.least, self.digest = length, share, least, xxhash.xxh3_64_intdigest

    def deal(self, out: list[tuple], doc: int, raw: bytes, base: int, first: int, last: int, at: int, anchor: int, ranges: tuple[tuple[int, int], ...]) -> None:
        """Add rows for the strings in first..last of a document whose bytes from ``base`` on are ``raw``; ``at`` is the anchor's place."""
        for a, b in ranges:
            x, y = max(a, at - last + self.length), min(b, at - first)
            if x <= y:
                key = self.digest(raw[at - a - base : at - b + self.length - base], (anchor ^ (a << 8 | b)) & (2**64 - 1)) - 2**63
                out.append((key, 0, doc, at - y, y, anchor, a, b, raw[at - y - base : at - x + self.length - base]))

    def spread_out(self, rows: list[tuple]) -> list[tuple]:
        """Keys with many rows in this batch go to parts; a row without bytes tells part 0 of them."""
        busy = {k: n for k, n in Counter(r[0] for r in rows).items() if n > max(self.least, self.share)}
        if not busy:
            return rows
        out = [(r[0], 1 + hash((r[2], r[3])) % int(busy[r[0]] / self.share + 1), *r[2:]) if r[0] in busy and r[6] < r[7] else r for r in rows]
        seen = {r[0]: r for r in rows if r[0] in busy and r[6] < r[7]}
        return out + [(k, 0, *r[2:8], b"") for k, r in seen.items()]


def _fetch(length: int, gram: int, share: float, least: float):
    """Contexts that must be indexed, with their bytes, dealt by what a repeated string must hold beside the anchor."""
    side = (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(length, share, least)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, spots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                for s in spots:
                    dealer.deal(rows, doc, raw, 0, s["first"], s["last"], s["first"] + s["lead"], s["anchor"], ((0, side - 1), (side, length - gram)))
            yield _batch(dealer.spread_out(rows), _DEALT)

    return run


def _deal_again(length: int, share: float, least: float):
    """Contexts of groups too large for a shard, dealt by halves of the places a string can begin at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(length, share, least)
        for batch in batches:
            rows: list[tuple] = []
            for doc, first, last, lead, anchor, a, b, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                middle = (a + b) // 2
                dealer.deal(rows, doc, raw, first, first, last, first + lead, anchor, ((a, middle), (middle + 1, b)))
            yield _batch(dealer.spread_out(rows), _DEALT)

    return run


def repeated_spans(docs: np.ndarray, firsts: np.ndarray, parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(index of a part, start in it) of every string that equals one of an earlier document or place, among the given parts."""
    text = np.frombuffer(bytes([GAP]).join(parts) + bytes([GAP]), np.uint8)
    sizes = np.array([len(p) for p in parts])
    starts = np.r_[0, np.cumsum(sizes + 1)]
    order, boundary = long_prefix_rows(text, length)
    part = np.searchsorted(starts, order, side="right") - 1
    valid = order - starts[part] + length <= sizes[part]
    group = np.cumsum(boundary)[valid]
    at, part = order[valid] - starts[part[valid]], part[valid]
    doc, place = docs[part], firsts[part] + at
    by = np.lexsort((place, doc, group))
    g, d, p = group[by], doc[by], place[by]
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    head = np.repeat(head, np.diff(np.r_[head, len(g)]))
    again = by[(d != d[head]) | (p != p[head])]
    return part[again], at[again]


class Shards:
    """Turns sorted dealt rows into spans and, for groups too large for a shard, contexts to deal again."""

    def __init__(self, length: int, shard: int):
        self.length, self.shard = length, shard

    def spans(self, rows: pa.Table, part: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((at, part))
        part, at = part[by], at[by]
        new = np.r_[True, (part[1:] != part[:-1]) | (at[1:] > at[:-1] + self.length)][: len(part)]
        head = np.flatnonzero(new)
        tail = np.r_[head[1:], len(part)] - 1 if len(head) else head
        docs, firsts = rows["doc"].to_numpy(), rows["first"].to_numpy()
        found = [docs[part[head]], firsts[part[head]] + at[head], firsts[part[head]] + at[tail] + self.length]
        none = pa.nulls(len(head), pa.int64())
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in found), none, none, none, none, pa.nulls(len(head), pa.binary())], [c.split()[0] for c in _INDEXED.split(", ")])

    def solve(self, rows: pa.Table, onward: bool) -> Iterator[pa.RecordBatch]:
        """Spans of strings that repeat within ``rows``; ``onward``: also the contexts of all other strings, cut to them."""
        parts = rows["bytes"].to_pylist()
        if len(parts) > 1:
            part, at = repeated_spans(rows["doc"].to_numpy(), rows["first"].to_numpy(), parts, self.length)
            if len(part):
                yield self.spans(rows, part, at)
        else:
            part = at = np.empty(0, np.int64)
        if not onward:
            return
        gone = [set() for _ in parts]
        for i, x in zip(part.tolist(), at.tolist(), strict=True):
            gone[i].add(x)
        out = []
        for doc, first, lead, anchor, a, b, raw, seen in zip(*(rows[c].to_pylist() for c in ("doc", "first", "lead", "anchor", "a", "b")), parts, gone, strict=True):
            left = [x for x in range(len(raw) - self.length + 1) if x not in seen]
            if left:
                x, y = left[0], left[-1] + self.length
                out.append((doc, first + x, first + y, lead - x, anchor, a, b, raw[x:y]))
        yield _batch(out, _INDEXED)

    def chunks(self, rows: pa.Table, onward: bool) -> Iterator[pa.RecordBatch]:
        """Solve ``rows`` in shards of bounded bytes; between groups unless ``onward``."""
        keys = rows["key"].to_numpy()
        total = np.cumsum(pc.binary_length(rows["bytes"]).to_numpy())
        ends = np.arange(1, len(keys) + 1) if onward else np.r_[np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        cut = 0
        while cut < len(keys):
            base = total[cut - 1] if cut else 0
            i = int(np.searchsorted(total[ends - 1], base + self.shard, side="right"))
            stop = int(ends[min(max(i - 1, int(np.searchsorted(ends, cut, side="right"))), len(ends) - 1)])
            yield from self.solve(rows.slice(cut, stop - cut), onward)
            cut = stop

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the rows so far of a group that may go on
        busy = last = None  # the group of which shards were solved; key, string and its first place where the key is the whole string
        for batch in chain(batches, [None]):
            rows = pa.Table.from_batches([batch]) if batch is not None else None
            if held is not None:
                rows = held if rows is None else pa.concat_tables([held, rows])
            if rows is None or not rows.num_rows:
                continue
            held = None
            single = rows["a"].to_numpy() == rows["b"].to_numpy()
            if single.any():
                out, last = self.keep_first_string(rows.filter(pa.array(single)), last)
                yield out
                rows = rows.filter(pa.array(~single))
                if not rows.num_rows:
                    continue
            keys, parts, size = rows["key"].to_numpy(), rows["part"].to_numpy(), pc.binary_length(rows["bytes"]).to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])])
            counts, sums = np.diff(np.r_[starts, len(keys)]), np.add.reduceat(size, starts)
            large = (parts[starts] > 0) | (np.minimum.reduceat(size, starts) == 0) | (sums > self.shard)
            if busy == (keys[0], parts[0]):
                large[0] = True
            busy = None
            if batch is not None:
                if not large[-1] or sums[-1] < self.shard:
                    held, counts[-1] = rows.slice(starts[-1]).combine_chunks(), 0
                if large[-1]:
                    busy = (keys[-1], parts[-1])
            many = np.repeat((counts > 1) & ~large, np.diff(np.r_[starts, len(keys)]))  # a context alone in its group repeats nothing
            if many.any():
                yield from self.chunks(rows.take(np.flatnonzero(many)), False)
            for i in np.flatnonzero(large & (counts > 0)):
                own = rows.slice(starts[i], counts[i])
                yield from self.chunks(own.filter(pa.array(size[starts[i] : starts[i] + counts[i]] > 0)), True)

    def keep_first_string(self, rows: pa.Table, last: tuple | None) -> tuple[pa.RecordBatch, tuple]:
        """Spans of all but the first of equal strings; rows are sorted, so the first of a key comes first."""
        key, seen = last or (None, {})
        out = []
        for k, doc, first, raw in zip(*(rows[c].to_pylist() for c in ("key", "doc", "first", "bytes")), strict=True):
            if k != key:
                key, seen = k, {}
            if seen.setdefault(raw, (doc, first)) != (doc, first):
                out.append((doc, first, first + self.length, None, None, None, None, None))
        return _batch(out, _INDEXED), (key, seen)


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD_BYTES, contexts_: int = SPREAD_CONTEXTS, rows_: int = SPREAD_ROWS) -> DataFrame:
    """(doc, first, last) of byte spans to remove, in any order and overlapping; together they cover what must go."""
    if gram & (gram - 1) or gram > length // 2:
        raise ValueError("gram must be a power of two and at most half of length")
    small_batches(docs.sparkSession, BATCH_BYTES)
    tasks, files = docs.rdd.getNumPartitions(), partitions(docs)
    share, least = rows_ / tasks, min(FEW, rows_)
    wire = docs.mapInArrow(_scan(length, gram, max(min(FEW, contexts_), contexts_ / tasks)), ", ".join(f"{c} long" for c in _WIRE))
    settled = wire.repartition("anchor").sortWithinPartitions(*_WIRE).mapInArrow(_settle(length), ", ".join(f"{c} long" for c in _FOUND))
    found = materialise(settled.coalesce(files), "contexts")
    wanted = found.filter("lead >= 0").groupBy("doc").agg(F.collect_list(F.struct("first", "last", "anchor", "lead")).alias("spots"))
    bytes_ = docs.join(wanted, docs.doc_id == wanted.doc).select("doc_id", "text", "spots")
    dealt = bytes_.mapInArrow(_fetch(length, gram, share, least), _DEALT)
    out = found.filter("lead < 0").select("doc", "first", "last")
    while True:  # every deal halves the places a string can begin at, so there are at most seven
        sorted_ = dealt.repartition("key", "part").sortWithinPartitions("key", "part", "doc", "first")
        indexed = materialise(sorted_.mapInArrow(Shards(length, shard).run, _INDEXED).coalesce(files), "indexed")
        out = out.union(indexed.filter("bytes is null").select("doc", "first", "last"))
        again = indexed.filter("bytes is not null")
        if again.isEmpty():
            return out
        dealt = again.mapInArrow(_deal_again(length, share, least), _DEALT)


def merge_spans(found: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["first"], min(s["last"], size)) for s in found):
        if a >= size:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept_bytes(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in cut:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD_BYTES, contexts_: int = SPREAD_CONTEXTS, rows_: int = SPREAD_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row."""
    picked = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(2**48 - 1) + NO_ID - 2**48).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    by_doc = spans(picked, length, gram, shard, contexts_, rows_).groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = picked.join(by_doc, picked.doc_id == by_doc.doc, "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                cut = merge_spans(found or [], len(raw))
                kept = kept_bytes(raw, cut)
                rows.append((None if doc < NO_ID else doc, len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").coalesce(partitions(docs))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
