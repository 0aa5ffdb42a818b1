"""Best-fit packing by a linear grouping scheme (operator 1).

Texts are tokenised once; pieces go to a written table. Only counts of lengths (at most ``capacity`` numbers) reach the
driver, where :mod:`packing_plan` plans sequences for them. A piece's place follows from its rank among the pieces of its
length. Ranks are counted in salted parts, so a length that a third of all pieces share is no single task's work, and the
plan that is broadcast is bounded by the number of different lengths.

Defined results: a null or empty text is one piece that holds the end id alone; repeated rows are packed one by one; no rows
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, small_batches, table
from .packing_plan import GROUPS, Run, plan
from .token_counts import model_path

CAPACITY, END_ID, SALTS = 4096, 1, 64
CACHED_WORDS = 600_000


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit strings, put together from cached runs between ASCII white space.

    The tokenizer drops white space before it forms words, so no token spans it and a run's ids do not depend on what
    surrounds it. A run of letters with a full stop or comma behind an ASCII letter splits there as well, and a run of letters
    alone is one word, which goes to the model directly. Once the cache is full, runs not in it are encoded each time.
    """

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached, self.known = cached, {}
        self.marks = {m: self._ids([m])[0] for m in (".", ",")}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: how byte-level models write bytes
        rest = [b for b in range(256) if b not in shown]
        self.letters = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}

    @classmethod
    def get(cls, path: str) -> WordEncoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _ids(self, runs: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words; those of common letters alone skip the steps that would leave them as they are."""
        out, other, pick = [], [], self.tokenizer.model.tokenize
        for i, w in enumerate(words):
            if w.isascii() and w.isalpha():
                out.append(_little_endian([t.id for t in pick(w.lower())]))
            elif w.isalpha() and max(w) < "\u0250" and "\u0130" not in w:  # single letters, each with one lower case
                shown = w.lower().encode().decode("latin-1").translate(self.letters)
                out.append(_little_endian([t.id for t in pick(shown)]))
            else:
                out.append(b"")
                other.append(i)
        for i, ids in zip(other, self._ids([words[i] for i in other]), strict=True):
            out[i] = ids
        return out

    def _learn(self, runs: set[bytes]) -> dict[bytes, bytes]:
        """Ids of runs that are not cached."""
        found, stems, ask = {}, {}, []
        for run in runs:
            s = run.decode()
            if s[-1] in self.marks and s[:-1].isalpha() and s[-2].isascii():
                stem = s[:-1].encode()
                ids = self.known.get(stem)
                if ids is not None:
                    found[run] = ids + self.marks[s[-1]]
                    continue
                stems[run] = (stem, s[-1])
                ask.append(stem)
            else:
                ask.append(run)
        ask = list(dict.fromkeys(ask))
        fresh = dict(zip(ask, self._words([a.decode() for a in ask]), strict=True))
        for run, (stem, mark) in stems.items():
            found[run] = fresh[stem] + self.marks[mark]
        found |= fresh
        room = self.cached - len(self.known)
        if room >= len(found):
            self.known |= found
        elif room > 0:
            self.known |= {r: found[r] for r in list(found)[:room]}
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get = self.known.get
        found, gaps, missing = [], [], set()
        for t in texts:
            runs = (t or "").encode().split()
            ids = list(map(get, runs))
            if None in ids:
                at = [i for i, x in enumerate(ids) if x is None]
                own = [runs[i] for i in at]
                missing.update(own)
                gaps.append((ids, at, own))
            found.append(ids)
        if missing:
            extra = self._learn(missing)
            for ids, at, own in gaps:
                for i, run in zip(at, own, strict=True):
                    ids[i] = extra[run]
        return [b"".join(ids) for ids in found]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; only documents longer than ``capacity`` are cut."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.get(path)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, coded in zip(ids, encoder.encode(batch.column(1).to_pylist()), strict=True):
                coded += end
                for i, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at : at + 4 * capacity]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return picked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(cut: DataFrame, runs: list[Run], salts: int = SALTS) -> DataFrame:
    """Give every piece its sequence and offset; ``cut`` must be a written table, so that ranks are the same whenever they are read."""
    spark = cut.sparkSession
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))  # at most capacity * salts rows
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = salted.withColumn("n", F.row_number().over(order)).join(F.broadcast(offsets), ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("n") - 1).alias("rank"))
    ordered = sorted(runs, key=lambda r: (r.length, r.rank))
    shared = spark.sparkContext.broadcast(np.array([(r.length << 44 | r.rank, r.each, r.sequence, r.offset) for r in ordered], np.int64).reshape(-1, 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, each, sequence, offset = shared.value.T
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            n = rank - (keys[at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(sequence[at] + n // each[at]), pa.array(offset[at] + n % each[at] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, groups: int = GROUPS) -> DataFrame:
    """One row per piece with its place among as few sequences of ``capacity`` tokens as the plan finds."""
    cut = materialise(pieces(docs, path, capacity, end_id), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    runs, _ = plan(counts, capacity, groups)
    return place(cut, runs)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), model_path("word_bpe_49k.json"))
