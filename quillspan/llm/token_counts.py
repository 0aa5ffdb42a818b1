"""Token counts with overlap resynchronisation (operator 10).

Huge documents are encoded as overlapping chunks with offsets. Two chunk encodings are spliced at a boundary that is
*proven* stable: the model merges neighbouring pieces only into pieces of its vocabulary, so where the two characters
beside a position stand next to each other in no vocabulary piece, no encoding of any text has a piece across that
position, and what lies on one side cannot influence the other. Both encodings must also show that boundary among their
offsets; if none is found, the overlap is doubled, until the chunk reaches back to the last splice.

Defined results: null and empty texts count 0 tokens; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

CHUNK_CHARS, OVERLAP_CHARS, TOKEN_LIMIT = 32_768, 256, 4096
META = "▁"  # how the model writes a space


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Counts pieces of one sentencepiece model; ``chunk`` and ``overlap`` are in characters."""

    _loaded: dict[str, PieceCounter] = {}

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        import sentencepiece

        if overlap < 2 or chunk <= overlap:
            raise ValueError("overlap must be at least 2 and chunk larger than overlap")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        self._joined: set[str] | None = None

    @classmethod
    def get(cls, path: str, chunk: int, overlap: int) -> PieceCounter:
        key = f"{path}|{chunk}|{overlap}"
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, chunk, overlap)
        return cls._loaded[key]

    @property
    def joined(self) -> set[str]:
        """Every pair of neighbouring characters inside a vocabulary piece."""
        if self._joined is None:
            pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
            self._joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        return self._joined

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", META) not in self.joined

    def _ends(self, text: str) -> list[int]:
        """The character offset at which each piece ends (byte pieces of one character share it)."""
        raw = text.encode()
        to_char, n = {}, 0
        for i, b in enumerate(raw):
            if b & 0xC0 != 0x80:
                to_char[i] = n
                n += 1
        to_char[len(raw)] = n
        return [to_char.get(p.end, -1) for p in self.model.encode(text, return_type="proto").pieces]

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return len(self.model.encode(text))
        total, start, spliced = 0, 0, 0  # start: of the current chunk; spliced: all before it is counted
        ends = self._ends(text[: self.chunk])
        stop = self.chunk
        while stop < len(text):
            overlap, then = self.overlap, min(len(text), stop + self.chunk - self.overlap)
            while True:
                begin = max(spliced, stop - overlap)
                following = self._ends(text[begin:then])
                here, there = {start + e for e in ends}, {begin + e for e in following}
                at = next((p for p in range(stop - 1, begin, -1) if self.stable(text, p) and p in here and p in there), None)
                if at is not None:
                    total += sum(spliced < start + e <= at for e in ends) if spliced else sum(start + e <= at for e in ends)
                    start, ends, spliced, stop = begin, following, at, then
                    break
                if begin == spliced:  # no stable boundary since the last splice: this chunk takes in the whole stretch
                    start, ends, stop = begin, following, then
                    break
                overlap *= 2
        return total + sum(start + e > spliced or not spliced for e in ends)


def count_tokens(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; one pass over the texts, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.get(path, chunk, overlap)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [0] * len(texts)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            for i, ids in zip(short, counter.model.encode([texts[i] for i in short], num_threads=1), strict=True):
                counts[i] = len(ids)
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = counter.count(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), model_path("piece_bpe_32k.model"))
