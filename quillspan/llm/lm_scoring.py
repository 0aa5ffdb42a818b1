"""Language-model scores of whole documents (operator 5).

Every token belongs to a cell: frequent words have one of their own, the others share cells by their ending. A gated recurrent
network (:mod:`gru`) reads cells and predicts the next cell from all tokens before, first its class and then the cell in the class;
within a shared cell a token has its smoothed share of the training counts. So every token of any text has a probability.

1. Tokens are counted over all training documents.
2. The network learns from all training documents, in rounds over disjoint parts of them: in each round every partition
   trains from the same start, and the results are averaged by tokens in two steps, so the driver gets one vector. Scores
   therefore depend a little on how the table is partitioned.
3. One pass scores all documents. The commonest words (at most ``KNOWN``) are broadcast with their counts; other words go
   through a join with the counts.

Defined results: a null or empty text is its end token alone; a null doc_id is taken as the text ``null``; repeated rows give
repeated rows and count as often as they stand; without training tokens all counts are 0 and the network keeps its start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, partitions, small_batches, table
from .gru import WIDTH, Network, score, train

FOLDS, HELD_OUT, ROUNDS, MERGERS = 5, 1, 3, 64
#: Words that are broadcast; words with a cell of their own, shared cells by ending, and shared cells for all other endings.
KNOWN, OWN, ENDINGS, MIXED = 1 << 18, 4096, 1948, 100
BATCH_BYTES, TRAIN_TOKENS, COUNTED = 8 << 20, 800_000, 1 << 20


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, first word of each text and behind the last); the end token, the empty string, stands after each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(pc.ascii_lower(texts), "")))
    words, offsets = lists.values, lists.offsets.to_numpy()
    words, offsets = words.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
    # a blank text splits into one empty word, which is its end token; behind the words of any other text goes one more
    lengths = np.diff(offsets)
    blank = np.zeros(len(lengths), bool)
    blank[lengths == 1] = pc.equal(words.take(pa.array(offsets[:-1][lengths == 1])), "").to_numpy(zero_copy_only=False)
    lengths = lengths + ~blank
    starts = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    at = np.zeros(starts[-1], bool)
    at[starts[1:][~blank] - 1] = True
    source = np.cumsum(~at) - 1
    source[at] = len(words)
    return pa.concat_arrays([words, pa.array([""], words.type)]).take(pa.array(source)), starts


CLOSING = ".,;:!?\"')|*#$%&"


def ending(word: str) -> str:
    """What groups rare words: the last three characters, without closing marks."""
    return word.rstrip(CLOSING)[-3:]


def endings_of(words: pa.Array) -> pa.Array:
    return pc.utf8_slice_codeunits(pc.utf8_rtrim(words, CLOSING), -3)


@dataclass
class Cells:
    """Numbers of cells, ``WIDTH`` a class: cells in the order of their reversed endings, so that classes hold like endings."""

    own: list[str]
    endings: list[str]
    mixed: int

    def __post_init__(self):
        order = [(w[::-1], 0, w) for w in self.own] + [(e[::-1], 1, e) for e in self.endings] + [("", 2, i) for i in range(self.mixed)]
        self.number = {(kind, x): i for i, (_, kind, x) in enumerate(sorted(order, key=lambda o: (o[1] == 2, o)))}
        self.classes = -(-len(self.number) // WIDTH)

    def of(self, word: str) -> int:
        found = self.number.get((0, word))
        if found is None:
            tail = ending(word)
            found = self.number.get((1, tail))
            if found is None:
                found = self.number[2, sum(tail.encode()) % self.mixed]
        return found

    def __reduce__(self):
        return Cells, (self.own, self.endings, self.mixed)

    @cached_property
    def _tables(self) -> tuple:
        own, endings = pa.array(self.own, pa.string()), pa.array(self.endings, pa.string())
        return own, endings, np.array([self.number[0, w] for w in self.own] + [self.number[1, e] for e in self.endings], np.int32)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """``of`` of all words; Python sees only those that go by no known ending."""
        own, endings, numbers = self._tables
        tails = endings_of(words)
        at = pc.coalesce(pc.index_in(words, own), pc.add(pc.index_in(tails, endings), pa.scalar(len(own), pa.int32())))
        known = at.is_valid().to_numpy(zero_copy_only=False)
        found = np.empty(len(words), np.int32)
        found[known] = numbers[at.drop_null().to_numpy()]
        found[~known] = [self.number[2, sum(t.encode()) % self.mixed] for t in tails.filter(pc.is_null(at)).to_pylist()]
        return found


@dataclass
class Lexicon:
    """The commonest words with cell and log10(count + 0.5), and all that training and scoring share."""

    words: pa.Array
    counts: np.ndarray
    numbers: np.ndarray  # cell of each word
    cells: Cells
    weight: np.ndarray  # log10 of what a count of one is of its cell
    flat: np.ndarray

    @cached_property
    def logs(self) -> np.ndarray:
        return np.r_[np.log10(self.counts + 0.5), 0.0]

    @cached_property
    def cell_of(self) -> np.ndarray:
        return np.r_[self.numbers, 0].astype(np.int32)

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, places among the common words, indices of tokens that are none of them); the place behind the last stands for none."""
        at = pc.fill_null(pc.index_in(words, self.words), len(self.words)).to_numpy()
        found, missing = self.cell_of[at], np.flatnonzero(at == len(self.words))
        if len(missing):
            coded = words.take(pa.array(missing)).dictionary_encode()
            found[missing] = self.cells.numbers(coded.dictionary)[coded.indices.to_numpy()]
        return found, at, missing


def fold(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))


def count_tokens(train_docs: DataFrame) -> DataFrame:
    """(word, n) over all training documents; each task sums up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).select(["word", "n"])

        for batch in batches:
            words, _ = tokens(batch.column(0))
            if len(words):
                found = words.value_counts()
                held.append(pa.table([found.field(0), found.field(1).cast(pa.int64())], ["word", "n"]))
            if sum(map(len, held)) > COUNTED:
                held = [summed()]
                if len(held[0]) > COUNTED // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed().to_batches()

    return train_docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def choose_cells(counts: DataFrame, own: int = OWN, endings: int = ENDINGS, mixed: int = MIXED) -> Cells:
    top = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(own).collect()]
    if "" not in top:
        top = ["", *top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.array(top, pa.string())
        for batch in batches:
            rest = pa.Table.from_batches([batch]).filter(pc.invert(pc.is_in(batch.column(0), own)))
            tails = pa.table([endings_of(rest["word"]), rest["n"]], ["tail", "n"]).group_by("tail").aggregate([("n", "sum")])
            yield from tails.rename_columns(["tail", "n"]).to_batches()

    tails = counts.mapInArrow(run, "tail string, n long").groupBy("tail").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tail").limit(endings)
    return Cells(top, [r.tail for r in tails.collect()], mixed)


def cell_sums(counts: DataFrame, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and different words of each cell."""
    size = cells.classes * WIDTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            at = cells.numbers(batch.column(0))
            np.add.at(total, at, batch.column(1).to_numpy(zero_copy_only=False))
            np.add.at(kinds, at, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total), pa.array(kinds)], ["c", "n", "v"])

    out = np.zeros((2, size), np.int64)
    for r in counts.mapInArrow(run, "c long, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        out[:, r.c] = r.n, r.v
    return out[0], out[1]


def common_words(counts: DataFrame, limit: int) -> tuple[pa.Array, np.ndarray]:
    """All words from the least count on that at most ``limit`` words reach; large counts are told apart by powers of two."""
    step = F.expr("if(n < 4096, n, shiftleft(1L, cast(floor(log2(n)) as int)))")
    sizes = sorted(((r.n, r.k) for r in counts.groupBy(step.alias("n")).agg(F.count("*").alias("k")).collect()), reverse=True)
    least, total = None, 0
    for n, k in sizes:
        total += k
        if total > limit:
            break
        least = n
    if least is None:
        return pa.array([], pa.string()), np.empty(0, np.int64)
    found = counts.filter(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return found["word"].combine_chunks().cast(pa.string()), found["n"].to_numpy().astype(np.int64)


def learn(docs: DataFrame, shared, rounds: int = ROUNDS) -> np.ndarray:
    """The network's parameters after training on all rows of ``docs`` (text, part): round by round over parts, averaged between rounds."""
    spark = docs.sparkSession
    flat = shared.value.flat
    width = len(flat)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(width), 0
        for batch in batches:
            for i, n in enumerate(batch.column(2).to_pylist()):
                total += n * batch.column(1)[i].values.to_numpy().astype(np.float64)
                weight += n
        if weight:
            yield vectors(0, total / weight, weight)

    def vectors(task: int, v: np.ndarray, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([v.astype(np.float32)], pa.list_(pa.float32())), pa.array([n], pa.int64())], ["task", "v", "n"])

    schema = "task long, v array<float>, n long"
    for i in range(rounds):
        start = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            lexicon = shared.value
            net, state, held, n, total = Network.of(start.value, lexicon.cells.classes), None, [], 0, 0
            for batch in batches:
                words, starts = tokens(batch.column(0))
                held += np.split(lexicon.lookup(words)[0], starts[1:-1]) if len(starts) > 1 else []
                n += len(words)
                if n >= TRAIN_TOKENS:
                    state = train(net, held, state=state)
                    total, held, n = total + n, [], 0
            if held:
                train(net, held, state=state)
                total += n
            if total:
                yield vectors(TaskContext.get().partitionId(), net.flat(), total)

        part = docs.filter(F.col("part") == i).select("text").mapInArrow(run, schema)
        some = part.repartition(MERGERS, "task").sortWithinPartitions("task").mapInArrow(add, schema)
        found = some.repartition(1).sortWithinPartitions("n").mapInArrow(add, schema).toArrow()
        if len(found):
            flat = found["v"].combine_chunks()[0].values.to_numpy()
        start.unpersist()
    return flat


def score_documents(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rounds: int = ROUNDS, known: int = KNOWN) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), fold().alias("crc"))
    training = split.filter(F.col("crc") % folds != held_out).withColumn("part", F.expr(f"crc div {folds} % {rounds}"))
    files = partitions(docs)
    counts = materialise(count_tokens(training).coalesce(files), "token-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    cells = choose_cells(counts)
    mass, kinds = cell_sums(counts, cells)
    words, numbers = common_words(counts, known)
    net = Network(cells.classes)
    net.begin_with(np.where(np.arange(len(mass)) < len(cells.number), mass, -1))
    lexicon = Lexicon(words, numbers, cells.numbers(words), cells, np.log10(mass + 0.5 * (kinds + 1)), net.flat())
    shared = spark.sparkContext.broadcast(lexicon)
    trained = spark.sparkContext.broadcast(learn(training, shared, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        net = Network.of(trained.value, lex.cells.classes)
        names = ["doc_id", "crc", "n_tokens", "n_common", "log_common", "path", "rare"]
        for batch in batches:
            if not batch.num_rows:
                continue
            words, starts = tokens(batch.column(1))
            found, at, missing = lex.lookup(words)
            n = np.diff(starts)
            rare = np.searchsorted(missing, starts).astype(np.int32)
            logs, weights = np.add.reduceat(lex.logs[at], starts[:-1]), np.add.reduceat(lex.weight[found], starts[:-1])
            paths = score(net, np.split(found, starts[1:-1]))
            lists = pa.ListArray.from_arrays(pa.array(rare), words.take(pa.array(missing)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(n - np.diff(rare)), pa.array(logs), pa.array(paths - weights), lists], names)

    scored = split.mapInArrow(run, "doc_id long, crc long, n_tokens long, n_common long, log_common double, path double, rare array<string>")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")  # once written, a row keeps its number
    rare = scored.select("row", F.explode("rare").alias("word"))  # none of these words is common, so no key is hot
    found = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log_rare"), F.count(F.when(F.col("n") > 0, 1)).alias("n_rare"))
    logs = F.col("log_common") + F.coalesce("log_rare", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id", (F.col("crc") % folds == held_out).alias("held_out"), "n_tokens", (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(totals.n)).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * math.log10(totals.n + 0.5 * (totals.v + 1))).alias("base_score"), (logs + F.col("path")).alias("score"),
    ).coalesce(files)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
