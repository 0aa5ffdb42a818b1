"""Passage embeddings by feature hashing, cosine similarity, and clusters of similar passages."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.columns import once
from ..functions.text import SPARK as S
from ..session import ship

DIMENSIONS, RETRIEVAL_DIMENSIONS = 16, 128


def buckets(text: str, dimensions: int) -> str:
    """SQL: the bucket of every token, by the first byte of its SHA-256."""
    tokens = S.filter(S.split(S.lower(text), r"[^\p{IsAlphabetic}\p{N}]+"), "t", "t <> ''")
    return f"transform({tokens}, t -> cast(conv(substr(sha2(t, 256), 1, 2), 16, 10) as int) % {dimensions})"


def hash_embedding(rows: DataFrame, dimensions: int = DIMENSIONS, text: str = "text", decimals: bool = True) -> DataFrame:
    """Add ``vector``: token counts by bucket, scaled to length 1 in single precision, rounded to three decimals if asked."""
    df = once(rows, _b=buckets(text, dimensions))  # else every dimension hashes the tokens anew
    df = df.withColumn("_c", F.expr(f"transform(sequence(0, {dimensions - 1}), d -> cast(size(filter(_b, b -> b = d)) as float))"))
    df = df.withColumn("_n", F.expr("cast(sqrt(cast(aggregate(_c, cast(0 as float), (a, v) -> cast(a + v * v as float)) as double)) as float)"))
    unit = "cast(v / _n as float)"
    scaled = f"cast(round(cast(cast({unit} * cast(1000 as float) as float) as double)) / 1000 as float)" if decimals else unit
    return df.withColumn("vector", F.expr(f"if(_n > 0, transform(_c, v -> {scaled}), _c)")).drop("_b", "_c", "_n")


def norm(col: str) -> Column:
    return F.expr(f"sqrt(aggregate({col}, 0.0D, (a, v) -> a + cast(v as double) * cast(v as double)))")


def cosine(left: str, right: str, left_norm: str, right_norm: str) -> Column:
    """0 for vectors of different lengths, empty ones and zero vectors."""
    dot = f"aggregate(zip_with({left}, {right}, (x, y) -> cast(x as double) * cast(y as double)), 0.0D, (a, v) -> a + v)"
    return F.expr(f"if(size({left}) <> size({right}) or size({left}) = 0 or {left_norm} = 0 or {right_norm} = 0, 0.0D, {dot} / ({left_norm} * {right_norm}))")


def edges(vectors: DataFrame) -> DataFrame:
    """Pairs of a document's passages (sequence a < b) that are similar enough: at all, or within a paragraph."""
    own = vectors.select("document_id", "paragraph_index", "sequence", "vector", norm("vector").alias("n"))
    left, right = (own.select("document_id", *(F.col(c).alias(f"{c}_{s}") for c in own.columns if c != "document_id")) for s in "ab")
    pairs = left.join(right, "document_id").filter("sequence_a < sequence_b").withColumn("similarity", cosine("vector_a", "vector_b", "n_a", "n_b"))
    enough = f"similarity >= {R.COSINE_ANY} or (paragraph_index_a = paragraph_index_b and similarity >= {R.COSINE_SAME_PARAGRAPH})"
    return pairs.filter(enough).select("document_id", F.col("sequence_a").alias("a"), F.col("sequence_b").alias("b"), "similarity")


CLUSTERS = "document_id string, cluster_id string, cluster_no int, sequences array<long>, passage_ids array<string>, representative_passage_id string, confidence double"


def _cluster(pdf: pd.DataFrame) -> pd.DataFrame:
    """Clusters of one document; pairs are joined in order of (left, right), as the numbers of clusters depend on it."""
    pdf = pdf.sort_values("sequence")
    vectors = np.array(pdf["vector"].tolist(), np.float64).reshape(len(pdf), -1)
    norms, paragraph, n = np.sqrt((vectors * vectors).sum(axis=1)), pdf["paragraph_index"].to_numpy(), len(pdf)
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(n - 1):
        scale = norms[i] * norms[i + 1 :]
        similarity = np.divide(vectors[i + 1 :] @ vectors[i], scale, out=np.zeros(n - i - 1), where=scale > 0)
        near = (similarity >= R.COSINE_ANY) | ((paragraph[i + 1 :] == paragraph[i]) & (similarity >= R.COSINE_SAME_PARAGRAPH))
        for j in np.flatnonzero(near):
            a, b = find(i), find(i + 1 + int(j))
            if a != b:
                root[b] = a
    groups: dict[int, list[int]] = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
    ids, numbers = pdf["id"].tolist(), pdf["sequence"].tolist()
    rows = [
        (pdf["document_id"].iloc[0], f"cluster_{k}", k, [numbers[i] for i in own], [ids[i] for i in own], ids[own[0]], 0.72 if len(own) > 1 else 0.5)
        for k, (_, own) in enumerate(sorted(groups.items()), 1)
    ]
    return pd.DataFrame(rows, columns=["document_id", "cluster_id", "cluster_no", "sequences", "passage_ids", "representative_passage_id", "confidence"])


def clusters(vectors: DataFrame) -> DataFrame:
    """Connected passages of each document; a document's vectors are one group, as clusters never cross documents."""
    ship(vectors.sparkSession)
    return vectors.select("document_id", "id", "sequence", "paragraph_index", "vector").groupBy("document_id").applyInPandas(_cluster, CLUSTERS)


class EmbeddingProvider(ABC):
    """A model that turns texts into vectors; ``embed`` gets and gives batches."""

    name: str
    model: str

    @abstractmethod
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class DeterministicProvider:
    """The default: hashed tokens, computed by SQL expressions."""

    name, model = "deterministic-embedding", "hash-16"

    def apply(self, rows: DataFrame) -> DataFrame:
        return hash_embedding(rows, DIMENSIONS)


class RetrievalProvider:
    """Hashed tokens in more dimensions, unrounded, for retrieval."""

    name, model = "hashed-text-embedding", "hash-128"

    def apply(self, rows: DataFrame) -> DataFrame:
        return hash_embedding(rows, RETRIEVAL_DIMENSIONS, decimals=False)


def embed_with(provider: EmbeddingProvider, rows: DataFrame) -> DataFrame:
    """Add ``vector`` by a pluggable model, in Arrow batches."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(provider.embed(part.tolist()))

    ship(rows.sparkSession)
    return rows.withColumn("vector", run("text"))


#: Queries in a block, which is broadcast, and vectors compared with it at a time: both bound what a worker holds.
QUERY_BLOCK, VECTOR_BLOCK = 2048, 512


class Best:
    """The ``k`` most similar vectors so far of each query of a block; ties go to the smaller vec_id."""

    def __init__(self, ids: np.ndarray, vectors: list, k: int):
        self.ids, self.k = ids, k
        lengths = np.array([len(v) for v in vectors])
        self.groups = [(rows, self.unit([vectors[i] for i in rows], n)) for n in np.unique(lengths) for rows in [np.flatnonzero(lengths == n)]]
        self.query, self.near, self.found = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)

    @staticmethod
    def unit(vectors: list, n: int) -> np.ndarray:
        own = np.nan_to_num(np.array(vectors, np.float64).reshape(len(vectors), n))
        norms = np.sqrt((own * own).sum(axis=1))
        return own / np.where(norms > 0, norms, 1)[:, None]

    def add(self, ids: np.ndarray, vectors: list) -> None:
        lengths = np.array([len(v) for v in vectors])
        near = np.zeros((len(self.ids), len(ids)))  # vectors of another length have a similarity of 0
        for rows, queries in self.groups:
            same = np.flatnonzero(lengths == queries.shape[1])
            if len(same) and queries.shape[1]:
                near[np.ix_(rows, same)] = queries @ self.unit([vectors[i] for i in same], queries.shape[1]).T
        near = np.round(near, 6)
        near[self.ids[:, None] == ids[None, :]] = -2  # the query itself
        least = -np.partition(-near, min(self.k, len(ids)) - 1, axis=1)[:, min(self.k, len(ids)) - 1]
        row, column = np.nonzero((near >= least[:, None]) & (near > -2))
        query, sim, found = np.r_[self.query, row], np.r_[self.near, near[row, column]], np.r_[self.found, ids[column]]
        order = np.lexsort((found, -sim, query))
        query, sim, found = query[order], sim[order], found[order]
        head = np.flatnonzero(np.r_[True, query[1:] != query[:-1]][: len(query)])
        place = np.arange(len(query)) - np.repeat(head, np.diff(np.r_[head, len(query)]))
        keep = place < self.k
        self.query, self.near, self.found = query[keep], sim[keep], found[keep]


def nearest(queries: DataFrame, vectors: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """The k most similar vectors (vec_id, embedding) of every query (query_id, query): an exact search of a stated query set against all rows.

    Queries are broadcast in blocks of bounded size, each a pass over the vectors; every task keeps k places a query, which are merged by query.
    Rows without a vector or an id take no part.
    """
    spark, parts = queries.sparkSession, []
    ship(spark)
    known = vectors.filter("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    asked = queries.filter("query_id is not null and query is not null").select(F.col("query_id").cast("long").alias("query_id"), "query").toLocalIterator()
    while held := list(islice(asked, block)):
        shared = spark.sparkContext.broadcast((np.array([r.query_id for r in held], np.int64), [np.array(r.query, np.float64) for r in held]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, own = shared.value
            best = Best(ids, own, k)
            for batch in batches:
                for i in range(0, batch.num_rows, VECTOR_BLOCK):
                    part = batch.slice(i, VECTOR_BLOCK)
                    best.add(part.column(0).to_numpy(), [np.array(v, np.float64) for v in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(ids[best.query]), pa.array(best.found), pa.array(best.near)], ["query_id", "vec_id", "similarity"])

        parts.append(known.mapInArrow(run, "query_id long, vec_id long, similarity double"))
    if not parts:
        return spark.createDataFrame([], "query_id long, place int, vec_id long, similarity double")
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    both = reduce(DataFrame.unionAll, parts)
    return both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query_id", "place", "vec_id", "similarity")
