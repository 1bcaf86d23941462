"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Pivots are spread over a bounded sample: each is the row
farthest from those chosen before. The index stores every vector with its order. A search goes through the stored index in
segments of rows; in each, the orders are posted in one inverted file per pivot, and the postings of a
query's own pivots add up the footrule distance between both orders (a pivot outside an order counts as at its end). The
rows of least footrule distance, a fixed share of each segment, are compared by their exact distance. Queries go out
in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import vectors
from tidemill.llm.workers import lean
from tidemill.sinks.layers import store

#: Rows that pivots are chosen from, by least hash of id and vector; pivots; pivots in a vector's order.
SAMPLE, PIVOTS, ORDERED = 4096, 256, 64
#: Share of a segment's rows that is compared exactly, and the least number of them; rows at an equal footrule distance
#: to the last of them, or within ``TIGHT`` of the largest footrule distance, are compared too.
SHARE, LEAST, TIGHT = 0.125, 256, 0.02
SEGMENT = 8192
#: Queries sent out at once, on average (8 MB of 64 components); of these, how many a task scores at once.
BLOCK, _CHUNK = 1 << 14, 256
_NO_ID = np.iinfo(np.int64).max


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows, each the farthest from those before; repeated rows are left out."""
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def orders(points: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The numbers of each point's nearest pivots, nearest first, ties by number."""
    far = (pivots**2).sum(axis=1) - 2 * points @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :length].astype(np.int16)


def postings(order: np.ndarray, n_pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot, the rows in whose order it stands, and the positions there."""
    length = order.shape[1]
    by_pivot = np.argsort(order.reshape(-1), kind="stable")
    ends = np.searchsorted(order.reshape(-1)[by_pivot], np.arange(1, n_pivots))
    return [(at // length, (at % length).astype(np.int32)) for at in np.split(by_pivot, ends)]


def footrules(asked: list[tuple[np.ndarray, np.ndarray]], posted: list[tuple[np.ndarray, np.ndarray]], shape: tuple[int, int], length: int) -> np.ndarray:
    """Footrule distances of queries (rows) and posted vectors (columns) from the postings of both."""
    out = np.full(shape, length * (length + 1), dtype=np.int32)
    for (q, at), (v, place) in zip(asked, posted):
        if len(q) and len(v):
            out[q[:, None], v] += np.abs(at[:, None] - place) - (length - at)[:, None] - (length - place)
    return out


def build_index(embeddings: DataFrame, width: int = 64, vector: str = "embedding", pivots: int = PIVOTS, ordered: int = ORDERED) -> tuple[DataFrame, np.ndarray]:
    """The stored index (``row``, ``vec_id``, ``e``, ``ord``: a row per sound vector that is not zero) and its pivots."""
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e"))
    kept = kept.filter(vectors.sound(F.col("e"), width) & F.exists("e", lambda x: x != 0))
    sample = kept.orderBy(F.xxhash64("vec_id", "e"), "vec_id").select("e").limit(SAMPLE).toArrow().column("e").combine_chunks()
    chosen = spread_pivots(vectors.matrix(sample, width), pivots) if len(sample) else np.zeros((0, width))
    length = min(ordered, len(chosen))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = orders(vectors.matrix(batch.column("e"), width), chosen, length)
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors.lists(order)], names=["row", "vec_id", "e", "ord"])

    rows = kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "e")
    return store(rows.mapInArrow(lean(place), "row long, vec_id long, e array<double>, ord array<smallint>"), "permutations"), chosen


def _best(far: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.lexsort((rows, ids, far))[:k]
    return far[first], ids[first], rows[first]


def search(index: DataFrame, pivots: np.ndarray, queries: Column, k: int = 10, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """For each index row that ``queries`` holds for, its ``k`` nearest rows found: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Nearest is the least Euclidean distance in double precision, ties go to the smaller ``vec_id`` (null last, then by row). A row is
    never its own neighbour, but a repeated row is. Nothing but the choice by footrule distance is approximate.
    """
    if not len(pivots):
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, spark = pivots.shape[1], index.sparkSession
    asked = index.filter(queries)
    blocks = -(-asked.count() // block)
    found = None
    for b in range(max(blocks, 1)):
        table = asked.filter(F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))) == b).orderBy("row").toArrow().combine_chunks()
        part = _search_block(index, spark.sparkContext.broadcast(_arrays(table, width)), len(pivots), width, k, segment)
        found = part if found is None else found.unionByName(part)
    ranked = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _arrays(table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids (null: the largest), vectors and orders."""
    columns = [table.column(c).combine_chunks() if isinstance(table, pa.Table) else table.column(c) for c in ("row", "vec_id", "e", "ord")]
    ids = columns[1].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    order = columns[3].flatten().to_numpy(zero_copy_only=False)
    return columns[0].to_numpy(zero_copy_only=False), ids, vectors.matrix(columns[2], width), order.reshape(len(ids), -1) if len(ids) else order.reshape(0, 1)


def _search_block(index: DataFrame, shared, n_pivots: int, width: int, k: int, segment: int) -> DataFrame:
    """The best rows of each task for each query of one block."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, query_ids, query_points, query_orders = shared.value
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_rows)

        def scan(held: list[pa.RecordBatch]) -> None:
            rows, ids, points, order = _arrays(pa.Table.from_batches(held), width)
            length = order.shape[1]
            posted = postings(order, n_pivots)
            most = min(len(rows), max(LEAST, int(np.ceil(SHARE * len(rows)))))
            for first in range(0, len(query_rows), _CHUNK):
                own = query_orders[first : first + _CHUNK]
                apart = footrules(postings(own, n_pivots), posted, (len(own), len(rows)), length)
                limits = np.maximum(np.partition(apart, most - 1, axis=1)[:, most - 1], int(TIGHT * length * (length + 1)))
                for i, limit in enumerate(limits):
                    q = first + i
                    near = np.flatnonzero((apart[i] <= limit) & (rows != query_rows[q]))
                    far = np.sqrt(((points[near] - query_points[q]) ** 2).sum(axis=1))
                    best[q] = _best(*(np.concatenate(x) for x in zip(best[q], (far, ids[near], rows[near]))), k)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= segment:
                scan(held)
                held = []
        if sum(map(len, held)):
            scan(held)
        for first in range(0, len(best), 1024):
            part = best[first : first + 1024]
            counts = [len(x[0]) for x in part]
            far, ids, rows = (np.concatenate([x[j] for x in part]) for j in range(3))
            numbers = np.repeat(query_rows[first : first + 1024], counts)
            names = np.repeat(query_ids[first : first + 1024], counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(names, mask=names == _NO_ID), pa.array(ids, mask=ids == _NO_ID), pa.array(far), pa.array(rows)],
                names=["query_row", "query_id", "vec_id", "score", "row"],
            )

    return index.mapInArrow(lean(look), "query_row long, query_id long, vec_id long, score double, row long")
