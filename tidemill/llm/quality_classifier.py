"""Quality classifier: documents are voted on by their nearest labelled neighbours in a latent semantic space.

Terms are hashed n-grams of folded characters, of coarse character classes, and repeats of words. Their TF-IDF
vectors are reduced by a truncated singular value decomposition. The space and the labelled neighbours come from a
bounded, deterministic sample of the labelled rows (``SAMPLE`` for each label); every document is compared with all
of them by exact blocked cosine products.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import scan
from tidemill.llm.symbols import codes, row_sums, symbols

#: Labelled rows of each label that make the space and vote; about 40 KB each on the driver while it fits.
SAMPLE = 1024
TERMS = 4096
CLASSES = 8**4
REPEATS = 4
WIDTH = TERMS + CLASSES + REPEATS
RANK = 64
NEIGHBOURS = 15
ROWS = 256

#: Coarse class of each symbol: white space, small letter, capital, digit, full stop or comma, other mark, beyond ASCII.
_CLASS = np.array([0] + [1] * 26 + [2, 3, 4, 4, 5] + [6] * 32, dtype=np.int32)


def term_counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """Dense blocks of term counts, rows in the order of the texts."""
    for first, last, data, offsets in scan.chunks(texts):
        for part in range(0, last - first, ROWS):
            some = offsets[part : min(part + ROWS, last - first) + 1]
            piece, some = data[some[0] : some[-1]], some - some[0]
            rows = len(some) - 1
            found, firsts = symbols(piece, some)
            base = np.repeat(np.arange(rows, dtype=np.int64) * WIDTH, np.diff(firsts))
            grams = codes(found, firsts, 3).astype(np.int64)
            grams = (grams * 2654435761 >> 7) % TERMS + base
            kinds = codes(_CLASS[found], firsts, 4, 8) + TERMS + base
            counts = np.bincount(np.concatenate([grams, kinds]), minlength=rows * WIDTH).astype(np.float32).reshape(rows, WIDTH)
            starts, ends, words = scan.words(piece, some)
            hashes = scan.SpanHasher(piece)(starts, ends)
            of = scan.rows_of(words)
            for k in (1, 2):
                same = np.zeros(len(hashes))
                same[k:] = (hashes[k:] == hashes[:-k]) & (of[k:] == of[:-k]) if len(hashes) > k else 0
                counts[:, TERMS + CLASSES + k - 1] = row_sums(same, words)
            begin, end, lines = scan.lines(piece, some)
            counts[:, -2] = np.diff(lines)
            counts[:, -1] = np.diff(words)
            yield counts


@dataclass
class Neighbours:
    """Weights of the terms, the projection to the space, and labelled unit vectors in it."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts)
        weighted *= idf
        norm = np.linalg.norm(weighted, axis=1, keepdims=True)
        weighted /= np.where(norm > 0, norm, 1)
        return weighted

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Neighbours:
        idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        weighted = cls.weigh(counts, idf)
        values, left = np.linalg.eigh(weighted @ weighted.T)  # sample by sample: the smaller side
        top = np.argsort(values)[::-1][:rank]
        top = top[values[top] > 1e-6]
        projection = (weighted.T @ left[:, top] / np.sqrt(values[top])).astype(np.float32)
        return cls(idf, projection, cls.unit(weighted @ projection), labels.astype(np.float32))

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return self.unit(self.weigh(counts, self.idf) @ self.projection)

    @staticmethod
    def unit(vectors: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)

    def vote(self, counts: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """The similarity-weighted share of label 1 among the k nearest; without any similar one, the share of all.

        Of neighbours that are equally near, those first in the sample's order count.
        """
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = self.embed(counts) @ self.vectors.T
        k = min(k, len(self.labels))
        last = np.partition(near, -k, axis=1)[:, [-k]]
        above, equal = near > last, near == last
        chosen = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= k - above.sum(axis=1, keepdims=True)))
        weight = np.where(chosen, np.maximum(near, 0.0), 0.0).astype(np.float64)
        total = weight.sum(axis=1)
        voted = weight @ self.labels
        return np.clip(np.where(total > 0, voted / np.where(total > 0, total, 1), self.labels.mean()), 0, 1)


def fit_classifier(labelled: DataFrame, text: str = "text", label: str = "label", sample: int = SAMPLE) -> Neighbours:
    """From at most ``sample`` rows of each label (0 and 1) of ``labelled``, those with the least hash of their ``doc_id``.

    The bound is on rows, so an id that repeats does not widen the sample: of its rows those with the least hash of the
    text come first. Rows of other labels are left out, null and empty texts have no terms.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [zlib.compress(row.astype("<f4").tobytes(), 1) for block in term_counts(batch.column("text")) for row in block]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), pa.array(rows, pa.binary())], names=["label", "place", "terms"])

    rows = labelled.select("doc_id", F.col(text).alias("text"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    rows = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample)
    found = rows.select("label", "place", "text").mapInArrow(counted, "label int, place int, terms binary").toArrow()
    found = found.sort_by([("label", "ascending"), ("place", "ascending")])
    terms = np.empty((len(found), WIDTH), np.float32)
    for i, row in enumerate(found.column("terms")):
        terms[i] = np.frombuffer(zlib.decompress(row.as_py()), "<f4")
    labels = found.column("label").to_numpy().astype(np.float32)
    if not len(labels):
        return Neighbours(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 0), np.float32), np.zeros((0, 0), np.float32), labels)
    return Neighbours.fit(terms, labels)


def sample_labels(labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` ids of each label, by the hash of their id: a bounded table."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL")
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def classify(docs: DataFrame, model: Neighbours, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if the score is at least 0.5) to each row.

    Only the text is looked at. Null and empty texts have no terms and get the sample's share of label 1; without any
    labelled row all scores are 0.5. Repeated rows stay, equal texts score alike, an empty table gives an empty one.
    Columns with the new names are replaced. No shuffle: the model is broadcast, at most 2 * ``SAMPLE`` vectors.
    """
    docs = docs.drop("score", "predicted")
    rest = [c for c in docs.columns]
    rows = docs.withColumn("_scored_text", F.col(text))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shared.value.vote(block) for block in term_counts(batch.column("_scored_text"))]
            scores = np.concatenate(values) if values else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(scores, pa.float64())], names=[*rest, "score"])

    return rows.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
