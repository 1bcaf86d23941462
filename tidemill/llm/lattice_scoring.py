"""LM scoring: the marginal probability of a text over all its segmentations into subword pieces.

The pieces are those of an existing vocabulary file (sentencepiece). Its scores are merge ranks, not
probabilities, so they give a Zipf prior, and the pieces' counts in the training documents make the unigram
probabilities from it. Pieces do not cross words (each word starts with ``▁``), so a text's probability is the
product of its words' marginals, each a forward recursion in log space over the word's lattice, and of an end.

Spark counts words over all documents and scores each different word once. Documents travel in blocks of about
8 MB of text: a block's words go to the word table and back, its documents stay as word numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import scan
from tidemill.sinks.layers import store

BLOCK = 8 << 20
_LN10 = math.log(10.0)

_BLOCK = "block long, doc_id array<long>, held_out array<boolean>, firsts binary, numbers binary, words array<binary>, counts array<long>"


def _blocks(docs: DataFrame) -> DataFrame:
    """Documents as numbers of the words of their block, with the words and their counts in training documents."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        hashes, places, sizes, datas, rows, held = [], [], [], [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal serial
            serial += 1
            docs = pa.Table.from_batches(rows)
            test = np.array(docs.column("held_out").to_pylist(), dtype=bool)
            counts = np.concatenate(sizes)
            numbers, different = pd.factorize(np.concatenate(hashes))
            numbers = numbers.astype("<i4")
            found, at = np.flatnonzero(np.diff(np.maximum.accumulate(numbers), prepend=np.int32(-1))), 0
            words = []
            for data, (starts, ends) in zip(datas, places):
                text = data.tobytes()
                mine = found[(found >= at) & (found < at + len(starts))] - at
                words += [text[a:b] for a, b in zip(starts[mine].tolist(), ends[mine].tolist())]
                at += len(starts)
            training = np.bincount(numbers, weights=np.repeat(~test, counts), minlength=len(different)).astype(np.int64)
            firsts = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([serial], pa.int64()), pa.array([docs.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([test.tolist()], pa.list_(pa.bool_())), pa.array([firsts.tobytes()]), pa.array([numbers.tobytes()]),
                 pa.array([words], pa.list_(pa.binary())), pa.array([training.tolist()], pa.list_(pa.int64()))],
                names=["block", "doc_id", "held_out", "firsts", "numbers", "words", "counts"],
            )

        for batch in batches:
            for first, last, data, offsets in scan.chunks(batch.column("text")):
                data = scan.LOWER[data]
                starts, ends, words = scan.words(data, offsets)
                hashes.append(scan.SpanHasher(data)(starts, ends))
                places.append((starts.astype(np.int32), ends.astype(np.int32)))
                sizes.append(np.diff(words))
                datas.append(data)
                rows.append(batch.select(["doc_id", "held_out"]).slice(first, last - first))
                held += len(data)
                if held >= BLOCK:
                    yield out()
                    hashes, places, sizes, datas, rows, held = [], [], [], [], [], 0
        if rows:
            yield out()

    return store(docs.select("doc_id", "held_out", "text").mapInArrow(encode, _BLOCK), "blocks")


@dataclass
class Lattice:
    """Natural log probabilities of pieces, of single bytes, and of the end of a text."""

    pieces: dict[str, float]
    octets: list[float]
    end: float

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}

    def marginal(self, word: str) -> float:
        """Log of the summed probability of all segmentations: forward recursion over the places of the word.

        A character that is no piece is spelled by its bytes.
        """
        n, pieces, starts = len(word), self.pieces, self.starts
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        for i in range(n):
            terms = into[i]
            if len(terms) == 1:
                here = terms[0]
            else:
                top = max(terms)
                here = top + math.log(sum([math.exp(t - top) for t in terms]))
            into[i] = []
            if word[i] not in pieces:
                into[i + 1].append(here + sum(self.octets[b] for b in word[i].encode("utf-8", "surrogatepass")))
            for j in range(i + 1, min(n, i + self.longest) + 1):
                part = word[i:j]
                if part not in starts:
                    break
                score = pieces.get(part)
                if score is not None:
                    into[j].append(here + score)
        top = max(into[n])
        return top + math.log(sum([math.exp(t - top) for t in into[n]]))


def fit_lattice(words: DataFrame, path: str, texts: int) -> Lattice:
    """Probabilities of the vocabulary's pieces from the counted ``words`` (``word``, ``c``) of ``texts`` documents.

    Each word counts by the file's own segmentation of it; only sums by piece, as many as the file has, reach the driver.
    """
    import sentencepiece

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(file.get_piece_size())
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            ids = file.encode(texts, num_threads=1)
            weights = np.repeat(batch.column("c").to_numpy(), [len(x) for x in ids])
            if len(weights):
                total += np.bincount(np.concatenate([np.array(x, dtype=np.int64) for x in ids]), weights=weights, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found].astype(np.int64))], names=["piece", "n"])

    sums = words.filter(F.col("c") > 0).select("word", "c").mapInArrow(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [i for i in range(file.get_piece_size()) if not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
    counts = np.zeros(file.get_piece_size())
    for piece, n in sums.collect():
        counts[piece] = n
    ranks = np.array([-file.get_score(i) if -1e8 < file.get_score(i) < 0 else file.get_piece_size() for i in known])
    prior = 1 / (ranks + 2.7)
    mass = counts[known] + len(known) * prior / prior.sum()
    logs = np.log(mass / (mass.sum() + texts + 1))
    octets, pieces = [0.0] * 256, {}
    for i, value in zip(known, logs.tolist()):
        if file.is_byte(i):
            octets[int(file.id_to_piece(i)[3:-1], 16)] = value
        else:
            pieces[file.id_to_piece(i)] = value
    return Lattice(pieces, octets, math.log((texts + 1) / (mass.sum() + texts + 1)))


def score_documents(docs: DataFrame, held_out: Column, path: str, text: str = "text") -> DataFrame:
    """One row per document: its word-count score and its lattice score, both log10 probabilities.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. Counts come from documents where
    ``held_out`` is false or null. ``n_tokens``; ``n_known``, tokens counted in training; ``train_tokens``, all N of
    them; ``base_score``, the sum of log10((c + 1) / (N + V + 1)) with V different training tokens; ``score``, the
    lattice's log10 probability. A null text counts as empty: one end. Null or repeated ids stay. Other columns are
    not read. An empty table gives an empty one; without training documents all counts are 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = _blocks(rows)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w"))
    listed = listed.select("block", "number", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    words = store(listed.groupBy("word").agg(F.sum("n").alias("c")), "words")
    texts = blocks.agg(F.sum(F.aggregate("held_out", F.lit(0).cast("long"), lambda a, x: a + F.when(x, 0).otherwise(1)))).first()[0] or 0
    found = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    tokens, kinds = found[0] + texts, found[1] + (texts > 0)
    lattice = docs.sparkSession.sparkContext.broadcast(fit_lattice(words, path, texts))

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [lattice.value.marginal("▁" + w.decode("utf-8", "surrogateescape")) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, "log"])

    scored = words.mapInArrow(marginals, "word binary, c long, log double")
    back = listed.select("block", "number", "word").join(scored, "word").select("block", "number", "c", "log")

    def sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("number").to_numpy())
        count = right.column("c").to_numpy()[order]
        base, log = np.log10(count + 1.0), right.column("log").to_numpy()[order] / _LN10
        ids, held, known, size, plain, score = [], [], [], [], [], []
        for row in left.to_pylist():
            firsts = np.frombuffer(row["firsts"], "<i8")
            numbers = np.frombuffer(row["numbers"], "<i4")

            def summed(values: np.ndarray, firsts: np.ndarray = firsts, numbers: np.ndarray = numbers) -> np.ndarray:
                of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
                return np.bincount(of, weights=values[numbers], minlength=len(firsts) - 1)

            n = np.diff(firsts) + 1
            ids += row["doc_id"]
            held += row["held_out"]
            size += n.tolist()
            known += (summed((count > 0).astype(float)).astype(np.int64) + int(texts > 0)).tolist()
            plain += (summed(base) + math.log10(texts + 1) - n * math.log10(tokens + kinds + 1)).tolist()
            score += (summed(log) + lattice.value.end / _LN10).tolist()
        columns = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(size, pa.int64()), pa.array(known, pa.int64()),
                   pa.array([tokens] * len(ids), pa.int64()), pa.array(plain, pa.float64()), pa.array(score, pa.float64())]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    coded = blocks.select(F.col("block").alias("part"), "doc_id", "held_out", "firsts", "numbers")
    return coded.groupBy("part").cogroup(back.groupBy("block")).applyInArrow(sum_up, schema)
