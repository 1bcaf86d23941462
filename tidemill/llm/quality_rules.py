"""Quality rules: word and line rules, then n-gram perplexity within bands of each language.

The language model is a modified Kneser-Ney model of order 4 over texts folded to 64 symbols. Spark counts its
n-grams over all documents, summed within each task before the shuffle. An alphabet of 64 bounds the model
at 64^4 n-grams, whatever the corpus. It is kept as sorted arrays of n-gram codes, found by binary search, once
for each different n-gram of a chunk of text.

A language's bands lie three interquartile ranges beyond the quartiles of the log perplexity of its documents
that pass the base rules, so a language without outliers loses no document. Only a language whose quartiles are equal
has a fixed range, ``LEAST_RANGE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import scan
from tidemill.llm.symbols import ORDER, SYMBOLS, codes, row_sums, symbols
from tidemill.sinks.layers import store

_HELD = 1 << 20
_MARKS = np.zeros(256, dtype=np.int64)
_MARKS[[ord(c) for c in "#*$%&|<>"]] = 1
#: Bands are this many interquartile ranges beyond the quartiles.
RANGES = 3.0
#: The range of a language whose quartiles are equal but for rounding, as of one document or of copies.
LEAST_RANGE = 0.05
_ROUNDING = 1e-6

MEASURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "log_perplexity": "double"}


def count_ngrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code`` and ``n`` of each n-gram of symbols over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total, held, size = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64), [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            some, n = np.unique(np.concatenate(held), return_counts=True)
            both, where = np.unique(np.concatenate([found, some]), return_inverse=True)
            return both, np.bincount(where, weights=np.concatenate([total, n]), minlength=len(both)).astype(np.int64)

        for batch in batches:
            for _, _, data, offsets in scan.chunks(batch.column(0)):
                held.append(codes(*symbols(data, offsets)))
                size += len(held[-1])
                if size > _HELD:
                    found, total = folded()
                    held, size = [], 0
        if held:
            found, total = folded()
        for part in range(0, len(found), 1 << 16):
            some = slice(part, part + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(found[some].astype(np.int64)), pa.array(total[some])], names=["code", "n"])

    return docs.select(text).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


@dataclass
class KneserNey:
    """Sorted codes with log probabilities, and sorted contexts with log backoff weights, of each order from 1."""

    grams: list[np.ndarray]
    chances: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]

    @classmethod
    def fit(cls, grams: np.ndarray, counts: np.ndarray) -> KneserNey:
        """From the counted n-grams of the highest order; lower orders count the symbols that precede an n-gram."""
        levels = [None] * ORDER
        order = np.argsort(grams)
        levels[-1] = (grams[order], counts[order].astype(np.float64))
        for k in range(ORDER - 1, 0, -1):
            shorter, kinds = np.unique(levels[k][0] % SYMBOLS**k, return_counts=True)
            levels[k - 1] = (shorter, kinds.astype(np.float64))
        model = cls([], [], [], [])
        for found, number in levels:
            low = model.log_chance(found % SYMBOLS ** len(model.grams)) if model.grams else np.full(len(found), -np.log(SYMBOLS))
            model._extend(found, number, np.exp(low))
        return model

    def _extend(self, found: np.ndarray, number: np.ndarray, low: np.ndarray) -> None:
        n1, n2, n3, n4 = (float((number == k).sum()) for k in (1, 2, 3, 4))
        discounts = np.array([0.0, 0.5, 1.0, 1.5])
        if n1 and n2 and n3:
            y = n1 / (n1 + 2 * n2)
            wanted = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            discounts[1:] = [min(max(d, 0.05), k - 0.05) for k, d in enumerate(wanted, 1)]
        taken = discounts[np.minimum(number, 3).astype(np.int64)]
        contexts, where = np.unique(found // SYMBOLS, return_inverse=True)
        total, left = np.bincount(where, weights=number), np.bincount(where, weights=taken)
        weight = left / total
        self.grams.append(found)
        self.chances.append(np.log((number - taken) / total[where] + weight[where] * low))
        self.contexts.append(contexts)
        self.weights.append(np.log(weight))

    def log_chance(self, wanted: np.ndarray, level: int | None = None) -> np.ndarray:
        """Log probability of the last symbol of each code after those before it."""
        level = len(self.grams) - 1 if level is None else level
        if level < 0:
            return np.full(len(wanted), -np.log(SYMBOLS))
        out, known = _look_up(self.grams[level], self.chances[level], wanted)
        if not known.all():
            rest = wanted[~known]
            weight, _ = _look_up(self.contexts[level], self.weights[level], rest // SYMBOLS)
            out[~known] = weight + self.log_chance(rest % SYMBOLS**level, level - 1)
        return out


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, 0 where there is none, and whether there is one."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0.0), known


def fit_model(docs: DataFrame, text: str = "text") -> KneserNey:
    counted = store(count_ngrams(docs, text), "ngrams").toArrow()
    return KneserNey.fit(counted.column("code").to_numpy(), counted.column("n").to_numpy())


def _keyed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Equal values of one row, as small numbers in order of their first place."""
    return pd.factorize(scan.mix(hashes + rows.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))[0]


def measure(texts: pa.Array, model: KneserNey) -> dict[str, np.ndarray]:
    """The measures of each text, as arrays."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name in MEASURES}
    for first, last, data, offsets in scan.chunks(texts):
        rows = last - first
        starts, ends, words = scan.words(data, offsets)
        hasher = scan.SpanHasher(data)
        n_words = np.diff(words)
        shown = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=shown[1:])
        of = scan.rows_of(words)
        chars = np.bincount(of, weights=shown[ends] - shown[starts], minlength=rows)

        repeated = np.zeros(len(starts), dtype=bool)
        if len(starts) >= 3:
            whole = np.flatnonzero(of[2:] == of[:-2])
            found = _keyed(scan.windows(hasher(starts, ends), 3)[whole], of[whole])
            again = whole[np.bincount(found)[found] > 1] if len(found) else whole
            for k in range(3):
                repeated[again + k] = True

        begin, end, lines = scan.lines(data, offsets)
        worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
        line_rows = scan.rows_of(lines)[worded]
        found = _keyed(hasher(begin[worded], end[worded]), line_rows)
        seen = np.maximum.accumulate(np.concatenate([[-1], found]))[:-1] if len(found) else found
        duplicates = np.bincount(line_rows[found <= seen], minlength=rows) if len(found) else np.zeros(rows)

        found, firsts = symbols(data, offsets)
        places, different = pd.factorize(codes(found, firsts))
        chance = model.log_chance(different.astype(np.int64))[places] if len(places) else np.zeros(0)
        sizes = np.diff(firsts)
        with np.errstate(invalid="ignore", divide="ignore"):
            perplexity = -row_sums(chance, firsts) / sizes
        marks = row_sums(_MARKS[data], offsets)
        values = (n_words, chars, marks, duplicates, np.bincount(of, weights=repeated, minlength=rows), perplexity)
        for name, value in zip(MEASURES, values):
            parts[name].append(value if name == "log_perplexity" else value.astype(np.int64))
    return {name: np.concatenate(p) if p else np.zeros(0) for name, p in parts.items()}


def apply_rules(docs: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None, model: KneserNey | None = None) -> DataFrame:
    """Measures and verdict of each document, beside its columns (or those of ``carry``).

    Words are ``[^\\x20\\x09-\\x0D]+``. ``n_words``; ``word_chars``, their code points; ``n_symbols``, characters of
    ``#*$%&|<>``; ``n_dup_lines``, lines with a word that equal an earlier line; ``n_repeat_words``, words in 3-word
    windows that the text has twice or more; ``log_perplexity`` a character (null without text); ``lower`` and
    ``upper`` band of the language; ``base_failed`` (under 50 words, or over half of them repeated) and ``kept``.
    A null text counts as empty and fails; a null language is a language of its own; repeated rows get equal values;
    an empty table gives an empty one. Columns with the new names are replaced.
    """
    new = [*MEASURES, "lower", "upper", "base_failed", "kept"]
    carry = [c for c in carry if c not in new] if carry is not None else [c for c in docs.columns if c not in new]
    model = model or fit_model(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*carry, F.col(text).alias("_text"), F.coalesce(F.col(lang), F.lit("")).alias("_lang"))
    kept_columns = [*carry, "_lang"]
    types = {name: T.DoubleType() if kind == "double" else T.LongType() for name, kind in MEASURES.items()}
    schema = T.StructType([*rows.select(kept_columns).schema, *[T.StructField(k, t) for k, t in types.items()]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column("_text"), shared.value)
            arrays = [pa.array(v, pa.float64() if k == "log_perplexity" else pa.int64(), from_pandas=True) for k, v in found.items()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept_columns], *arrays], names=[*kept_columns, *found])

    scored = store(rows.mapInArrow(score, schema), "measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.75], 10000).alias("q")
    bands = scored.filter(~failed).groupBy("_lang").agg(quartiles)
    spread = F.col("q")[1] - F.col("q")[0]
    wide = F.when(spread > _ROUNDING, spread).otherwise(LEAST_RANGE) * RANGES
    bands = store(bands.select("_lang", (F.col("q")[0] - wide).alias("lower"), (F.col("q")[1] + wide).alias("upper")), "bands")
    judged = scored.join(bands, "_lang", "left").drop("_lang")
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    judged = apply_rules(plain, names[docs.columns.index(text)], names[docs.columns.index(lang)])
    return judged.filter("kept").select(names).toDF(*docs.columns)
