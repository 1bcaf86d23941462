"""Audit of how document filters interact, with exact duplicates found by radix tries.

1. A pass over the texts gives each document a mask of the filters it fails. Texts go into a compressed trie for each run of
   about ``RUN`` bytes; its terminals hold the least id. A document above the least id of its run is a duplicate; its
   text goes no further, so a hot text leaves one row a run.
2. The other texts are range-partitioned by their first ``HEAD`` bytes, at prefixes that Spark picks from the data so that
   parts are even; texts with one head are dealt out by a hash of the whole text. A part is read in that order into tries of
   whole texts, and a traversal gives each document its duplicate flag. A trie ends where the order passes on, so memory is bounded.
3. Masks are counted by part and labels; all orders of the filters are read off these counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.workers import lean
from tidemill.sinks.layers import discard, store

FILTERS = "ABCDE"
RUN = 8 << 20
HEAD = 64
_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_LATER = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_NO_ID = (1 << 63) - 1


class Trie:
    """A compressed trie of byte strings. A node is ``[label, children, rows, least]``; terminals have rows and the least id of them."""

    def __init__(self) -> None:
        self.root = [b"", {}, None, None]

    def insert(self, text: bytes, doc_id: int, row: object) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, None, None]
                node[1][text[at]] = child
                node, at = child, len(text)
            elif text.startswith(child[0], at):
                node, at = child, at + len(child[0])
            else:
                common = _common(child[0], text, at)
                middle = [child[0][:common], {child[0][common]: child}, None, None]
                child[0] = child[0][common:]
                node[1][text[at]] = middle
                node, at = middle, at + common
        if node[2] is None:
            node[2], node[3] = [], doc_id
        node[2].append((doc_id, row))
        node[3] = min(node[3], doc_id)

    def __iter__(self) -> Iterator[tuple[object, bool]]:
        """Every row, and whether its text has a smaller id."""
        stack = [self.root]
        while stack:
            _, children, rows, least = stack.pop()
            for doc_id, row in rows or ():
                yield row, doc_id > least
            stack.extend(children.values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on (fewer than all)."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def failures(text: bytes) -> int:
    """The mask of the filters A to D that a text fails; bit 0 is A.

    A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * ``[A-Z]`` > 3 * code points. D: any of ``[#$%&*|]``.
    """
    words = text.split()  # bytes are split at \\x20 and \\x09-\\x0D
    capitals = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _LATER))
    signs = len(text.translate(None, _SIGNS)) < len(text)
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 3 * points) << 2 | signs << 3


def _masked(docs: DataFrame) -> DataFrame:
    """Stored rows ``doc_id``, ``part``, ``mask``, and ``text`` where another run may hold a smaller id of the same text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = Trie(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts):
                text = text.as_py()
                trie.insert(text, _NO_ID if doc_id is None else doc_id, (doc_id, part, failures(text), text))
                held += len(text)
                if held > RUN:
                    yield from _rows(trie)
                    trie, held = Trie(), 0
        yield from _rows(trie)

    rows = docs.select("doc_id", "part", "text").mapInArrow(lean(run), "doc_id long, part string, mask int, text binary")
    return store(rows, "masked")


def _rows(trie: Trie) -> Iterator[pa.RecordBatch]:
    """The rows of a trie with the duplicates' bit set and their text gone."""
    bit = 1 << FILTERS.index("E")
    held = []
    for (doc_id, part, mask, text), again in trie:
        held.append((doc_id, part, mask | bit * again, None if again else text))
        if len(held) == 1024:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "part", "mask", "text"])


def _flagged(masked: DataFrame) -> DataFrame:
    """The rows that still have a text, with the bit of duplicates by all documents."""
    bit = 1 << FILTERS.index("E")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, before = Trie(), 0, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "mask", "text", "head", "mix")))
            for doc_id, part, mask, text, head, mix in rows:
                if held > RUN and (head, mix) != before:
                    yield from flags(trie)
                    trie, held = Trie(), 0
                trie.insert(text, _NO_ID if doc_id is None else doc_id, (doc_id, part, mask))
                held, before = held + len(text), (head, mix)
        yield from flags(trie)

    def flags(trie: Trie) -> Iterator[pa.RecordBatch]:
        rows = [(doc_id, part, mask | bit * again) for (doc_id, part, mask), again in trie]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32()))], names=["doc_id", "part", "mask"])

    open_rows = masked.filter(F.col("text").isNotNull()).withColumns({"head": F.substring("text", 1, HEAD), "mix": F.xxhash64("text")})
    dealt = open_rows.repartitionByRange("head", "mix").sortWithinPartitions("head", "mix")
    return dealt.mapInArrow(lean(run), "doc_id long, part string, mask int")


def document_masks(docs: DataFrame, text: str = "text", part: str = "lang") -> DataFrame:
    """One stored row per document: ``doc_id``, ``part`` and ``mask`` (bit 0: fails A, to bit 4: fails E).

    A null text is empty. E fails if a smaller ``doc_id`` (castable to long; null counts as larger than all) has the same text. A
    null part is the empty text. Repeated rows stay.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    masked = _masked(docs.select(*columns))
    known = masked.filter(F.col("text").isNull()).select("doc_id", "part", "mask")
    masks = store(known.unionByName(_flagged(masked)), "masks")
    discard(masked)
    return masks


def _steps(spark) -> DataFrame:
    """For every order, step and mask: whether documents of the mask reach the step, fail its filter, fail it alone."""
    rows = [
        ("".join(order), step + 1, mask, not mask & sum(1 << FILTERS.index(f) for f in order[:step]), bool(mask >> FILTERS.index(order[step]) & 1), mask == 1 << FILTERS.index(order[step]))
        for order in permutations(FILTERS) for step in range(len(FILTERS)) for mask in range(1 << len(FILTERS))
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, mask int, reached boolean, fails boolean, alone boolean")


def audit(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, removed before), ``unique_fails`` (fail it only), ``good_lost`` and
    ``toxic_lost`` (removed by it, with a label ``quality`` or ``toxic`` of 1), ``shapley`` (removed by its filter over all orders). A document
    with several label rows has a label if one of them has; a null id has none. An empty table gives an empty one.
    """
    def has(column: str) -> Column:
        return F.max(F.coalesce(F.col(column) == 1, F.lit(False)))

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter(F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(has("quality").alias("good"), has("toxic").alias("toxic"))
    labelled = masks.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").select("part", "mask", "good", "toxic")
    nameless = masks.filter(F.col("doc_id").isNull()).select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    counts = labelled.unionByName(nameless).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    steps = counts.join(F.broadcast(_steps(masks.sparkSession)), "mask")  # 120 orders, 5 steps, 32 masks

    def over(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long")

    reached, fails = F.col("reached"), F.col("fails")
    report = steps.groupBy("part", "filter_order", "step").agg(
        over(reached & ~fails).alias("kept"), over(reached & fails).alias("removed"), over(~reached & fails).alias("redundant"),
        over(F.col("alone")).alias("unique_fails"), over(reached & fails, "good").alias("good_lost"), over(reached & fails, "toxic").alias("toxic_lost"),
    )
    letter = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return report.withColumn("shapley", F.sum("removed").over(letter))
