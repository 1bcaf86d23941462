"""Packing: token pieces are put into windows of a fixed size by best fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.token_counts import balanced
from tidemill.llm.tokens import encode
from tidemill.sinks.layers import store

WINDOW = 2048
#: Pieces that one task packs together, on average. More make fuller windows; memory grows with it.
GROUP = 2048

PIECES = "row long, doc_id long, start long, length long, doc_tokens long, ids binary"


class OpenWindows:
    """Windows by remaining room, with a segment tree over the sizes 0 to ``size`` that finds the tightest fit."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.filled = [False] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int, value: bool) -> None:
        node = room + self.width
        self.filled[node] = value
        while node > 1:
            node >>= 1
            value = self.filled[2 * node] or self.filled[2 * node + 1]
            if self.filled[node] == value:
                break
            self.filled[node] = value

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        if len(self.windows[room]) == 1:
            self._mark(room, True)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return the window with the least room of at least ``length``, and its room."""
        node = length + self.width
        while not self.filled[node]:
            while node & 1:  # a right child: go on from the parent's next neighbour
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.width:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.width
        window = self.windows[room].pop()
        if not self.windows[room]:
            self._mark(room, False)
        return window, room


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; ``lengths`` come in decreasing order, each from 1 to ``size``."""
    tree, windows, offsets, opened = OpenWindows(size), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found = (opened, size)
            opened += 1
        window, room = found
        windows.append(window)
        offsets.append(size - room)
        if room > length:
            tree.put(room - length, window)
    return windows, offsets


def cut_tokens(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, text: str = "text") -> DataFrame:
    """Tokenise each text, end it with ``end_id``, and cut it into full windows and a rest.

    One row per piece: ``doc_id``, ``start`` (tokens of the document before it), ``length``, ``doc_tokens`` and
    ``ids`` (little-endian unsigned 32-bit values). ``row`` numbers the documents, as ``doc_id`` may be null or repeated.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in balanced(batch.column("text")):
                rows, ids = batch.slice(at, len(texts)), encode(texts, path)
                at += len(texts)
                out = {name: [] for name in ("row", "doc_id", "start", "length", "doc_tokens", "ids")}
                for row, doc, parts in zip(rows.column("row").to_pylist(), rows.column("doc_id").to_pylist(), ids):
                    whole = np.concatenate([*parts, np.array([end_id], np.uint32)]).astype("<u4")
                    for start in range(0, len(whole), window):
                        piece = whole[start : start + window]
                        for name, value in zip(out, (row, doc, start, len(piece), len(whole), piece.tobytes())):
                            out[name].append(value)
                kinds = {name: pa.binary() if name == "ids" else pa.int64() for name in out}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in out.items()], names=list(out))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (gapless from 0 in each sequence) to pieces of 1 to ``window`` tokens.

    A full piece is a sequence by itself and is not shuffled. The others are spread by a hash of their number into
    groups of about ``group`` pieces, whatever document or source they come from, and each group is packed by best
    fit decreasing: the longest first, into the open window that it fills best. ``pieces`` must be stored (it is
    read twice) and have ``piece``, a number that is different in each row. An empty table gives an empty one.
    """
    length = F.col("length")
    rest = pieces.filter(length < window)
    groups = max(1, -(-rest.count() // group))

    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("piece", "ascending")])
        windows, offsets = best_fit(table.column("length").to_pylist(), window)
        number = np.array(windows, dtype=np.int64) * groups + key[0].as_py()
        return (
            table.drop_columns(["_group"])
            .append_column("sequence_id", pa.array(2 * number + 1))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    full = pieces.filter(length >= window).withColumns({"sequence_id": F.col("piece") * 2, "offset": F.lit(0).cast("long")})
    packed = (
        rest.withColumn("_group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
        .groupBy("_group")
        .applyInArrow(place, schema)
    )
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, text: str = "text", digest: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``window`` tokens; one row per piece.

    Columns: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``; with
    ``digest``, ``ids_crc32`` in place of ``ids``, so that the ids themselves are never stored or shuffled.
    A null or empty text is the end token alone. Null and repeated ``doc_id`` are kept: every row is packed.
    An empty table gives an empty one; other columns of ``docs`` are not read.
    """
    pieces = cut_tokens(docs, path, end_id, window, text)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = store(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    return pack(pieces, window).drop("piece", "row")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``length`` and the joined ``ids`` of its pieces in order."""
    piece = F.struct("offset", "ids")
    joined = F.array_sort(F.collect_list(piece))  # at most as many as a window has tokens
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("_pieces")).select(
        "sequence_id", "length", F.aggregate("_pieces", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
