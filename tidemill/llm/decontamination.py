"""Benchmark decontamination by approximate matching with a proven candidate search.

An item of ``n`` characters may be found with up to ``budget(n)`` edits. Cut into one piece more than that, at least
one piece must occur unchanged wherever the item does. All pieces of a block of items are searched at once (an
automaton over each text), and the surroundings of a piece are verified by Myers' bit-parallel edit distance, where
enough short grams of the item occur. Items of one text are looked for once, and surroundings that overlap are read once.

Items come in blocks of at most ``BLOCK`` characters, each broadcast by itself, so a benchmark of any size passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed, of a hundred characters of the normalised item.
PERCENT = 6
BLOCK = 4 << 20
#: Items of fewer characters, normalised, are not looked for: they allow no edit and occur in ordinary prose.
LEAST = 17
GRAM = 4
SPAN = 512

_PLAIN = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(128)) + bytes(range(128, 256))


def normalise(text: str | None) -> str:
    """Lower-case letters, and one blank for each run of ASCII characters that are no letter or digit, and at both ends."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split()
    return f" {b' '.join(words).decode('utf-8', 'replace')} "


def budget(length: int, percent: int = PERCENT) -> int:
    return length * percent // 100


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into ``edits + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str) -> tuple[int, int]:
    """The least edit distance of the item to any part of the text, and where the first such part ends."""
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    size = len(item)
    ones, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best, end = ones, 0, size, size, 0
    for j, c in enumerate(text, 1):
        equal = places.get(c, 0)
        zero = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | (ones & ~(zero | plus)), plus & zero
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1, down << 1
        plus, minus = (down | ~(zero | up)) & ones, up & zero & ones
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds all items of a block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        import ahocorasick

        named: dict[str, list[int]] = {}
        for i, text in items:
            named.setdefault(text, []).append(i)
        self.items = [(ids, text, budget(len(text), percent)) for text, ids in named.items()]
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                found.setdefault(piece, []).append((number, at))
        self.search = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.search.add_word(piece, (len(piece), uses))
        self.search.make_automaton()

    def find(self, text: str, first: bool = False) -> dict[int, tuple[int, int]]:
        """For each item found: least distance and the end of that place. With ``first``, any one item is enough."""
        tried: dict[int, set[int]] = {}
        likely: dict[int, list[int]] = {}
        grams = Grams(text)
        for end, (length, uses) in self.search.iter(text):
            for number, at in uses:
                _, wanted, edits = self.items[number]
                slot = (end + 1 - length - at) // (edits + 1)
                done = tried.setdefault(number, set())
                if slot not in done:
                    done.add(slot)
                    if grams.allow(wanted, edits, *_around(slot, slot, wanted, edits)):
                        likely.setdefault(number, []).append(slot)
        best: dict[int, tuple[int, int]] = {}
        for number, slots in likely.items():
            ids, wanted, edits = self.items[number]
            places = []
            for low, high in _stretches(sorted(slots), wanted, edits):
                distance, place = best_match(wanted, text[low:high])
                if distance <= edits:
                    places.append((distance, low + place))
                    if first:
                        break
            if places:
                best.update(dict.fromkeys(ids, min(places)))
                if first:
                    break
        return best


def _around(start: int, stop: int, wanted: str, edits: int) -> tuple[int, int]:
    """Where an item that begins in one of these slots of ``edits + 1`` characters can lie."""
    return max(0, start * (edits + 1) - edits), max(0, (stop + 1) * (edits + 1) + len(wanted) + edits)


def _stretches(slots: list[int], wanted: str, edits: int) -> Iterator[tuple[int, int]]:
    """The surroundings of sorted slots, those that overlap as one."""
    start = stop = slots[0]
    for slot in [*slots[1:], None]:
        if slot is not None and _around(slot, slot, wanted, edits)[0] <= _around(start, stop, wanted, edits)[1]:
            stop = slot
            continue
        yield _around(start, stop, wanted, edits)
        start = stop = slot


class Grams:
    """Short grams of a text by stretches of ``SPAN`` characters, for a test that never refuses a match.

    An item is cut into grams that do not overlap, so each edit spoils at most one of them; all others occur unchanged
    where the item does.
    """

    def __init__(self, text: str):
        self.text = text
        self.known: dict[tuple[int, int], set[str]] = {}

    def allow(self, wanted: str, edits: int, low: int, high: int) -> bool:
        key = low // SPAN, (high - 1) // SPAN + 1
        here = self.known.get(key)
        if here is None:
            if len(self.known) >= 16:
                self.known.clear()
            stop = min(key[1] * SPAN, len(self.text))
            here = self.known[key] = {self.text[i : i + GRAM] for i in range(key[0] * SPAN, stop)}
        places = range(0, len(wanted) - GRAM + 1, GRAM)
        return sum(wanted[i : i + GRAM] in here for i in places) >= len(places) - edits


@lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[int, str], ...], percent: int) -> Matcher:
    return Matcher(list(items), percent)


def _item_blocks(benchmark: DataFrame, item: str, text: str, least: int) -> Iterator[tuple[tuple[int, str], ...]]:
    """The normalised items in blocks of bounded size; those of fewer than ``least`` characters, or without id, are not looked for."""
    rows = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK))
    for k in range(blocks):
        some = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).distinct().collect()
        found = tuple(sorted((i, n) for i, t in some if len(n := normalise(t)) - 2 >= max(least, 1)))
        if found:
            yield found


def find_items(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, text: str = "text", item: str = "item_id", item_text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document row and item found in it: ``doc_id``, ``item_id``, ``distance`` (edits), ``place`` (where it ends
    in the normalised text).

    Texts and items are compared as lower-case words with single blanks. An item is found where its edit distance to
    a part of the text is at most ``percent`` of its length. Items of fewer than ``least`` characters are not looked for.
    Null or empty texts hold no item, an item without words is in no text, an empty table on either side gives an empty one. Null and repeated ids stay; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, distance int, place long"
    spark, out = docs.sparkSession, None
    for block in _item_blocks(benchmark, item, item_text, least):
        shared = spark.sparkContext.broadcast(block)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, percent)
            for batch in batches:
                found = []
                for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    for key, (distance, place) in matcher.find(normalise(body)).items() if body else ():
                        found.append((doc, key, distance, place))
                columns = list(zip(*found)) or [(), (), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "distance", "place"])

        part = rows.mapInArrow(match, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, text: str = "text", item: str = "item_id", item_text: str = "text", least: int = LEAST) -> DataFrame:
    """The documents that hold no item of at least ``least`` characters, unchanged. One pass for each block of items, no shuffle."""
    names = docs.columns
    docs = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    for block in _item_blocks(benchmark, item, item_text, least):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared, at=names.index(text)) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, percent)
            for batch in batches:
                free = [not (body and matcher.find(normalise(body), first=True)) for body in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(free, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs.toDF(*names)
