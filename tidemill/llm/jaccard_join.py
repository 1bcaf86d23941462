"""Similarity self-join of documents on their sets of word n-grams, by prefixes of grouped sets.

Two sets with a Jaccard similarity of at least ``percent`` share a gram within their prefixes, the first
``n - ceil(percent * n / 100) + 1`` grams in one order of all grams. Steps:

1. Equal sets are one node (a 128-bit digest of the set). Nodes with the same prefix and size are one group.
2. Only groups put their prefix grams into the inverted index; a gram of a single group is dropped there.
3. Each node proposes a link to the most similar of the groups next to it in its index lists, or of its own
   group. These are verified and joined into components. Components need not be searched again inside.
4. Pairs of groups that meet in an index list are filtered by component, size, position in both prefixes and
   a bound on the difference (parities of hashed grams). A pair that met at one of the ``BEFORE`` grams before is
   not made again.
5. What is left is expanded to pairs of nodes of different components, bounded by wider parities and verified.

So a group of thousands of near copies costs a link for each, not one for each two, and no pair is lost. The
order of grams goes by how many sets hold them, the rarest first, as counted in ``COUNTERS`` hashed counters over all
documents; it decides the cost only. Grams are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import scan
from tidemill.llm.components import connected_components
from tidemill.llm.workers import lean
from tidemill.sinks.layers import discard, store

#: Counters of grams; as bytes of a logarithm they are broadcast.
COUNTERS = 1 << 22
_SLICE = 1 << 12
#: Groups that one task looks through for neighbours in the list of a gram; longer lists are dealt out.
LIST = 4096
#: Keys of documents to verify that are broadcast, at most (16 bytes each).
SENT = 1 << 21
#: Shared grams of a prefix before the one at hand that are looked at to make a pair once.
BEFORE = 16
_PARITY = 256  # bits
#: Least and most bits of a set's wide parities: about one for each gram.
_WIDE = (512, 1 << 15)


def gram_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct grams of each text; of a shorter text, its whole word sequence; of no words, none."""
    for first, last, data, offsets in scan.chunks(texts):
        data = scan.LOWER[data]
        starts, ends, words = scan.words(data, offsets)
        hashes = scan.SpanHasher(data)(starts, ends)
        grams = scan.windows(hashes, size) if len(hashes) >= size else hashes[:0]
        for k in range(last - first):
            begin, end = words[k], words[k + 1]
            if end - begin >= size:
                yield np.unique(grams[begin : end - size + 1])
            elif end > begin:
                yield scan.windows(hashes[begin:end], end - begin)
            else:
                yield hashes[:0]


def _levels(docs: DataFrame, size: int) -> np.ndarray:
    """For each counter, eight times the binary logarithm of (1 + the sets that hold one of its grams).

    A task counts in its own table, equal sets in a row of batches once, and passes it on in slices; a slice's tables
    are added as they come.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros(COUNTERS, dtype=np.uint32), set()
        for batch in batches:
            for grams in gram_sets(batch.column("text"), size):
                mark = hash(grams.tobytes())
                if mark not in seen:
                    seen.add(mark)
                    np.add.at(table, _counter(grams), np.uint32(1))
            if len(seen) > 1 << 18:
                seen = set()
        slices = [pa.compress(part.tobytes(), "zstd", asbytes=True) for part in table.reshape(-1, _SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(slices)), pa.int32()), pa.array(slices, pa.binary())], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(pa.decompress(packed.as_buffer(), _SLICE * 4, "zstd"), dtype=np.uint32)
                sums[k] = sums[k] + counts if k in sums else counts.astype(np.int64)
        levels = [np.minimum(np.round(8 * np.log2(1 + s)), 255).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])

    parts = docs.select("text").mapInArrow(lean(count), "slice int, counts binary").repartition("slice")
    out = np.zeros((COUNTERS // _SLICE, _SLICE), dtype=np.uint8)
    for row in parts.mapInArrow(lean(add), "slice int, levels binary").toArrow().to_pylist():
        out[row["slice"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return out.reshape(-1)


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def _prefix(grams: np.ndarray, percent: int, levels: np.ndarray) -> np.ndarray:
    length = len(grams) - -(-percent * len(grams) // 100) + 1
    return grams[np.argsort(levels[_counter(grams)], kind="stable")[:length]]


def _parities(grams: np.ndarray) -> np.ndarray:
    bits = np.bincount((grams % np.uint64(_PARITY)).astype(np.int64), minlength=_PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _wide_parities(grams: np.ndarray) -> bytes:
    size = min(max(_WIDE[0], 1 << (len(grams) - 1).bit_length() if len(grams) else 0), _WIDE[1])
    bits = np.bincount((grams % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def wide_difference(a: bytes, b: bytes) -> int:
    """At most the number of grams that only one of two sets has; the longer parities are folded to the shorter."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def _key(text: str, doc_id: str) -> Column:
    """A 128-bit digest of a row's text and id."""
    body = F.when(F.col(text).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(text)))
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), body)))


def _sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A stored row per document: ``doc_id``, ``key`` (of its row), ``n`` (set size), ``node``, ``prefix`` and its ``mark``, ``parity``, ``wide``."""
    shared = docs.sparkSession.sparkContext.broadcast(_levels(docs, size))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, prefixes, marks, parities, wide = [], [], [], [], [], []
            for grams in gram_sets(batch.column("text"), size):
                sizes.append(len(grams))
                nodes.append(blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                prefix = _prefix(grams, percent, shared.value).view(np.int64) if len(grams) else grams.view(np.int64)
                prefixes.append(prefix)
                marks.append(blake2b(prefix.tobytes(), digest_size=16).digest())
                parities.append(_parities(grams))
                wide.append(_wide_parities(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(marks, pa.binary()), pa.array(parities, pa.list_(pa.int64())), pa.array(wide, pa.binary())],
                names=["doc_id", "key", "n", "node", "prefix", "mark", "parity", "wide"],
            )

    rows = docs.select("doc_id", "text", _key("text", "doc_id").alias("key"))
    schema = "doc_id long, key binary, n long, node binary, prefix array<long>, mark binary, parity array<long>, wide binary"
    return store(rows.mapInArrow(lean(sketch), schema), "sketches")


def _fits(small: Column, large: Column, percent: int) -> Column:
    """Sizes whose ratio allows the similarity."""
    return 100 * small >= percent * large


def _difference(a: Column, b: Column) -> Column:
    """At most the number of grams that only one of two sets has."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, _PARITY // 64)), F.bit_count(a[0].bitwiseXOR(b[0])))


def _close(a: str, b: str, percent: int) -> Column:
    difference = _difference(F.col(f"{a}.parity"), F.col(f"{b}.parity"))
    return difference * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)


def _narrowed(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those pairs of nodes that the wide parities leave possible."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "wide_a", "wide_b")]
            mask = [wide_difference(x, y) * (100 + percent) <= (n + m) * (100 - percent) for n, m, x, y in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    sizes = nodes.select("node", "n", "wide")
    both = pairs.join(sizes.toDF("a", "n_a", "wide_a"), "a").join(sizes.toDF("b", "n_b", "wide_b"), "b")
    return both.mapInArrow(lean(possible), "a binary, b binary")


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those stored pairs ``a``, ``b`` of nodes whose sets have the similarity, from the whole texts of one document each. ``pairs`` goes.

    Keys of up to ``SENT`` documents are broadcast, so that no text is shuffled; more are joined by shuffle.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(gram_sets(batch.column("text"), size))
            nodes = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "grams"])

    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = store(nodes.join(ends, "node").select(F.col("key").alias("_key")), "wanted")
    keys = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    texts = docs.select("text", _key("text", "doc_id").alias("_key")).join(keys, "_key", "left_semi")
    sets = store(texts.select("text").mapInArrow(lean(grams), "node binary, grams array<long>").dropDuplicates(["node"]), "sets")
    both = pairs.join(sets.toDF("a", "grams_a"), "a").join(sets.toDF("b", "grams_b"), "b")
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.size("grams_a") + F.size("grams_b") - common
    links = store(both.filter(100 * common >= percent * union).select("a", "b"), "links")
    discard(pairs, wanted, sets)
    return links


def _index(sketches: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The stored index of groups: ``gram``, ``group``, ``n``, ``pos`` and up to three groups before it in the gram's list.

    Lists go by size. A gram of one group is left out, and one whose neighbours in the list have no fitting size. Lists
    longer than ``LIST`` are dealt out over several tasks, and stay as they are.
    """
    leaders = nodes.filter(F.col("node") == F.col("group")).select("node", "n")
    once = sketches.filter(F.col("n") > 0).select("node", "prefix").dropDuplicates(["node"])  # equal sets have one prefix
    entries = once.join(leaders, "node").select(F.col("node").alias("group"), "n", F.posexplode("prefix").alias("pos", "gram"))
    lengths = entries.groupBy("gram").agg(F.count("*").alias("length")).filter("length > 1")
    shares = F.ceil(F.col("length") / LIST)
    entries = entries.join(lengths, "gram").withColumn("share", F.pmod(F.xxhash64("group"), shares))
    listed = Window.partitionBy("gram", "share").orderBy("n", "group")
    near = [F.lag(F.struct("group", "n"), k).over(listed).alias(f"near{k}") for k in (1, 2, 3)]
    n, alone = F.col("n"), F.lit(False)
    fits = F.coalesce(_fits(F.col("near1.n"), n, percent), alone) | F.coalesce(_fits(n, F.col("next_n"), percent), alone)
    index = entries.select("*", *near, F.lead("n").over(listed).alias("next_n")).filter(fits | (F.col("length") > LIST))
    return store(index.select("gram", "group", "n", "pos", "near1", "near2", "near3"), "index")


def _group_pairs(index: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Stored pairs ``g``, ``h`` of groups that may hold similar nodes of different components, once or nearly so.

    ``groups`` has ``component`` (null if mixed), ``parity`` (null unless the group is one node).
    """
    entries = index.select("gram", "group", "n", "pos").join(groups.select("group", "component"), "group")
    mixed = entries.groupBy("gram").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count_if(F.col("component").isNull()).alias("unsure")
    ).filter((F.col("least") != F.col("most")) | (F.col("unsure") > 0)).select("gram")
    entries = entries.drop("component").join(mixed, "gram", "left_semi").join(groups, "group")
    earlier = Window.partitionBy("group").orderBy("pos").rowsBetween(-BEFORE, -1)
    lists = store(entries.withColumn("before", F.collect_list("gram").over(earlier)), "lists")
    x, y = lists.alias("x"), lists.alias("y")
    both = F.col("x.n") + F.col("y.n")
    in_order = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.group") < F.col("y.group")))
    apart = F.coalesce(F.col("x.component") != F.col("y.component"), F.lit(True))
    # At the first common gram, what both can still have in common must reach the overlap needed.
    reach = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) * (100 + percent) >= percent * both
    seen = F.arrays_overlap("x.before", "y.before")
    close = F.coalesce(_close("x", "y", percent), F.lit(True))
    pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & in_order & apart & _fits(F.col("x.n"), F.col("y.n"), percent) & reach & close & ~seen)
    pairs = store(pairs.select(F.col("x.group").alias("g"), F.col("y.group").alias("h")).distinct(), "group-pairs")
    discard(lists)
    return pairs


def link_documents(docs: DataFrame, size: int = 3, percent: int = 90, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``key``, ``n_shingles``, ``component_id``, ``component``.

    Documents link when the Jaccard similarity of their sets of ``size``-word shingles (words split at ASCII white
    space, A-Z lower-cased) is at least ``percent`` / 100, exactly; ``component_id`` is the least ``doc_id`` reachable
    over links. A text with fewer words has one shingle, all of them; a null text or one without words has none and is
    linked with nothing. Every row stays, repeated rows and null ids too (a null id counts only where a component has
    no other). ``doc_id`` must be castable to long. ``key`` is a digest of text and id, ``component`` names the linked
    group (null without words). Other columns are not read. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = _sketches(docs, size, percent)
    first = F.min(F.struct("doc_id", "key", "n", "mark", "parity", "wide")).alias("first")
    nodes = sketches.filter(F.col("n") > 0).groupBy("node").agg(first, F.min("doc_id").alias("least_id")).select("node", "first.*", "least_id")
    plain = store(nodes, "sets")
    leaders = plain.groupBy("n", "mark").agg(F.min("node").alias("group"), F.count("*").alias("members"))
    nodes = store(plain.join(leaders, ["n", "mark"]), "nodes")
    discard(plain)
    index = _index(sketches, nodes, percent)

    # A link for each node to the closest neighbour before it.
    sketch = nodes.select("node", "n", "parity")
    n = F.col("n")
    neighbours = index.select("group", F.explode(F.array("near1", "near2", "near3")).alias("near"), "n").filter(_fits(F.col("near.n"), n, percent))
    proposed = neighbours.select(F.col("group").alias("a"), F.col("near.group").alias("b")).unionByName(
        nodes.filter(F.col("node") != F.col("group")).select(F.col("node").alias("a"), F.col("group").alias("b"))
    )
    compared = proposed.distinct().join(sketch.alias("x"), F.col("a") == F.col("x.node")).join(sketch.alias("y"), F.col("b") == F.col("y.node"))
    distance = _difference(F.col("x.parity"), F.col("y.parity"))
    best = compared.filter(_close("x", "y", percent)).groupBy("a").agg(F.min(F.struct(distance, "b")).alias("best"))
    links = _verified(docs, nodes, store(_narrowed(nodes, best.select("a", "best.b"), percent), "proposed"), size, percent)
    found = connected_components(links)

    # All other pairs that may be similar lie in different components: first of groups, then of their members.
    member = store(nodes.join(found, "node", "left").select("node", "n", "parity", "group", "members", F.coalesce("component", "node").alias("component")), "members")
    same = F.min("component") == F.max("component")
    groups = store(member.groupBy("group").agg(
        F.when(same, F.min("component")).alias("component"), F.when(F.count("*") == 1, F.min("parity")).alias("parity"),
    ), "groups")
    met = _group_pairs(index, groups, percent)
    own = groups.filter(F.col("component").isNull()).select(F.col("group").alias("g"), F.col("group").alias("h"))
    x, y = member.alias("x"), member.alias("y")
    opened = met.unionByName(own).join(x, F.col("g") == F.col("x.group"))
    apart = (F.col("x.component") != F.col("y.component")) & ((F.col("g") != F.col("h")) | (F.col("x.node") < F.col("y.node")))
    pairs = opened.join(y, (F.col("h") == F.col("y.group")) & apart & _close("x", "y", percent))
    pairs = pairs.select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))
    more = _verified(docs, nodes, store(_narrowed(nodes, pairs, percent), "pairs"), size, percent)
    discard(index, groups, met, found, links)

    # Components that the second links join: only these are contracted again.
    home = member.select("node", "component")
    across = more.join(home.toDF("a", "x"), "a").join(home.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = connected_components(across)
    discard(more)
    labelled = nodes.select("node", "least_id").join(home, "node").join(joined.toDF("component", "whole"), "component", "left")
    labelled = labelled.select("node", "least_id", F.coalesce("whole", "component").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = store(labelled.join(least, "component").select("node", "component_id", "component"), "labels")
    discard(nodes, member, joined)
    return sketches.select("doc_id", "key", "n", "node").join(labels, "node", "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "component"
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """Documents without their near copies: of each linked group, the one with the least id (null last) stays, as it is.

    Documents without words stay, all of them. Of rows with equal id and text one stays.
    """
    linked = link_documents(docs, size, percent, text)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    kept = linked.filter(F.col("n_shingles") > 0).groupBy("component").agg(first)
    kept = kept.select(F.col("first.key").alias("_key")).unionByName(linked.filter(F.col("n_shingles") == 0).select(F.col("key").alias("_key"))).distinct()
    plain = docs.toDF(*[f"_p{i}" for i in range(len(docs.columns))])
    body, number = (f"_p{docs.columns.index(c)}" for c in (text, "doc_id"))
    marked = plain.withColumn("_long", F.col(number).cast("long")).withColumn("_key", _key(body, "_long")).drop("_long")
    return marked.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key").toDF(*docs.columns)
