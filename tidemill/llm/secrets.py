"""Secret scans: plain patterns, and weak candidates that count only where complementary parts come together.

Weak parts are access identifiers (``ident``), values that look like a secret (``value``) and endpoints (``endpoint``).
Each is put in all buckets of the scope's length that it covers, summed up for each bucket and joined by interval: a part
reaches all others that begin or end at most ``SCOPE`` characters from it, however long they are. An identifier is reported with a secret in reach (base findings
count as well), a value with an identifier or an endpoint, an endpoint with both.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sinks.layers import store

SCOPE = 400
KINDS = ("assign", "access", "hex", "ident", "value", "endpoint")

_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of hex digits that are long enough
_IDENT = re.compile(r"(?ai:access_?key_?id|client_?id|account_?id|user_?name|user|login|key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@+-]{3,})|(?a:\b(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{12,})")
_PASS = re.compile(r"(?ai:\b(?:pass|pwd|passphrase|credential|auth_?key|access_?key|private_?key|signature))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{8,})")
_LOOSE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_POINT = re.compile(r"(?ai:\b(?:https?|ssh|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|\b(?:host(?:name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9.-]+(?::[0-9]+)?)")

#: Rows that can hold anything at all, by a fast search that never misses a match: the start of each pattern above,
#: without its bounds and lengths.
_MAYBE_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
_MAYBE_HEX = r"[0-9a-f]{32}"
_MAYBE_WEAK = (
    r"(?i)(access_?key_?id|client_?id|account_?id|user_?name|user|login|key_?id|pass|pwd|passphrase|credential|auth_?key|access_?key|private_?key|signature"
    r"|host|hostname|endpoint|server)[\"']?\x20*[:=]|ASIA|AIDA|AROA|AGPA|://|[a-z0-9+/_=-]{20}"
)


def _base(text: str, assign: bool, digits: bool) -> list[tuple[int, int, int]]:
    found = []
    if assign:
        found += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if digits:
        found += [(2, *m.span()) for m in _HEX.finditer(text)]
    return found


def _random_looking(value: str) -> bool:
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return kinds == 3 and entropy >= 3.5


def _weak(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts that no base finding overlaps. Base findings are ordered by start."""
    found = [(3, *m.span()) for m in _IDENT.finditer(text)]
    found += [(4, *m.span()) for m in _PASS.finditer(text)]
    found += [(4, *m.span()) for m in _LOOSE.finditer(text) if _random_looking(m[0])]
    found += [(5, *m.span()) for m in _POINT.finditer(text)]
    starts, reached = [a for _, a, _ in base], list(accumulate((b for _, _, b in base), max))
    out, last = [], 0
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        before = bisect_left(starts, b)
        if a >= last and (not before or reached[before - 1] <= a):
            out.append((kind, a, b))
            last = b
    return out


def scan_texts(texts: pa.Array) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Base findings and weak parts of each text: kind (place in ``KINDS``), start and end in code points."""
    texts = pc.fill_null(texts, "")
    masks = [pc.match_substring_regex(texts, p).to_pylist() for p in (_MAYBE_ASSIGN, _MAYBE_HEX, _MAYBE_WEAK)]
    access = pc.match_substring(texts, "AKIA").to_pylist()
    for i, (assign, digits, weak, key) in enumerate(zip(*masks, access)):
        if not (assign or digits or weak or key):
            yield [], []
            continue
        text = texts[i].as_py()
        base = sorted(_base(text, assign, digits), key=lambda x: (x[1], x[0]))
        yield base, (_weak(text, base) if weak or base else [])


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _linked(scanned: DataFrame, scope: int) -> DataFrame:
    """``row`` and ``linked``, the weak spans of a text that have their complement in reach."""
    role = lambda kind: F.when(kind.isin(1, 3), 0).when(kind == 5, 2).otherwise(1)
    both = F.concat("base", "weak")
    several = F.size(F.array_distinct(F.transform(both, lambda s: role(s["kind"])))) > 1
    parts = scanned.filter((F.size("weak") > 0) & several).select("row", F.inline(both)).withColumn("role", role(F.col("kind")))
    covered = parts.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    ends = covered.groupBy("row", "bucket", "role").agg(F.min("start").alias("least"), F.max("end").alias("most"))
    around = F.sequence(F.floor(F.col("start") / scope) - 1, F.floor(F.col("end") / scope) + 1)
    weak = parts.filter(F.col("kind") > 2).withColumn("near", F.explode(around))
    p, e = weak.alias("p"), ends.alias("e")
    reach = (F.col("e.most") >= F.col("p.start") - scope) & (F.col("e.least") <= F.col("p.end") + scope)
    met = p.join(e, (F.col("p.row") == F.col("e.row")) & (F.col("p.near") == F.col("e.bucket")) & (F.col("p.role") != F.col("e.role")) & reach)
    met = met.groupBy("p.row", "p.kind", "p.start", "p.end").agg(*[F.max((F.col("e.role") == k).cast("int")).alias(f"r{k}") for k in range(3)])
    ident, value, point = F.col("r0") == 1, F.col("r1") == 1, F.col("r2") == 1
    complete = F.when(F.col("kind") == 3, value).when(F.col("kind") == 4, ident | point).otherwise(ident & value)
    return met.filter(complete).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))


def find_secrets(docs: DataFrame, text: str = "text", carry: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """Add ``base`` and ``spans``: base findings, and with them the linked weak parts, as ``kind``, ``start``, ``end``.

    Kinds are places in ``KINDS``; places count code points, the end is exclusive; spans are ordered by start, then kind.
    Base findings are leftmost and do not overlap within a kind. A null or empty text has none. Every row stays, with
    its columns (or those of ``carry``); ``base`` and ``spans`` are replaced. An empty table gives an empty one.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("base", "spans")]
    rows = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text).alias("scanned"))
    kept = [f"_c{i}" for i in range(len(carry))]
    schema = T.StructType([*rows.select(kept).schema, T.StructField("base", _SPAN), T.StructField("weak", _SPAN)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(scan_texts(batch.column("scanned")))
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[k]] for x in found], _ARROW_SPAN) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *spans], names=[*kept, "base", "weak"])

    scanned = store(rows.mapInArrow(scan, schema).withColumn("row", F.monotonically_increasing_id()), "secrets")
    linked = store(_linked(scanned.select("row", "base", "weak"), scope), "linked")  # its size decides how it is joined
    joined = scanned.join(linked, "row", "left")
    none = F.array().cast(_SPAN)
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    spans = F.array_sort(F.concat("base", F.coalesce("linked", none)), order)
    return joined.select(*[F.col(k).alias(c) for k, c in zip(kept, carry)], "base", spans.alias("spans"))


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; ``n_chars``, where there is one, follows the new text."""
    given = docs.columns
    names = [f"_p{i}" for i in range(len(given))]
    body = names[given.index(text)]
    docs = docs.toDF(*names)
    found = find_secrets(docs, body)
    hit = F.size("spans") > 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(body).to_pylist(), batch.column("spans").to_pylist()
            for i, some in enumerate(spans):
                out, at = [], 0
                for s in some or ():
                    if s["start"] >= at:
                        out += [texts[i][at : s["start"]], mark]
                    at = max(at, s["end"])
                if some:
                    texts[i] = "".join([*out, texts[i][at:]])
            columns = [pa.array(texts, batch.schema.field(c).type) if c == body else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    changed = found.filter(hit).select(*names, "spans").mapInArrow(cut, docs.schema)
    if "n_chars" in given:
        count = names[given.index("n_chars")]
        changed = changed.withColumn(count, F.length(body).cast(docs.schema[count].dataType))
    return found.filter(~hit).select(names).unionByName(changed).toDF(*given)
