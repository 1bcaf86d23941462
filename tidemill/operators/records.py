"""Typed records from JSON texts, with the reasons why a record does not fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_variant_timestamp
from tidemill.functions.jsons import filled
from tidemill.functions.numbers import looks_numeric

CORRUPT = "_corrupt"


def _text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _number(value: Column) -> Column:
    text = _text(value)
    plain = F.when(looks_numeric(text), text.try_cast("double"))
    return F.when(text.isNotNull(), plain).when(F.schema_of_variant(value) != "BOOLEAN", F.try_variant_get(value, "$", "double"))


def _whole(value: Column) -> Column:
    number = _number(value)
    return F.when((F.floor(number) == number) & (F.abs(number) < 2**53), number.cast("long"))


#: How a JSON value becomes each type: numbers also from number texts, times from ISO text or epoch milliseconds, texts only from texts.
READERS = {"string": _text, "double": _number, "bigint": _whole, "boolean": lambda v: F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean")), "timestamp_ntz": parse_variant_timestamp}


def judge_records(df: DataFrame, raw: str, fields: Mapping[str, str], required: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per JSON text: the columns ``keep``, the typed ``fields``, the text, and ``reasons``, empty for a good record.

    ``fields`` gives each field one of the types of ``READERS``. A required field must be there and not be null; a field of any
    other kind than its type is a reason, and so is a text that is no JSON object. Each text is parsed once.
    """
    parsed = df.select(*keep, F.col(raw).alias("_raw"), F.from_json(
        raw, ", ".join([*(f"`{f}` variant" for f in fields), f"{CORRUPT} string"]), {"columnNameOfCorruptRecord": CORRUPT}
    ).alias("_record"))
    parsed = parsed.select(*keep, "_raw", F.inline(F.array("_record")))  # keeps the parse from being copied into each field
    values = {f: F.col(f) for f in fields}
    typed = {f: READERS[kind](values[f]) for f, kind in fields.items()}
    broken = F.col("_raw").isNull() | (F.trim("_raw") == "") | F.col(CORRUPT).isNotNull()
    reasons = [F.when(broken, "no JSON object")]
    for f, kind in fields.items():
        if f in required:
            reasons.append(F.when(~broken & ~filled(values[f]), f"{f} is missing"))
        reasons.append(F.when(~broken & filled(values[f]) & typed[f].isNull(), f"{f} is no {kind}"))
    return parsed.select(*keep, *[c.alias(f) for f, c in typed.items()], F.col("_raw").alias(raw), F.array_compact(F.array(*reasons)).alias("reasons"))


def route_records(judged: DataFrame, raw: str, folder: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write judged records once, split by verdict; returns good records, rejected ones with their reasons, and how many of each.

    The folder has a partition per verdict, so reading one side never touches the other. Counts come with the write.
    """
    seen = Observation()
    bad = F.size("reasons") > 0
    counted = judged.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected"))
    counted.withColumn("verdict", F.when(bad, "rejected").otherwise("good")).write.partitionBy("verdict").parquet(folder)
    counts = dict(seen.get)
    stored = judged.sparkSession.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in judged.schema)}, verdict string").parquet(folder)
    good = stored.filter(F.col("verdict") == "good").drop("verdict", "reasons", raw)
    return good, stored.filter(F.col("verdict") == "rejected").drop("verdict"), counts
