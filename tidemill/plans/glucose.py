"""Glucose-monitor records: entries, treatments, profiles, device status, and their target tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.dates import parse_variant_timestamp
from tidemill.functions.jsons import (
    checked_number, parse_records, row_as_json, scalar_or_member, strict_number, without_keys,
)
from tidemill.functions.numbers import mmol_per_litre
from tidemill.sinks.tables import counted
from tidemill.sinks.versioned import publish, upsert_table
from tidemill.sources.files import read_lines
from tidemill.sources.landed import time_range

ENTRY = (
    "_id string, device string, date variant, dateString string, sgv variant, direction string, type string, "
    "filtered variant, unfiltered variant, rssi variant, noise variant, sysTime string, utcOffset variant"
)
TREATMENT = (
    "_id string, eventType variant, created_at variant, enteredBy string, notes string, insulin variant, "
    "carbs variant, duration variant, rate variant, percent variant, absolute variant, device string"
)
SETTINGS = (
    "dia:double, carbs_hr:double, carbratio:variant, sens:variant, basal:variant, target_low:variant, "
    "target_high:variant, units:string, timezone:string"
)
PROFILE = (
    "_id string, created_at variant, startDate string, defaultProfile string, "
    f"store map<string, struct<{SETTINGS}>>"
)
DEVICE_STATUS = (
    "_id string, created_at variant, device string, "
    "pump struct<clock:string, reservoir:variant, battery:variant, status:variant, iob:variant>, "
    "uploader struct<battery:variant, name:string>, "
    "loop struct<enacted:variant, predicted:variant, iob:variant, cob:variant>"
)

# The numeric fields that each type of treatment carries, and their types.
NUMBERS_BY_TYPE = {
    "bolus": ["insulin", "duration"],
    "carbs": ["carbs"],
    "combo bolus": ["insulin", "carbs"],
    "temp basal": ["rate", "duration", "percent", "absolute"],
    "site change": [],
    "sensor change": [],
    "announcement": [],
    "exercise": ["duration"],
}
NUMBER_TYPES = {
    "insulin": "double",
    "carbs": "double",
    "duration": "int",
    "rate": "double",
    "percent": "int",
    "absolute": "double",
}
DEVICE_TYPES = ["site change", "sensor change"]
COMMON_FIELDS = ["_id", "id", "type", "created_at", "enteredBy", "notes"]


def entries(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Sensor readings, with the value also in mmol/L. A value of another kind than its field fails the job."""
    sgv = F.col("_sgv")
    parsed = parse_records(df, raw, ENTRY).withColumn("_sgv", checked_number(F.col("sgv"), "double", "sgv", text=False))
    return parsed.select(
        F.col("_id").alias("id"),
        "device",
        parse_variant_timestamp(F.col("date")).alias("date"),
        "dateString",
        sgv.alias("sgv"),
        mmol_per_litre(sgv).alias("sgv_mmol"),
        "direction",
        "type",
        *[checked_number(F.col(c), "double", c).alias(c) for c in ("filtered", "unfiltered")],
        *[checked_number(F.col(c), "int", c).alias(c) for c in ("rssi", "noise")],
        F.col("sysTime").alias("sys_time"),
        checked_number(F.col("utcOffset"), "int", "utcOffset").alias("utc_offset"),
    )


def _treatment_number(name: str) -> Column:
    """The number where the type carries it (0 when absent, null fails), a copy for unknown types."""
    field, dtype = F.col(name), NUMBER_TYPES[name]
    carrying = [kind for kind, names in NUMBERS_BY_TYPE.items() if name in names]
    return (
        F.when(F.col("type").isin(carrying), strict_number(field, dtype, name))
        .when(~F.col("type").isin(list(NUMBERS_BY_TYPE)), F.try_variant_get(field, "$", dtype))
        .alias(name)
    )


def treatments(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Treatments as one wide row; all fields of unknown types are also kept in the map ``extras``."""
    parsed = parse_records(df.select(F.col(raw).alias("_raw")), "_raw", TREATMENT, keep=["_raw"])
    event = F.col("eventType")
    kind = (
        F.when(event.isNull(), "")
        .when(F.is_variant_null(event), F.raise_error(F.lit("eventType is null")))
        .otherwise(F.lower(event.cast("string")))
    )
    typed = parsed.withColumn("type", kind)
    known = F.col("type").isin(list(NUMBERS_BY_TYPE))
    return typed.select(
        F.col("_id").alias("id"),
        "type",
        parse_variant_timestamp(F.col("created_at")).alias("created_at"),
        "enteredBy",
        "notes",
        *[_treatment_number(name) for name in NUMBER_TYPES],
        F.when(F.col("type").isin(DEVICE_TYPES) | ~known, F.col("device")).alias("device"),
        F.when(~known, without_keys(F.col("_raw"), COMMON_FIELDS)).alias("extras"),
    )


def profiles(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Profiles with the settings of their default profile, null when it is not in the store."""
    chosen = F.when(F.col("defaultProfile") != "", F.try_element_at("store", F.col("defaultProfile")))
    rows = parse_records(df, raw, PROFILE).withColumn("_chosen", chosen)
    return rows.select(
        F.col("_id").alias("id"), parse_variant_timestamp(F.col("created_at")).alias("created_at"), "startDate", "_chosen.*"
    )


def _member(value: Column, name: str) -> Column:
    """A number of a JSON object; null where there is no object or no such member."""
    return checked_number(F.try_variant_get(value, f"$.{name}", "variant"), "double", name)


def device_status(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Device status with the pump, uploader and loop parts that the record has. A value that is no number fails the job."""
    pump, uploader, loop = F.col("pump"), F.col("uploader"), F.col("loop")
    insulin_on_board = checked_number(scalar_or_member(pump["iob"], "bolusiob", "variant"), "double", "pump.iob")
    return parse_records(df, raw, DEVICE_STATUS).select(
        F.col("_id").alias("id"),
        parse_variant_timestamp(F.col("created_at")).alias("created_at"),
        "device",
        F.when(
            pump.isNotNull(),
            pump.withField("reservoir", checked_number(pump["reservoir"], "double", "reservoir")).withField("iob", insulin_on_board),
        ).alias("pump"),
        uploader.alias("uploader"),
        F.when(
            loop.isNotNull(),
            loop.withField("iob", _member(loop["iob"], "netInsulin")).withField("cob", _member(loop["cob"], "cob")),
        ).alias("loop"),
    )


# The field that a time range applies to, per record set; profiles are read in full.
TIME_FIELDS = {"entries": "date", "treatments": "created_at", "devicestatus": "created_at"}


def recent(df: DataFrame, name: str, as_of: Any = None, days: int = 1, limit: int | None = None, raw: str = "raw") -> DataFrame:
    """Records of a set within the last days, with ``limit`` only the newest of them; profiles are never cut.

    The time may be epoch milliseconds or ISO text, as the transforms take both.
    """
    if name not in TIME_FIELDS:
        return df
    field = TIME_FIELDS[name]
    parsed = df.select("*", F.inline(F.array(F.from_json(raw, f"{field} variant"))).alias("_time"))
    # Both go through inline (see parse_records): the range compares twice, and would parse for each comparison.
    timed = parsed.select(*df.columns, F.inline(F.array(F.struct(parse_variant_timestamp(F.col("_time")).alias("_at")))))
    return time_range(timed, "_at", as_of, days, limit, tie_breaker=raw).drop("_at")


def read_bundle(
    spark: SparkSession, landing: str, as_of: Any = None, days: int = 1, limit: int | None = None
) -> dict[str, DataFrame]:
    """The four record sets of a landing folder, one JSON record per line under ``<landing>/<set>``."""
    return {
        name: recent(read_lines(spark, f"{landing}/{name}").withColumnRenamed("value", "raw"), name, as_of, days, limit)
        for name in TRANSFORMS
    }


TRANSFORMS = {"entries": entries, "treatments": treatments, "profiles": profiles, "devicestatus": device_status}


def transform(bundle: Mapping[str, DataFrame], raw: str = "raw") -> dict[str, DataFrame]:
    """Transform every record set of a bundle; sets that are not there are left out."""
    return {name: TRANSFORMS[name](df, raw) for name, df in bundle.items()}


# The target tables, each keyed by id.
TARGETS = {
    "entries": (
        "id string, device string, date timestamp_ntz, sgv int, sgv_mmol double, direction string, type string, "
        "filtered double, unfiltered double, rssi int, noise int, sys_time string, utc_offset int, raw_data string"
    ),
    "treatments": (
        "id string, type string, created_at timestamp_ntz, entered_by string, insulin double, carbs double, "
        "duration int, rate double, percent int, absolute double, notes string, raw_data string"
    ),
    "profiles": (
        "id string, created_at timestamp_ntz, start_date string, timezone string, dia double, units string, "
        "raw_data string"
    ),
    "devicestatus": "id string, created_at timestamp_ntz, device string, raw_data string",
}
TARGET_TABLES = {name: f"nightscout_{name}" for name in TARGETS}
RENAMED = {"enteredBy": "entered_by", "startDate": "start_date"}


def to_target(name: str, df: DataFrame) -> DataFrame:
    """Shape transformed records like their target table; a record without id fails the job."""
    fields = T.StructType.fromDDL(TARGETS[name])
    rows = row_as_json(df).withColumnsRenamed(RENAMED)
    no_id = F.raise_error(F.lit(f"{name}: a record has no id")).cast("boolean")
    keyed = rows.filter(F.when(F.col("id").isNull(), no_id).otherwise(True))
    return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def load(
    spark: SparkSession, bundle: Mapping[str, DataFrame], root: str, schema: str = "default", upsert: bool = True
) -> int:
    """Load transformed record sets into their tables, by upsert on id or by plain append.

    Returns the number of records loaded. Records of one set must have distinct ids.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    total = 0
    for name, df in bundle.items():
        rows = to_target(name, df)
        table = f"{schema}.{TARGET_TABLES[name]}"
        root_of_table = f"{root}/{TARGET_TABLES[name]}"
        if upsert:
            total += upsert_table(rows, table, root_of_table, ["id"])
        elif spark.catalog.tableExists(table):
            rows, seen = counted(rows)
            rows.write.insertInto(table)
            total += seen.get["rows"]
        else:
            total += publish(rows, table, root_of_table)
    return total
