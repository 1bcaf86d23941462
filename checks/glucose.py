"""Glucose-monitor queries. The JSON is built from events and customers, the expected result is not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import query, table
from tidemill.functions.dates import to_instant
from tidemill.plans import glucose
from tidemill.sources.landed import glucose_readings, time_range

NOON = "2024-01-20 12:00:00"

ENTRIES = """
    SELECT concat('{"_id":"e', event_id, '","device":"dev-', user_id, '","date":',
        CASE event_type WHEN 'click' THEN concat('"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), 'Z"')
                        WHEN 'error' THEN '0' WHEN 'signup' THEN '1.5' WHEN 'view' THEN '"no date"'
                        ELSE CAST(unix_millis(CAST(convert_timezone('UTC', current_timezone(), ts) AS TIMESTAMP)) AS STRING) END,
        ',"dateString":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), 'Z"',
        CASE event_type WHEN 'signup' THEN ',"sgv":null' WHEN 'error' THEN ''
                        ELSE concat(',"sgv":', CAST(floor(value) AS STRING)) END,
        ',"direction":"Flat","type":"', event_type, '","rssi":', CAST(user_id AS STRING),
        CASE WHEN event_type = 'click' THEN ',"filtered":101.5,"noise":1' ELSE '' END,
        ',"sysTime":"', CAST(CAST(ts AS DATE) AS STRING), '","utcOffset":60}') AS raw
    FROM {events}
"""

TREATMENTS = """
    SELECT to_json(named_struct(
        '_id', concat('t', event_id),
        'eventType', CASE event_type
            WHEN 'purchase' THEN CASE WHEN value < 50 THEN 'Bolus' ELSE 'Combo Bolus' END
            WHEN 'click' THEN CASE WHEN value < 50 THEN 'Carbs' ELSE 'Announcement' END
            WHEN 'view' THEN 'Temp Basal'
            WHEN 'signup' THEN CASE WHEN value < 50 THEN 'Site Change' ELSE 'Sensor Change' END
            ELSE CASE WHEN value < 50 THEN 'Exercise' ELSE 'Note' END END,
        'created_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        'enteredBy', concat('user-', user_id),
        'insulin', CASE WHEN user_id > 20 AND event_type <> 'error' THEN value END,
        'carbs', CASE WHEN event_type <> 'error' THEN value * 2 END,
        'duration', CASE WHEN user_id > 30 THEN user_id END,
        'rate', CASE WHEN user_id > 40 AND event_type <> 'error' THEN value END,
        'percent', user_id,
        'device', concat('dev-', user_id))) AS raw
    FROM {events}
"""

PROFILES = """
    SELECT concat('{"_id":"p', c_custkey, '","created_at":"1995-01-02T03:04:05Z","startDate":"1995-01-02","defaultProfile":"',
        CASE c_mktsegment WHEN 'BUILDING' THEN 'Night' WHEN 'MACHINERY' THEN 'Missing' WHEN 'FURNITURE' THEN ''
                          ELSE 'Default' END,
        '","store":{"Default":{"dia":', c_nationkey, ',"carbs_hr":20,"units":"mg/dl","sens":[{"time":"00:00","value":',
        c_nationkey, '}]},"Night":{"dia":3.5,"timezone":"UTC","target_low":[{"value":80}]}}}') AS raw
    FROM {customer}
"""

DEVICE_STATUS = """
    SELECT concat('{"_id":"d', event_id, '","created_at":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        '","device":"dev-', user_id, '"',
        CASE event_type WHEN 'error' THEN ''
             WHEN 'click' THEN concat(',"pump":{"clock":"10:00","reservoir":', user_id, ',"iob":', user_id, '.5}')
             WHEN 'view' THEN concat(',"pump":{"battery":{"percent":', user_id, '},"iob":{"bolusiob":', user_id, '.25}}')
             ELSE ',"pump":{"status":{"bolusing":false},"iob":null}' END,
        CASE WHEN event_type IN ('click', 'view') THEN concat(',"uploader":{"battery":', user_id, ',"name":"phone"}') ELSE '' END,
        CASE event_type WHEN 'purchase' THEN concat(',"loop":{"iob":{"netInsulin":', user_id, '.75},"cob":{"cob":', user_id, '}}')
             WHEN 'signup' THEN ',"loop":{"iob":5,"cob":null,"enacted":{"rate":1}}' ELSE '' END,
        '}') AS raw
    FROM {events}
"""


def entries(spark: SparkSession, folder: str) -> DataFrame:
    return glucose.entries(query(spark, folder, ENTRIES))


def treatments(spark: SparkSession, folder: str) -> DataFrame:
    return glucose.treatments(query(spark, folder, TREATMENTS)).withColumn("extras", F.to_json("extras"))


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    schedules = ("carbratio", "sens", "basal", "target_low", "target_high")
    return glucose.profiles(query(spark, folder, PROFILES)).withColumns({c: F.to_json(c) for c in schedules})


def device_status(spark: SparkSession, folder: str) -> DataFrame:
    return glucose.device_status(query(spark, folder, DEVICE_STATUS)).select(
        "id", "created_at", "device",
        F.col("pump").isNotNull().alias("has_pump"), F.col("pump.clock").alias("pump_clock"),
        F.col("pump.reservoir").alias("pump_reservoir"), F.to_json("pump.battery").alias("pump_battery"),
        F.to_json("pump.status").alias("pump_status"), F.col("pump.iob").alias("pump_iob"),
        F.to_json("uploader.battery").alias("uploader_battery"), F.col("uploader.name").alias("uploader_name"),
        F.to_json("loop.enacted").alias("loop_enacted"), F.col("loop.iob").alias("loop_iob"),
        F.col("loop.cob").alias("loop_cob"),
    )


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """The shape in which treatments are stored, with the JSON copy of each row."""
    rows = glucose.to_target("treatments", glucose.treatments(query(spark, folder, TREATMENTS)))
    return rows.withColumn("raw_data", F.get_json_object("raw_data", "$.id"))


def recent_range(spark: SparkSession, folder: str) -> DataFrame:
    """Top 500 of ten days by epoch milliseconds."""
    events = table(spark, folder, "events")
    millis = events.withColumn("date", F.unix_millis(to_instant(F.col("ts")))).select("event_id", "date", "value")
    return time_range(millis, "date", NOON, days=10, limit=500, tie_breaker="event_id")


def whole_range(spark: SparkSession, folder: str) -> DataFrame:
    return time_range(table(spark, folder, "events"), "ts", NOON, days=10, limit=None)


def readings(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("dateString"),
        F.floor("value").alias("sgv"),
        F.when(F.col("user_id") > 50, F.concat(F.lit("dev-"), "user_id")).alias("device"),
        F.when(F.col("event_type") == "click", "mbg").alias("type"),
        F.col("user_id").alias("noise"),
    )
    return glucose_readings(raw, NOON, lookback_hours=48)


QUERIES = {
    "ns_entries": entries,
    "ns_treatments": treatments,
    "ns_profiles": profiles,
    "ns_devicestatus": device_status,
    "ns_treatment_targets": targets,
    "time_range_scan_limit": recent_range,
    "time_range_scan": whole_range,
    "glucose_readings": readings,
}

KIND = """CASE event_type
            WHEN 'purchase' THEN CASE WHEN value < 50 THEN 'Bolus' ELSE 'Combo Bolus' END
            WHEN 'click' THEN CASE WHEN value < 50 THEN 'Carbs' ELSE 'Announcement' END
            WHEN 'view' THEN 'Temp Basal'
            WHEN 'signup' THEN CASE WHEN value < 50 THEN 'Site Change' ELSE 'Sensor Change' END
            ELSE CASE WHEN value < 50 THEN 'Exercise' ELSE 'Note' END END"""

WIDE = f"""
    SELECT 't' || event_id AS id, lower({KIND}) AS type, date_trunc('milliseconds', ts) AS created_at,
           'user-' || user_id AS enteredBy, NULL::VARCHAR AS notes,
           CASE WHEN event_type = 'purchase' THEN CASE WHEN user_id > 20 THEN value ELSE 0 END END AS insulin,
           CASE WHEN (event_type = 'purchase' AND value >= 50) OR (event_type = 'click' AND value < 50) THEN value * 2 END AS carbs,
           CAST(CASE WHEN (event_type = 'purchase' AND value < 50) OR event_type = 'view' OR (event_type = 'error' AND value < 50)
                          THEN CASE WHEN user_id > 30 THEN user_id ELSE 0 END
                     WHEN event_type = 'error' AND user_id > 30 THEN user_id END AS INT) AS duration,
           CASE WHEN event_type = 'view' THEN CASE WHEN user_id > 40 THEN value ELSE 0 END END AS rate,
           CAST(CASE WHEN event_type = 'view' OR (event_type = 'error' AND value >= 50) THEN user_id END AS INT) AS percent,
           CASE WHEN event_type = 'view' THEN 0.0::DOUBLE END AS absolute,
           CASE WHEN event_type = 'signup' OR (event_type = 'error' AND value >= 50) THEN 'dev-' || user_id END AS device,
           CASE WHEN event_type = 'error' AND value >= 50 THEN
                '{{"eventType":"Note",' || CASE WHEN user_id > 30 THEN '"duration":' || user_id || ',' ELSE '' END
                || '"percent":' || user_id || ',"device":"dev-' || user_id || '"}}' END AS extras
    FROM events
"""

ORACLES = {
    "ns_entries": """
        SELECT 'e' || event_id AS id, 'dev-' || user_id AS device,
               CASE WHEN event_type IN ('click', 'purchase') THEN date_trunc('milliseconds', ts) END AS date,
               strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS dateString,
               CASE WHEN event_type NOT IN ('signup', 'error') THEN floor(value) END AS sgv,
               CASE WHEN event_type NOT IN ('signup', 'error') THEN round(floor(value) / 18, 1) END AS sgv_mmol,
               'Flat' AS direction, event_type AS type, CASE WHEN event_type = 'click' THEN 101.5::DOUBLE END AS filtered,
               NULL::DOUBLE AS unfiltered, user_id::INT AS rssi, CASE WHEN event_type = 'click' THEN 1 END AS noise,
               ts::DATE::VARCHAR AS sys_time, 60 AS utc_offset
        FROM events
    """,
    "ns_treatments": WIDE,
    "ns_profiles": """
        SELECT 'p' || c_custkey AS id, TIMESTAMP '1995-01-02 03:04:05' AS created_at, '1995-01-02' AS startDate,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 3.5::DOUBLE
                    WHEN c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') THEN c_nationkey END AS dia,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 20.0::DOUBLE END AS carbs_hr,
               NULL::VARCHAR AS carbratio,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
                    THEN '[{"time":"00:00","value":' || c_nationkey || '}]' END AS sens,
               NULL::VARCHAR AS basal, CASE WHEN c_mktsegment = 'BUILDING' THEN '[{"value":80}]' END AS target_low,
               NULL::VARCHAR AS target_high,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'mg/dl' END AS units,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'UTC' END AS timezone
        FROM customer
    """,
    "ns_devicestatus": """
        SELECT 'd' || event_id AS id, date_trunc('second', ts) AS created_at, 'dev-' || user_id AS device,
               event_type <> 'error' AS has_pump, CASE WHEN event_type = 'click' THEN '10:00' END AS pump_clock,
               CASE WHEN event_type = 'click' THEN user_id::DOUBLE END AS pump_reservoir,
               CASE WHEN event_type = 'view' THEN '{"percent":' || user_id || '}' END AS pump_battery,
               CASE WHEN event_type IN ('purchase', 'signup') THEN '{"bolusing":false}' END AS pump_status,
               CASE event_type WHEN 'click' THEN user_id + 0.5::DOUBLE WHEN 'view' THEN user_id + 0.25::DOUBLE END AS pump_iob,
               CASE WHEN event_type IN ('click', 'view') THEN user_id::VARCHAR END AS uploader_battery,
               CASE WHEN event_type IN ('click', 'view') THEN 'phone' END AS uploader_name,
               CASE WHEN event_type = 'signup' THEN '{"rate":1}' END AS loop_enacted,
               CASE WHEN event_type = 'purchase' THEN user_id + 0.75::DOUBLE END AS loop_iob,
               CASE WHEN event_type = 'purchase' THEN user_id::DOUBLE END AS loop_cob
        FROM events
    """,
    "ns_treatment_targets": f"""
        SELECT id, type, created_at, enteredBy AS entered_by, insulin, carbs, duration, rate, percent, absolute, notes,
               id AS raw_data
        FROM ({WIDE})
    """,
    "time_range_scan_limit": f"""
        SELECT event_id, epoch_us(ts) // 1000 AS date, value FROM events
        WHERE date BETWEEN epoch_ms(TIMESTAMP '{NOON}' - INTERVAL 10 DAY) AND epoch_ms(TIMESTAMP '{NOON}')
        ORDER BY date DESC, event_id DESC LIMIT 500
    """,
    "time_range_scan": f"""
        SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '{NOON}' - INTERVAL 10 DAY AND TIMESTAMP '{NOON}'
    """,
    "glucose_readings": f"""
        SELECT ts AS timestamp, floor(value) AS glucose,
               CASE WHEN user_id > 50 THEN 'dev-' || user_id ELSE 'unknown' END AS device,
               CASE WHEN event_type = 'click' THEN 'mbg' ELSE 'sgv' END AS type, NULL::VARCHAR AS direction,
               user_id::INT AS noise, NULL::DOUBLE AS filtered, NULL::DOUBLE AS unfiltered, NULL::INT AS rssi,
               TIMESTAMP '{NOON}' - INTERVAL 48 HOUR AS start_time, TIMESTAMP '{NOON}' AS end_time
        FROM events WHERE ts BETWEEN TIMESTAMP '{NOON}' - INTERVAL 48 HOUR AND TIMESTAMP '{NOON}'
    """,
}
