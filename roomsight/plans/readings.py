"""Sensor readings derived from an event stream table.

The events carry no sensor columns, so the readings are computed from them by fixed rules
with the same kinds of faults: missing cells, impossible values, mixed spellings, copies.
The text is plain SQL that any engine runs, so a check can use the very same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READINGS_SQL = """
SELECT event_id AS reading_id, user_id AS session_id, ts,
  CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
       WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
  CASE WHEN event_id % 97 = 0 THEN CAST(300 AS DOUBLE) + value % 10
       WHEN event_id % 101 = 0 THEN CAST(4 AS DOUBLE)
       ELSE CAST(15 AS DOUBLE) + value % 15 END AS temperature,
  CASE WHEN event_id % 100 < 19 THEN CAST(NULL AS DOUBLE)
       WHEN event_id % 53 = 0 THEN CAST(-49 AS DOUBLE)
       WHEN event_id % 59 = 0 THEN CAST(198 AS DOUBLE)
       ELSE CAST(30 AS DOUBLE) + value % 40 END AS humidity,
  CASE WHEN event_id % 41 = 0 THEN -value ELSE CAST(60 AS DOUBLE) + value END AS co2_infrared,
  CAST(400 AS DOUBLE) + value * 2 + event_id % 13 AS co2_electrochem,
  CAST(500 AS DOUBLE) + value % 100 AS mox_1,
  CASE WHEN event_id % 50 < 7 THEN CAST(NULL AS DOUBLE)
       ELSE CAST(500 AS DOUBLE) + value % 90 END AS mox_2,
  CAST(500 AS DOUBLE) + value % 80 + event_id % 7 AS mox_3,
  CAST(500 AS DOUBLE) + value % 70 + event_id % 11 AS mox_4,
  CASE WHEN event_id % 25 < 2 THEN CAST(NULL AS DOUBLE) WHEN event_id % 67 = 0 THEN -value
       ELSE value * value / 100 END AS co_gas,
  CASE event_id % 9 WHEN 0 THEN CAST(NULL AS VARCHAR(20)) WHEN 1 THEN 'very_dim'
       WHEN 2 THEN 'dim' WHEN 3 THEN 'dim' WHEN 4 THEN 'moderate' WHEN 5 THEN 'moderate'
       WHEN 6 THEN 'bright' WHEN 7 THEN 'moderate' ELSE 'very_bright' END AS ambient_light,
  CASE event_id % 4 WHEN 0 THEN concat(upper(event_type), ' MODE')
       WHEN 1 THEN concat('  ', event_type, '-mode ') WHEN 2 THEN concat(event_type, '_mode')
       ELSE concat(event_type, '  Mode') END AS hvac_mode,
  CASE WHEN event_id % 100 < 57 THEN
         CASE event_id % 3 WHEN 0 THEN 'Low Activity' WHEN 1 THEN 'Low_Activity'
              ELSE 'LowActivity' END
       WHEN event_id % 100 < 88 THEN
         CASE event_id % 2 WHEN 0 THEN 'Moderate Activity' ELSE 'ModerateActivity' END
       ELSE 'High Activity' END AS activity_level
FROM (SELECT * FROM {events}
      UNION ALL SELECT * FROM {events} WHERE event_id % 500 = 0) e
"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """The readings of one data folder."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return spark.sql(READINGS_SQL, events=events)
