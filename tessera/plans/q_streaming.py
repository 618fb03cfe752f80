"""Structured Streaming versions of the daily report (T1) and rapid alerts.

Each query streams the ``events`` table's files to completion
(``availableNow``) and returns the resulting table; both must equal their
batch counterparts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.windows import MICROS_PER_MINUTE
from tessera.plans.registry import register
from tessera.sources.tables import table_path
from tessera.streaming.daily_report import run_daily_report
from tessera.streaming.rapid import run_rapid_alerts_by_table

STREAM = "streaming"


@register("stream_daily_report", area=STREAM, oracle="""
SELECT CAST(ts AS DATE) AS event_date, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2""")
def stream_daily_report(t):
    """Daily windows without loss of late rows, update mode, keyed upsert per micro-batch."""
    out = run_daily_report(t.spark, table_path(t.sf_dir, "events"), t.events.schema)
    return out.withColumn("total_value", F.col("total_value").cast("double"))


@register("stream_rapid", area=STREAM, oracle="""
SELECT t.event_id, t.user_id FROM events t
WHERE EXISTS (SELECT 1 FROM events p
              WHERE p.user_id = t.user_id AND p.event_id < t.event_id
                AND t.ts - p.ts < INTERVAL 1 MINUTE)""")
def stream_rapid(t):
    """Rapid-sequence alerts over a history table, whatever the order of arrival."""
    return run_rapid_alerts_by_table(t.spark, table_path(t.sf_dir, "events"), t.events.schema, MICROS_PER_MINUTE)
