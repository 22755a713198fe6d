"""DuckDB oracle for the dump queries: the records the lines must read back to."""

from __future__ import annotations

from playlog import contract as C
from playlog.plans.replay_queries import EVENTS_TOPIC, TRACKS_TOPIC
from playlog.sources import fixtures as fx


def oracle(fixture_ctes) -> dict[str, str]:
    base = f"""WITH {fixture_ctes().strip()},
recs AS (
  SELECT '{EVENTS_TOPIC}' AS topic, '{EVENTS_TOPIC}.jsonl' AS file_name, CAST(0 AS BIGINT) AS split_start,
         "offset" AS split_row, key, value, epoch_ms(broker_time) AS ts_ms FROM raw
  UNION ALL
  SELECT '{TRACKS_TOPIC}', '{TRACKS_TOPIC}.jsonl', CAST(0 AS BIGINT), "offset", key, value,
         CAST(({fx.BASE_EPOCH_S} + "offset") * 1000 AS BIGINT) FROM cat)
"""
    cut = f"substring(value, 1, {C.PREVIEW_CHARS})"
    return {
        "dump_records": base + "SELECT * FROM recs",
        "dump_timeline": base + """SELECT ts_ms, topic, key, value,
  row_number() OVER (ORDER BY ts_ms, file_name, split_start, split_row) AS rank FROM recs""",
        "dump_topic_counts": base + "SELECT topic, count(*) AS messages FROM recs GROUP BY topic",
        "dump_preview": base + f"""SELECT topic, key, {cut} AS value_preview,
  topic || ' | ' || coalesce(key, 'None') || ' | ' || coalesce({cut}, 'None') AS line FROM recs""",
    }
