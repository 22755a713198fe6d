import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playlog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="playlog-tests")
    yield s


RAW_SCHEMA = "partition int, offset bigint, broker_time timestamp, key string, value string"


def event(event_id="ev-1", user_id="u-1", track_id="trk-1", artist="Nova Kane",
          event_type="COMPLETE", ms_played=31000, country="FR",
          timestamp="2026-07-16T10:00:00.000Z", **extra):
    d = {"event_id": event_id, "user_id": user_id, "track_id": track_id, "artist": artist,
         "event_type": event_type, "ms_played": ms_played, "country": country,
         "timestamp": timestamp}
    d.update(extra)
    return json.dumps({k: v for k, v in d.items() if v is not _MISSING})


class _Missing:
    pass


_MISSING = _Missing()


@pytest.fixture
def missing():
    return _MISSING


def raw_frame(spark, values, partition=0, start_offset=0, key="u-1"):
    """Kafka-shaped raw frame from message texts, offsets in list order."""
    import datetime as dt
    t = dt.datetime(2026, 7, 16, 10, 0, 0)
    rows = [(partition, start_offset + i, t, key, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_SCHEMA)
