"""The command line passes its bounds on."""

import pytest

from playlog import cli
from playlog.sources import kafka
from playlog.streaming import dumps, jobs


class Started:
    name, id = "q", "0"


@pytest.fixture
def seen(spark, monkeypatch):
    got = {"dumps": [], "topics": []}
    monkeypatch.setattr(dumps, "start_messages", lambda s, folder, root, trigger, max_files: got[
        "dumps"].append((folder, root, max_files)) or (Started(), "messages"))
    monkeypatch.setattr(kafka, "read_topic", lambda s, b, topic, **o: got["topics"].append((topic, o)) or topic)
    monkeypatch.setattr(jobs, "run", lambda s, raw, paths, changelog, trigger, **o: got.update(
        run=(raw, changelog, trigger, o)) or [Started()])
    monkeypatch.setattr(type(spark.streams), "awaitAnyTermination", lambda self: None)
    return got


def test_dumps_take_the_bound_of_files(seen):
    cli.main(["stream", "--dump-events", "/d/e", "--dump-catalog", "/d/c", "--out", "/o/",
              "--max-files-per-trigger", "3"])
    assert seen["dumps"] == [("/d/e", "/o/_dumps/events", 3), ("/d/c", "/o/_dumps/catalog", 3)]
    assert seen["run"][3]["max_files"] == 3
    cli.main(["stream", "--dump-events", "/d/e", "--out", "/o"])
    assert seen["dumps"][2:] == [("/d/e", "/o/_dumps/events", 1)] and seen["run"][1] is None


def test_both_topics_take_the_bound_of_offsets(seen):
    cli.main(["stream", "--bootstrap", "h:1", "--events-topic", "E", "--catalog-topic", "C", "--out", "/o",
              "--max-offsets-per-trigger", "500", "--min-partitions", "9"])
    assert seen["topics"] == [("E", {"min_partitions": 9, "max_offsets_per_trigger": 500}),
                              ("C", {"max_offsets_per_trigger": 500})]


def test_the_dlq_topic_takes_the_bound_of_files(spark, monkeypatch):
    got = {}
    monkeypatch.setattr(jobs, "validated_schema", lambda raw: None)
    monkeypatch.setattr(jobs, "start_validation", lambda *a: None)
    monkeypatch.setattr(jobs, "valid_stream", lambda *a: None)
    monkeypatch.setattr(jobs, "start_dlq_to_kafka", lambda s, p, schema, trigger, max_files: got.update(n=max_files))
    jobs.run(spark, None, jobs.Paths("/r", kafka=jobs.KafkaOut("h:1")), wait=False, kinds=(), max_files=7)
    assert got == {"n": 7}
