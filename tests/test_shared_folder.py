"""Tables, sinks and checkpoints go to the folder the session names."""

import os

import __spark_entry__ as driver
from strata.session import shared_dir


def test_queries_write_below_the_shared_folder(spark, sf, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir", None)
    made = []

    def watched(session, label):
        made.append(shared_dir(session, label))
        return made[-1]

    monkeypatch.setattr("strata.plans.storage.shared_dir", watched)
    monkeypatch.setattr("strata.plans.streams.shared_dir", watched)
    assert driver.queries()["read_table"](spark, sf).count() > 0
    assert driver.queries()["read_event_stream"](spark, sf).count() > 0
    assert len(made) == 3 and all(os.path.isdir(p) for p in made)
    if root:
        assert all(p.startswith(root) for p in made)
