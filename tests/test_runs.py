import pytest

import datetime as dt

from tidemark.operators import runs


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def test_stages_archive_previous_holder(spark):
    ev = spark.createDataFrame([
        ("m", 1, "Production", True, _t(1)),
        ("m", 2, "Staging", False, _t(2)),
        ("m", 2, "Production", True, _t(3)),   # archives version 1
        ("m", 3, "Staging", False, _t(4)),
        ("m", 4, "Staging", True, _t(5)),      # archives version 3
        ("n", 1, "Production", False, _t(1)),
    ], "model string, version int, stage string, archive_existing boolean, at timestamp_ntz")
    got = {(r["model"], r["version"]): r["stage"] for r in runs.current_stages(ev).collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "Archived",
                   ("m", 4): "Staging", ("n", 1): "Production"}
    assert {r["model"]: r["version"] for r in runs.model_in_stage(ev, "Production").collect()} == {"m": 2, "n": 1}
    assert {r["model"]: r["latest_version"] for r in runs.latest_model_version(ev).collect()} == {"m": 4, "n": 1}


def test_best_and_latest_run(spark):
    r = spark.createDataFrame([
        ("e1", "r2", _t(1), "f1", 0.8), ("e1", "r1", _t(2), "f1", 0.8), ("e1", "r3", _t(3), "f1", 0.5),
        ("e2", "r9", _t(4), "f1", 0.1)], "experiment string, run_id string, start_time timestamp_ntz, metric string, value double")
    assert {x["experiment"]: x["run_id"] for x in runs.best_run(r, "f1").collect()} == {"e1": "r1", "e2": "r9"}
    assert {x["experiment"]: x["run_id"] for x in runs.latest_run(r).collect()} == {"e1": "r3", "e2": "r9"}
    assert runs.latest_experiment(r).collect()[0]["experiment"] == "e2"


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidemark.session import shared_dir
    conf = SimpleNamespace(get=lambda key, default=None: default, set=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
