import os
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.sql import DataFrameWriter

from tallyspark.queries.registry import QUERIES
from tallyspark.session import (
    _check_reach,
    _in_local_mode,
    _on_one_machine,
    _own_folder,
    _reached,
    clear_shared,
    materialize,
    shared_folder,
)


@pytest.fixture
def clustered(spark, monkeypatch):
    """The session as one of a cluster whose machines mount its folder; nothing is known of it yet."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    _reached.clear()
    yield spark
    _reached.clear()


def test_shared_folder_is_used_and_cleared(spark):
    df = materialize(spark.range(3), "three")
    assert df.count() == 3
    folder = shared_folder(spark, "x")
    assert f"/tallyspark/{spark.sparkContext.applicationId}/x-" in folder
    assert shared_folder(spark, "x") != folder
    assert folder[: folder.index("/x-")] in df.inputFiles()[0]
    assert clear_shared(spark)
    again = materialize(spark.range(2), "two")
    assert again.count() == 2


def test_a_session_without_shared_folder_keeps_one_of_its_own():
    assert _own_folder("app-1") == _own_folder("app-1") != _own_folder("app-2")


def test_local_folders_are_told_from_mounts(spark):
    assert _on_one_machine(spark, "file:///tmp/x") and _on_one_machine(spark, "/tmp/x")
    spark.conf.set("spark.tallyspark.sharedMount", "true")
    try:
        assert not _on_one_machine(spark, "/mnt/x")
    finally:
        spark.conf.unset("spark.tallyspark.sharedMount")


def test_a_mounted_folder_serves_a_cluster(clustered):
    def trials():
        base = urlparse(os.path.dirname(shared_folder(clustered, "x"))).path
        return {x for x in os.listdir(base) if x.startswith("reach-")}

    assert materialize(clustered.range(3), "three").count() == 3
    once = trials()
    assert once and trials() == once


@pytest.mark.parametrize("name", ["global_rank_distributed", "src_csv_scan", "int_attribution_paths_hot", "mart_published_versions"])
def test_queries_that_write_in_between_run_on_a_cluster(clustered, rows, name):
    clustered_rows = rows(QUERIES[name].run(clustered, "/root/testdata/sf0.001"))
    clustered.sparkContext.master = "local[8]"
    assert clustered_rows == rows(QUERIES[name].run(clustered, "/root/testdata/sf0.001"))


def test_a_folder_where_files_are_not_found_again_is_refused(clustered, monkeypatch):
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: write(clustered.range(0).write, path))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="0 could be read again"):
            shared_folder(clustered, "x")


def test_a_folder_that_cannot_be_written_is_refused(clustered):
    with pytest.raises(RuntimeError, match="every executor can reach") as refused:
        _check_reach(clustered, "file:///dev/null/x")
    assert refused.value.__cause__ is not None and not _reached


def test_without_a_checkpoint_setting_a_cluster_uses_the_given_folder_or_the_warehouse(monkeypatch):
    def session(given):
        settings = {"spark.sql.warehouse.dir": "file:///house"}
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        return SimpleNamespace(
            conf=conf,
            sparkContext=SimpleNamespace(
                master="yarn", applicationId="app-1", getConf=lambda: conf, getCheckpointDir=lambda: given
            ),
        )

    checked = []
    monkeypatch.setattr("tallyspark.session._on_one_machine", lambda _, base: base.startswith("file:"))
    monkeypatch.setattr("tallyspark.session._check_reach", lambda _, base: checked.append(base))
    assert shared_folder(session("hdfs://store/given"), "x").startswith("hdfs://store/given/tallyspark/app-1/x-")
    assert not checked
    assert shared_folder(session(None), "x").startswith("file:///house/tallyspark/app-1/x-")
    assert checked == ["file:///house"]


def test_only_one_process_is_local_mode():
    assert _in_local_mode("local") and _in_local_mode("local[8]")
    assert not _in_local_mode("local-cluster[3,2,1000]") and not _in_local_mode("yarn")
