"""The checkpoint folder on masters that aren't local."""

import glob
import os
import shutil
from types import SimpleNamespace

import pytest

from tidemark import session
from tidemark.plans import registry
from tidemark.plans.context import Tables

SF = "/root/testdata/sf0.001"


def _cluster(spark, folder, lost=0):
    sc = SimpleNamespace(
        master="spark://m:7077", applicationId=f"app-{folder}", defaultParallelism=2,
        _jsc=spark.sparkContext._jsc, getCheckpointDir=lambda: f"file:{folder}",
    )
    # lost: rows that executors wrote to a disk of their own, so that the driver doesn't see them
    write = lambda start, end, step, n: spark.range(start, end - lost, step, n)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d), range=write, read=spark.read)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_tables_are_staged_in_a_shared_file_folder_of_a_cluster(spark, monkeypatch):
    rows = Tables(spark, SF).cohort_counts.count()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://m:7077")
    assert spark.sparkContext.getCheckpointDir().startswith("file:")
    assert Tables(spark, SF).cohort_counts.count() == rows > 0


def test_a_shared_file_folder_is_tried_once_and_for_new_hosts(spark, tmp_path, monkeypatch):
    cluster, tried = _cluster(spark, tmp_path), lambda: len(glob.glob(f"{tmp_path}/tidemark-probe-*"))
    monkeypatch.setattr(session, "_hosts", lambda _: {"a", "b"})
    assert session.ensure_checkpoint_dir(cluster) == session.ensure_checkpoint_dir(cluster) == f"file:{tmp_path}"
    assert tried() == 1
    monkeypatch.setattr(session, "_hosts", lambda _: {"a", "c"})
    session.ensure_checkpoint_dir(cluster)
    assert tried() == 2


def test_a_file_folder_in_which_rows_are_missing_is_refused(spark, tmp_path):
    with pytest.raises(RuntimeError, match="one machine"):
        session.ensure_checkpoint_dir(_cluster(spark, tmp_path, lost=1))


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["clean_customers", "cohort_counts", "classification_metrics"])
def test_queries_stage_again_what_was_cleared_from_the_checkpoint_folder(spark, tmp_path, name):
    os.symlink(SF, sf := f"{tmp_path}/sf")
    staged = session._STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = set(staged)
    rows = registry.QUERIES[name](spark, sf).collect()
    run = registry.tables_for(spark, sf)
    assert registry.tables_for(spark, sf) is run
    for path in set(session._STAGED[spark.sparkContext.applicationId]) - before:
        shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)
    assert sorted(map(str, registry.QUERIES[name](spark, sf).collect())) == sorted(map(str, rows))
    assert registry.tables_for(spark, sf) is not run
    assert not registry.tables_for(spark, sf).cohort_counts.isEmpty()
