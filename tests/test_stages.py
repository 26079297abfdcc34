"""Stages that end with their job."""

import os

import pytest
from pyspark.sql import functions as F

from churnpanel.functions import scale
from churnpanel.functions.scale import job_scope, materialize, stage_path


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/shared"
    monkeypatch.setattr(scale, "shared_dir", lambda _: folder)
    return tmp_path / "shared"


def left(folder):
    return sorted(os.listdir(folder)) if folder.exists() else []


def test_stages_go_and_results_stay(spark, shared, tmp_path):
    with job_scope(spark) as keep:
        inner = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "step")
        assert len(left(shared)) == 1 and inner.count() == 10
        kept = keep(inner.where("id > 4"), f"file://{tmp_path}/kept")
    assert left(shared) == []
    assert kept.agg(F.sum("x")).first()[0] == 70  # the result outlives the job
    with pytest.raises(Exception):  # a lazy frame over a deleted stage fails, it is not empty
        spark.read.parquet(*inner.inputFiles()).count()


def test_a_failed_job_leaves_nothing(spark, shared):
    with pytest.raises(RuntimeError), job_scope(spark):
        materialize(spark.range(3), "step")
        raise RuntimeError
    assert left(shared) == []
    assert "step-" in stage_path(spark, "step") and "job-" not in stage_path(spark, "step")


def test_nested_jobs(spark, shared):
    with job_scope(spark, "outer"):
        first = materialize(spark.range(4), "a")
        with job_scope(spark, "inner"):
            materialize(spark.range(5), "b")
            assert len(left(shared)) == 2
        assert len(left(shared)) == 1 and first.count() == 4
    assert left(shared) == []


def test_a_job_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(scale, "shared_dir", scale._below_warehouse)
    with pytest.raises(ValueError, match="checkpoint"), job_scope(spark):
        pass
