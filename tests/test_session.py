"""Stages and their scope."""

import os

import pytest

from fieldmark.session import shared_folder, stage_scope, stored


def test_scope_removes_its_stages(spark):
    before = spark.sparkContext.getCheckpointDir()
    with stage_scope(spark):
        kept = stored(spark.range(10))
        assert kept.count() == 10
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    assert spark.sparkContext.getCheckpointDir() == before
    assert shared_folder(spark) == shared_folder(spark)


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="stream"):
        stored(stream)
