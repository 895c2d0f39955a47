"""Scratch folders: released when told, never those that are still read."""

import pytest

from encore.session import materialize, release, scratch_path, scratch_paths


def test_release_drops_what_is_not_read(spark):
    before = scratch_paths(spark)
    a, b = materialize(spark.range(5), "a"), materialize(spark.range(7), "b")
    made = [p for p in scratch_paths(spark) if p not in before]
    assert len(made) == 2
    release(spark, made, reader=a.join(spark.range(3), "id"))
    assert a.count() == 5 and scratch_paths(spark) == before + made[:1]
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        b.count()
    release(spark, made)
    assert scratch_paths(spark) == before


def test_release_leaves_other_folders_alone(spark, workdir):
    spark.range(3).write.parquet(f"{workdir}/t")
    release(spark, [f"{workdir}/t"])
    assert spark.read.parquet(f"{workdir}/t").count() == 3
    path = scratch_path(spark, "never-written")
    release(spark, [path])
    assert path not in scratch_paths(spark)
