"""Stages follow the files they were built from and can be removed."""

import os
import shutil

import pytest

from campanula.plans import registry
from campanula.session import checkpoint_dir, folder_state
from harness import SF_SMALL

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture
def folder(tmp_path):
    for n in NAMES:
        shutil.copy(f"{SF_SMALL}/{n}.parquet", tmp_path / f"{n}.parquet")
    return str(tmp_path)


def test_replaced_files_get_new_stages(spark, folder):
    before = registry.tables(spark, folder)
    assert registry.tables(spark, folder) is before
    n = before.campaigns.count()
    some = spark.read.parquet(f"{folder}/supplier.parquet").limit(3).toPandas()
    some.to_parquet(f"{folder}/supplier.parquet")
    after = registry.tables(spark, folder)
    assert after is not before and after.campaigns.count() == 3 < n
    assert before.campaigns.count() == n  # results asked for earlier still stand


def test_state_of_folders_and_of_none(spark, folder, tmp_path):
    spark.range(5).write.parquet(f"{folder}/more.parquet")
    one = folder_state(spark, folder)
    assert len(one) == len(NAMES) + 1 and folder_state(spark, str(tmp_path / "none")) == ()
    spark.range(5).write.mode("append").parquet(f"{folder}/more.parquet")
    assert folder_state(spark, folder) != one


def test_release_removes_what_the_session_wrote(spark, folder):
    own = spark.newSession()
    t = registry.tables(own, folder)
    t.campaigns.count()
    root = t.stage_root.removeprefix("file:")
    assert os.path.isdir(root)
    registry.release(own)
    assert not os.path.exists(root) and not os.path.exists(f"{checkpoint_dir(own).removeprefix('file:')}/campanula_stages")
    assert registry.tables(own, folder).campaigns.count() > 0  # built anew
