from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark import session


def fake_session(master, folder=None, conf=None):
    """Just enough of a session to ask for its shared folder."""
    state = {"dir": folder}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf or default)
    )


def test_configured_folder_is_used(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(fake_session("yarn", conf="hdfs://shared/")) == "hdfs://shared"
    assert session.shared_dir(fake_session("yarn", folder="hdfs://set")) == "hdfs://set"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake_session("yarn"))


def test_local_mode_chooses_one_folder():
    local = fake_session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_staged_rows_do_not_change(spark):
    staged = session.stage(spark.range(100).withColumn("r", F.rand()), "random")
    assert staged.exceptAll(staged).count() == 0
    assert staged.schema.names == ["id", "r"]


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions_for(0, 8) == 8
    assert session.shuffle_partitions_for(10 * 1024**4, 4000) == 40_960


def test_defaults_keep_what_the_owner_chose(spark):
    session.apply_defaults(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_intermediates_of_an_application_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    session.stage(spark.range(5), "numbers")
    assert list((tmp_path / "tidemark").iterdir())
    assert session.remove_intermediates(spark)
    assert not list((tmp_path / "tidemark").iterdir())
    assert not session.remove_intermediates(spark)
