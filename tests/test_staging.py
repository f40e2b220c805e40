from pathlib import Path
from types import SimpleNamespace

import pytest

from shelfsight import staging


def session(folder, master, context=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context),
    )


def test_the_folder_of_the_cluster_is_used():
    assert staging.shared_folder(session("hdfs://x/cp/", "yarn")) == "hdfs://x/cp"
    assert staging.shared_folder(session("/shared", "local[2]")) == "/shared"


def test_a_local_folder_is_made_only_in_local_mode():
    first = staging.shared_folder(session(None, "local[2]"))
    assert first == staging.shared_folder(session(None, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(session(None, "yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(session(None, "local-cluster[2,1,1024]"))
    assert staging.shared_folder(session(None, "yarn", "hdfs://c/")) == "hdfs://c"


def test_staged_tables_of_a_block_are_deleted(spark):
    with staging.staged_until_done(spark):
        path = Path(staging.stage(spark.range(3), "t").inputFiles()[0].removeprefix("file://")).parent
        assert path.exists()
    assert not path.exists()


def test_staged_rows_come_from_the_shared_folder(spark):
    df = staging.stage(spark.range(10), "t")
    assert df.count() == 10 and staging.shared_folder(spark) in df.inputFiles()[0]
