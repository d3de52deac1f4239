from types import SimpleNamespace

import pytest

from letterbox.session import new_folder, shared_root


def session(master, folder=None):
    settings = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_cluster_names_the_shared_folder():
    spark = session("yarn", "s3://lake/shared/")
    assert shared_root(spark) == "s3://lake/shared"
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first.startswith("s3://lake/shared/letterbox/x-") and first != second


def test_a_machine_folder_is_for_local_masters_only():
    assert shared_root(session("local[2]")) == shared_root(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("spark://host:7077"))
