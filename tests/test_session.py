from types import SimpleNamespace

import pytest

from shiftroll.session import clear_scratch, materialise, release, scratch_path, scratch_tables, shared_folder


def session(folder=None, own=None, master="spark://host:7077"):
    context = SimpleNamespace(getCheckpointDir=lambda: own, master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_folder_named_by_the_session():
    assert shared_folder(session("/shared/")) == "/shared"
    assert shared_folder(session(None, "/own")) == "/own"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session())


def test_materialise_and_clear(spark, rows):
    df = spark.range(10).selectExpr("id", "id % 2 as part")
    stored = materialise(df, ["part"])
    assert stored.schema.names == ["id", "part"]
    assert rows(stored) == rows(df)
    assert stored.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark).removeprefix("file:"))
    assert scratch_path(spark) != scratch_path(spark)
    clear_scratch(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|No such file"):
        stored.collect()


def test_release_removes_only_the_tables_named(spark, rows):
    kept, gone, parts = materialise(spark.range(3)), materialise(spark.range(5)), materialise(spark.range(4).selectExpr("id", "id % 2 as part"), ["part"])
    before = scratch_tables(spark)
    release(gone.filter("id > 1"), parts)
    assert len(before - scratch_tables(spark)) == 2
    assert rows(kept) == [(0,), (1,), (2,)]
