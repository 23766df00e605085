"""Stored intermediates: where they go, that they go, and what is refused."""

import os

import pytest

import __spark_entry__ as driver
from playmetrics import storage
from playmetrics.plans import purchases
from tests.fixture_data import tables


@pytest.fixture
def folder(spark, tmp_path):
    """The session's checkpoint folder set aside for one of our own."""
    context = spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path))
    yield tmp_path
    if before is not None:
        context.setCheckpointDir(before)


def test_stored_tables_can_be_removed(spark, folder):
    found = purchases.item_popularity(tables(spark))
    assert found.count() == 3
    assert list(folder.rglob("*.parquet"))
    assert storage.drop_stored(spark)
    assert not list(folder.rglob("*.parquet"))
    assert not storage.drop_stored(spark)
    assert storage.store(spark.range(3)).count() == 3


def test_rows_and_types_come_back(spark, folder):
    df = spark.createDataFrame([(1, None, [1.5]), (2, "x", [])], "a int, b string, c array<double>")
    stored = storage.store(df)
    assert stored.schema == df.schema and set(map(str, stored.collect())) == set(map(str, df.collect()))
    assert storage.store(df.where("a > 5")).collect() == []


class Cluster:
    """A session as ``shared_folder`` sees it."""

    def __init__(self, master, named, set_to):
        self.master, self.folder = master, set_to
        self.sparkContext = self.conf = self
        self.named = named

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/own"


def test_a_local_folder_is_refused_on_a_cluster():
    with pytest.raises(RuntimeError, match="is a local folder"):
        storage.shared_folder(Cluster("spark://host:7077", None, "file:/tmp/x"))
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        storage.shared_folder(Cluster("yarn", None, None))


def test_what_the_session_names_is_shared():
    assert storage.shared_folder(Cluster("yarn", "file:/shared", None)) == "file:/shared/own"
    assert storage.shared_folder(Cluster("yarn", "file:/shared", "file:/shared/own")) == "file:/shared/own"
    assert storage.shared_folder(Cluster("yarn", None, "hdfs://a/b")) == "hdfs://a/b"
    local = storage.shared_folder(Cluster("local[2]", None, None))
    assert os.path.basename(os.path.dirname(local)).startswith("playmetrics-")


def folders(folder):
    """Names of the tables stored below a folder."""
    return sorted({p.parent.name for p in folder.rglob("*.parquet") if p.parent.parent.name == "stored"})


def test_a_scope_removes_what_it_owns(spark, folder):
    outside = storage.store(spark.range(2))
    with storage.Scope(spark):
        assert storage.store(spark.range(3)).count() == 3
        assert len(folders(folder)) == 2
    assert len(folders(folder)) == 1 and outside.count() == 2


def test_what_is_kept_outlives_the_scope(spark, folder):
    with storage.Scope(spark) as outer:
        with storage.Scope(spark) as inner:
            first = storage.store(spark.range(5))
            kept = inner.keep(first.where("id > 1"))
            assert len(folders(folder)) == 2
        assert len(folders(folder)) == 1 and kept.count() == 3
        assert outer.feeds(kept) and not inner.feeds(kept)
    assert folders(folder) == []


def test_an_error_leaves_nothing(spark, folder):
    with pytest.raises(ZeroDivisionError):
        with storage.Scope(spark):
            storage.store(spark.range(5))
            1 / 0
    assert folders(folder) == []
    assert storage.store(spark.range(1)).count() == 1 and len(folders(folder)) == 1


def test_open_and_closed_by_hand(spark, folder):
    scope = storage.Scope(spark).open()
    own = storage.store(spark.range(5))
    scope.close()
    other = storage.store(spark.range(6))
    assert scope.feeds(own.where("id > 2")) and not scope.feeds(other) and not scope.feeds(spark.range(3))
    assert scope.drop() == 1 and scope.drop() == 0
    assert len(folders(folder)) == 1 and other.count() == 6


@pytest.mark.parametrize("name", list(driver.ANALYSES))
def test_analyses_leave_nothing_in_a_scope(spark, folder, name):
    """Written inside the scope, a result is whole after it, and no folder but its own is left."""
    game = tables(spark)
    expected = driver.ANALYSES[name](game)
    wanted = sorted(map(str, expected.collect()))
    storage.drop_stored(spark)
    with storage.Scope(spark) as scope:
        kept = scope.keep(driver.ANALYSES[name](game))
    assert len(folders(folder)) == 1
    assert sorted(map(str, kept.collect())) == wanted
