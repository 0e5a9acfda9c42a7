"""Publications of two writers, by a rename and by objects that are put if absent."""

import uuid

import pytest

from scrollspark.operators.store import ByRename, Conflict, IfAbsent, SnapshotStore

BOTH = pytest.mark.parametrize("commits", [ByRename, IfAbsent])


@pytest.fixture
def no_rename(spark, monkeypatch):
    """A store without rename: any use of it fails."""

    def refused(*_):
        raise AssertionError("rename")

    monkeypatch.setattr(ByRename, "__init__", refused)


def test_two_writers_of_a_store_without_rename(spark, tmp_path, no_rename):
    first, second = (SnapshotStore(spark, str(tmp_path / "s"), IfAbsent) for _ in range(2))
    first.publish(x=spark.range(1), y=spark.range(2))
    first.read("x"), second.read("x")
    second.publish(x=spark.range(7))
    with pytest.raises(Conflict):
        first.publish(y=spark.range(9))
    assert (first.read("x").count(), first.read("y").count(), first.tables()) == (7, 2, ["x", "y"])
    assert sorted(p.name for p in (tmp_path / "s").glob("pointer-*")) == ["pointer-000000000000", "pointer-000000000001"]
    assert not list((tmp_path / "s").glob("draft-*"))


@BOTH
def test_a_writer_that_comes_between_listing_and_pointer_wins(spark, tmp_path, commits, monkeypatch):
    first, second = (SnapshotStore(spark, str(tmp_path), commits) for _ in range(2))
    first.publish(x=spark.range(1))
    pointer = SnapshotStore._pointer

    def late(self):
        found = pointer(self)
        if self is first:
            second.begin()
            second.publish(x=spark.range(5))
        return found

    first.begin()
    monkeypatch.setattr(SnapshotStore, "_pointer", late)
    with pytest.raises(Conflict):
        first.publish(x=spark.range(9))
    monkeypatch.undo()
    first.begin()
    assert first.read("x").count() == 5


@BOTH
def test_put_tells_whether_the_file_is_the_writers_own(spark, tmp_path, commits):
    put = commits(spark, str(tmp_path)).put
    assert put("pointer-1", "a\tb\n") and not put("pointer-1", "a\tc\n") and not put("pointer-1", "a\tb\n")
    assert (tmp_path / "pointer-1").read_text().startswith("a\tb\n")


def test_a_request_sent_twice_is_not_a_conflict(spark, tmp_path, monkeypatch):
    mark = uuid.uuid4()
    monkeypatch.setattr(uuid, "uuid4", lambda: mark)
    put = IfAbsent(spark, str(tmp_path)).put
    assert put("pointer-1", "a\tb\n") and put("pointer-1", "a\tb\n")


def test_other_failures_are_raised(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception, match="file"):
        IfAbsent(spark, str(tmp_path / "file")).put("pointer-1", "")


def test_a_store_can_change_its_way_of_commits(spark, tmp_path):
    one, other = (SnapshotStore(spark, str(tmp_path), commits) for commits in (IfAbsent, ByRename))
    one.publish(x=spark.range(1))
    other.publish(y=spark.range(2))
    one.begin()
    assert one.tables() == ["x", "y"] and one.clean(keep=1, older_than=0) == 1 and one.read("x").count() == 1
