import os
import threading

import pytest

from nivalis.sources import published as P
from nivalis.sources import writers as K


def frame(spark, n, v=0.0):
    return spark.range(n).selectExpr("id as k", f"double({v}) as v")


def test_a_reader_keeps_the_run_it_began_with(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    assert K.write_versioned(frame(spark, 3), root, "one") == 1
    old = K.read_latest(spark, root)

    def slow(path):
        frame(spark, 5, 1.0).write.parquet(path)
        # written, not yet published: readers see the run before
        assert K.read_latest(spark, root).count() == 3

    assert P.publish(spark, root, "two", slow) == 2
    assert old.count() == 3
    assert K.read_latest(spark, root).count() == 5
    assert P.Versions(spark, root).contents(1)["run_id"] == "one"


def test_a_failed_write_leaves_no_trace(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    K.write_versioned(frame(spark, 3), root, "one")
    before = sorted(os.listdir(tmp_path / "r/runs"))

    def fails(path):
        frame(spark, 5).write.parquet(path)
        raise OSError("disk")

    with pytest.raises(OSError):
        P.publish(spark, root, "two", fails)
    assert sorted(os.listdir(tmp_path / "r/runs")) == before
    assert P.Versions(spark, root).latest() == 1
    assert K.read_latest(spark, root).count() == 3


def test_of_two_writers_after_one_version_one_wins(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    first = K.write_versioned(frame(spark, 1), root, "one")
    assert K.write_versioned(frame(spark, 2), root, "two", after=first) == 2
    with pytest.raises(P.Conflict):
        K.write_versioned(frame(spark, 3), root, "three", after=first)
    assert K.read_latest(spark, root).count() == 2
    assert len(os.listdir(tmp_path / "r/runs")) == 2
    assert K.write_versioned(frame(spark, 4), root, "four") == 3


@pytest.mark.parametrize("after", [None, 0])
def test_a_race_for_one_number(spark, tmp_path, monkeypatch, after):
    """Both find the number free, then both move their folder there."""
    root = f"file://{tmp_path}/r"
    versions = [P.Versions(spark, root) for _ in range(8)]
    monkeypatch.setattr(P.Versions, "latest", lambda self: 0)
    gate, done, lost = threading.Barrier(8), [], []

    def run(i):
        exists = versions[i]._fs.exists

        class Late:
            def __getattr__(self, name):
                return getattr(fs, name)

            def exists(self, path):
                found = exists(path)
                if str(path.getName()) == "000000001":
                    try:
                        gate.wait(5)
                    except threading.BrokenBarrierError:
                        pass
                return found

        fs = versions[i]._fs
        versions[i]._fs = Late()
        try:
            done.append((versions[i].commit({"who": i}, after), i))
        except P.Conflict:
            lost.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    monkeypatch.undo()
    reader = P.Versions(spark, root)
    assert len(done) + len(lost) == 8
    assert len({n for n, _ in done}) == len(done)
    assert (len(done) == 1) if after == 0 else (not lost)
    for number, who in done:
        assert reader.contents(number)["who"] == who
        assert os.listdir(tmp_path / f"r/versions/{number:09d}") in (["contents.json"], ["contents.json", ".contents.json.crc"], [".contents.json.crc", "contents.json"])


def test_clean_drops_orphans_after_a_while(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    for i in range(4):
        K.write_versioned(frame(spark, i + 1), root, f"r{i}")
    os.makedirs(tmp_path / "r/runs/lost-123")
    versions = P.Versions(spark, root)
    versions.clean(keep=2, grace_s=3600)
    assert len(os.listdir(tmp_path / "r/runs")) == 5 and versions.numbers() == [3, 4]
    versions.clean(keep=2, grace_s=-10)
    assert len(os.listdir(tmp_path / "r/runs")) == 2
    assert K.read_latest(spark, root).count() == 4


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        K.read_latest(spark, f"file://{tmp_path}/none")


DDL = "k string, obs_date date, v double, sent int"


def rows(spark, *values):
    import datetime as dt

    return spark.createDataFrame([(k, d and dt.date.fromisoformat(d), v, s) for k, d, v, s in values], DDL)


def held(table):
    return sorted(((r.k, str(r.obs_date), r.v) for r in table.read().collect()), key=str)


def test_corrections_replace_null_keys_and_the_last_sent_counts(spark, tmp_path):
    table = P.DayTable(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    table.correct(rows(spark, ("a", "2024-01-01", 1.0, 0), (None, "2024-01-01", 2.0, 0), ("a", "2024-01-02", 3.0, 0), ("b", None, 4.0, 0)), ["k"], "sent")
    table.correct(rows(spark, (None, "2024-01-01", 6.0, 2), (None, "2024-01-01", 5.0, 1), (None, "2024-01-01", 7.0, 2), ("b", None, 9.0, 1), ("c", "2024-01-01", None, 1)), ["k"], "sent")
    assert held(table) == sorted([("a", "2024-01-01", 1.0), (None, "2024-01-01", 7.0), ("a", "2024-01-02", 3.0), ("b", "None", 9.0), ("c", "2024-01-01", None)], key=str)
    contents = table.versions.contents()
    assert len(set(contents["days"].values())) == 3
    # the day that no correction touched is still in its first folder
    assert contents["days"]["2024-01-02"] == table.versions.contents(1)["days"]["2024-01-02"]


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    table = P.DayTable(spark, f"file://{tmp_path}/t")
    table.correct(rows(spark, ("a", "2024-01-01", 1.0, 0)), ["k"], source="s", batch=0)
    assert table.correct(rows(spark, ("a", "2024-01-01", 9.0, 0)), ["k"], source="s", batch=0) is None
    assert held(table) == [("a", "2024-01-01", 1.0)]
    with pytest.raises(P.Conflict):
        table.replace(rows(spark, ("a", "2024-01-01", 9.0, 0)), ["2024-01-01"], after=0)
    assert held(table) == [("a", "2024-01-01", 1.0)]
