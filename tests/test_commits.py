"""Keyed appends: refused rows, failures at every step, and two writers at once."""

import os
import threading

import pytest
from conftest import rows

from dosewise.sources import commits
from dosewise.sources.tables import write_table

SCHEMA = "id int, day string, note string"
KEY = ("id", "day")


@pytest.fixture()
def table(spark, tmp_path):
    class Table:
        path = f"{tmp_path}/table"

        def frame(self, *cells):
            return spark.createDataFrame([tuple(c) for c in cells], SCHEMA)

        def append(self, *cells, **options):
            return commits.append_new(self.frame(*cells), self.path, KEY, **{"buckets": 8, **options})

        def read(self):
            return rows(spark.read.schema(SCHEMA).parquet(self.path))

        def hidden(self, name):
            folder = f"{self.path}/{name}"
            return sorted(n for n in os.listdir(folder) if n[0] != ".") if os.path.exists(folder) else []

    return Table()


def test_says_what_it_left_out(table, spark):
    first = table.append((1, "a", "x"), (2, "a", "x"), (None, "a", "x"))
    assert (first.version, first.n_added, first.n_refused) == (1, 3, 0) and first.refused.count() == 0
    again = table.append((2, "a", "corrected"), (None, "a", "x"), (3, None, "new"), (None, "3", "new"))
    assert (again.version, again.n_added, again.n_refused) == (2, 2, 2)
    assert rows(again.refused) == [(2, "a", "corrected"), (None, "a", "x")]
    assert len(table.read()) == 5
    nothing = table.append()
    assert nothing.version is None and table.append((1, "a", "y")).n_refused == 1
    assert commits.refused_rows(spark, table.path).count() == 3
    assert commits.refused_rows(spark, f"{table.path}/elsewhere") is None
    assert table.hidden("_staged") == []


def test_rows_that_came_by_other_ways_are_known(table, spark):
    write_table(table.frame((1, "a", "plain")), table.path)
    assert table.append((1, "a", "x"), (2, "a", "x")).n_refused == 1
    write_table(table.frame((3, "a", "plain"), (4, "b", "plain")), table.path)
    assert rows(table.append((3, "a", "x"), (4, "b", "x"), (2, "a", "x"), (5, "a", "x")).refused, "id") == [(2,), (3,), (4,)]
    assert [r[0] for r in table.read()] == [1, 2, 3, 4, 5]
    write_table(table.frame((9, "a", "alone")), table.path, mode="overwrite")
    assert table.append((1, "a", "x"), (9, "a", "x")).n_refused == 1 and len(table.read()) == 2


def test_reads_only_the_parts_of_the_index_it_needs(table, spark, monkeypatch):
    table.append(*[(i, "a", "x") for i in range(200)])
    read = []
    known = commits._known
    monkeypatch.setattr(commits, "_known", lambda folder, used: read.append(used) or known(folder, used))
    unread = commits._unindexed
    monkeypatch.setattr(commits, "_unindexed", lambda *given: (lambda found: found if not found[0] else pytest.fail("data was read"))(unread(*given)))
    assert table.append((5, "a", "y")).n_refused == 1
    assert len(read[0]) == 1 and len([n for n in table.hidden("_keys") if n.startswith("bucket=")]) == 8


def test_an_index_that_was_deleted_is_made_anew(table):
    import shutil

    table.append((1, "a", "x"), (2, "a", "x"))
    shutil.rmtree(f"{table.path}/_keys")
    assert table.append((1, "a", "y"), (3, "a", "y")).n_refused == 1
    assert table.append((1, "a", "y"), (2, "a", "y"), (3, "a", "y")).n_refused == 3
    assert len(table.read()) == 3


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_failure_between_files_is_finished_by_the_next(table, spark, monkeypatch, moved):
    table.append((1, "a", "x"))
    move, calls = commits.Folder.move, []

    def failing(self, source, target):
        if len(calls) == moved:
            raise OSError("the machine is gone")
        calls.append(target)
        move(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(commits.Folder, "move", failing)
        with pytest.raises(OSError, match="gone"):
            table.append(*[(i, "b", "y") for i in range(20)], (1, "a", "again"))
    assert table.hidden("_commits") == ["1", "2"] and len(table.hidden("_staged")) == 1
    assert commits.recover(spark, table.path) == 2
    assert len(table.read()) == 21 and table.hidden("_staged") == []
    assert commits.refused_rows(spark, table.path).count() == 1
    assert table.append(*[(i, "b", "y") for i in range(20)]).n_refused == 20


def test_a_failure_before_the_commit_leaves_nothing(table, monkeypatch):
    table.append((1, "a", "x"))
    with monkeypatch.context() as patch:
        patch.setattr(commits.Folder, "create", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.append((2, "a", "x"))
    assert table.read() == [(1, "a", "x")] and table.hidden("_staged") == [] and table.hidden("_commits") == ["1"]
    assert table.append((2, "a", "x")).version == 2


def test_overtaken_by_another_append(table, monkeypatch):
    """The other writer commits between this one's look at the keys and its own commit."""
    table.append((1, "a", "x"))
    create = commits.Folder.create
    others = []

    def late(self, text, *parts):
        if parts[0] == "_commits" and not others:
            others.append(None)
            others[0] = table.append((2, "a", "other"), (3, "a", "other"))
        return create(self, text, *parts)

    monkeypatch.setattr(commits.Folder, "create", late)
    mine = table.append((2, "a", "mine"), (4, "a", "mine"))
    assert (others[0].version, mine.version) == (2, 3)
    assert rows(mine.refused) == [(2, "a", "mine")]
    assert table.read() == [(1, "a", "x"), (2, "a", "other"), (3, "a", "other"), (4, "a", "mine")]


def test_two_writers_at_once(table):
    done, failed = [], []

    def write(name):
        try:
            for k in range(3):
                done.append(table.append(*[(i, "a", name) for i in range(4 * k, 4 * k + 6)]))
        except Exception as error:  # seen by the test below
            failed.append(error)

    writers = [threading.Thread(target=write, args=(name,)) for name in ("one", "two")]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not failed
    assert [r[0] for r in table.read()] == sorted(range(14), key=lambda i: (False, str(i)))
    assert sum(a.n_added for a in done) == 14 and len({a.version for a in done if a.version}) == len([a for a in done if a.version])


def test_partitions_and_other_formats(table, spark):
    for fmt in ("parquet", "json"):
        path = f"{table.path}-{fmt}"
        for _ in range(2):
            done = commits.append_new(table.frame((1, "a", "x"), (2, "b", "y")), path, KEY, fmt, ["day"], 4)
        assert done.n_refused == 2
        assert rows(spark.read.schema(SCHEMA).format(fmt).load(path), "id", "day") == [(1, "a"), (2, "b")]
        assert any(name.startswith("day=") for name in os.listdir(path))
