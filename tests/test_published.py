"""Published tables: atomic replacement, run ledger, failures between the steps (SNK3-SNK5, RPT9)."""

import json

import pytest

from mallsight import sinks as S
from mallsight.sinks import published as P

SCHEMA = "day string, n long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_replace_and_keep(spark, tmp_path):
    root = str(tmp_path / "t")
    assert P.publish(spark, root, {"a": frame(spark, ("x", 1)), "b": frame(spark, ("y", 2))}) == {"a": True, "b": True}
    assert P.publish(spark, root, {"a": frame(spark, ("x", 3)), "b": frame(spark)}) == {"a": True, "b": False}
    assert rows(P.read_published(spark, root, "a")) == [("x", 3)] and rows(P.read_published(spark, root, "b")) == [("y", 2)]
    assert rows(P.read_published(spark, root, "a", version=1)) == [("x", 1)] and P.versions(spark, root) == [1, 2]
    assert P.publish(spark, root, {"a": frame(spark)}) == {"a": False} and P.versions(spark, root) == [1, 2]
    with pytest.raises(ValueError, match="no version 9"):
        P.read_published(spark, root, "a", version=9)
    with pytest.raises(ValueError, match="never published"):
        P.read_published(spark, root, "c")
    assert P.read_published(spark, root, "c", schema=frame(spark).schema).count() == 0
    assert P.forget_versions(spark, root, keep=1) == 1 and P.versions(spark, root) == [2]
    assert rows(P.read_published(spark, root, "a")) == [("x", 3)] and rows(P.read_published(spark, root, "b")) == [("y", 2)]


def test_a_run_again_replaces_its_rows(spark, tmp_path):
    target = str(tmp_path / "daily")
    for run, n in (("01", 1), ("02", 2), ("01", 7), ("02", 8), ("03", 9)):
        assert S.append_run(frame(spark, (run, n)), target, run)
    assert not S.append_run(frame(spark), target, "02") and not S.append_run(frame(spark), target, "04")
    assert rows(P.read_published(spark, target, S.ROWS)) == [("01", 7), ("02", 8), ("03", 9)]
    assert P.runs(spark, target, S.ROWS) == ["01", "02", "03"]


def test_named_table_runs_and_overwrites(spark):
    for t in ("ledger_t", "switch_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    for run, n in (("01", 1), ("02", 2), ("01", 7)):
        S.append_run(frame(spark, (run, n)), "ledger_t", run)
    assert not S.append_run(frame(spark), "ledger_t", "02") and S.append_run(frame(spark, ("q", 3)), "ledger_t", "it's")
    assert rows(spark.table("ledger_t").select("day", "n")) == [("01", 7), ("02", 2), ("q", 3)]
    assert S.overwrite_table(frame(spark, ("x", 1)), "switch_t") and rows(spark.table("switch_t")) == [("x", 1)]
    old = spark.table("switch_t")
    assert S.overwrite_table(frame(spark, ("x", 2)), "switch_t") and rows(spark.table("switch_t")) == [("x", 2)]
    assert rows(old) in ([("x", 1)], [("x", 2)]), "a reader of the version before still finds its files"
    assert not S.overwrite_table(frame(spark), "switch_t") and rows(spark.table("switch_t")) == [("x", 2)]
    wider = spark.createDataFrame([("x", 1, True)], SCHEMA + ", extra boolean")
    assert S.overwrite_table(wider, "switch_t") and rows(spark.table("switch_t")) == [("x", 1, True)]


def test_a_failed_commit_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    P.publish(spark, root, {"a": frame(spark, ("x", 1)), "b": frame(spark, ("x", 1))})

    def broken(self, old, new):
        raise OSError("no rename")
    with monkeypatch.context() as m:
        m.setattr(P._Store, "rename_new", broken)
        with pytest.raises(OSError, match="no rename"):
            P.publish(spark, root, {"a": frame(spark, ("x", 2)), "b": frame(spark, ("x", 2))})
    assert rows(P.read_published(spark, root, "a")) == [("x", 1)] and P.versions(spark, root) == [1]
    failing = frame(spark, ("x", 2)).selectExpr("day", "n / 0 AS n")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        P.publish(spark, root, {"a": frame(spark, ("x", 3)), "b": failing})
    assert rows(P.read_published(spark, root, "a")) == [("x", 1)], "no table of a bundle changes alone"
    left = [f.name for f in (tmp_path / "t" / "commits").iterdir() if not f.name.endswith(".crc")]
    assert left == [f"{1:020d}.json"], "no commit file left aside"


def test_two_writers_both_land(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rename, calls = P._Store.rename_new, []

    def slow(self, old, new):
        if not calls:  # another run commits the same number first
            calls.append(new)
            P.publish(spark, root, {"a": frame(spark, ("02", 2))}, run="02")
        return rename(self, old, new)
    monkeypatch.setattr(P._Store, "rename_new", slow)
    P.publish(spark, root, {"a": frame(spark, ("01", 1))}, run="01")
    assert rows(P.read_published(spark, root, "a")) == [("01", 1), ("02", 2)] and P.versions(spark, root) == [1, 2]
    commit = json.loads((tmp_path / "t" / "commits" / f"{2:020d}.json").read_text())
    assert set(commit["a"]) == {"01", "02"}


def test_a_failed_swap_moves_the_old_folder_back(spark, tmp_path):
    target = str(tmp_path / "t")
    S.overwrite_table(frame(spark, ("x", 1)), target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    real = path(target).getFileSystem(spark._jsc.hadoopConfiguration())

    class Broken:
        """A file system that cannot move the new folder in."""
        exists, delete = staticmethod(real.exists), staticmethod(real.delete)

        @staticmethod
        def rename(a, b):
            return "__new" not in a.toString() and real.rename(a, b)
    frame(spark, ("x", 2)).write.parquet(target + "__new_1")
    with pytest.raises(OSError, match="the old rows are in place"):
        S._swap_folders(Broken, path, target + "__new_1", target)
    assert rows(spark.read.parquet(target)) == [("x", 1)] and rows(spark.read.parquet(target + "__new_1")) == [("x", 2)]
    assert S.overwrite_table(frame(spark, ("x", 3)), target) and rows(spark.read.parquet(target)) == [("x", 3)]
