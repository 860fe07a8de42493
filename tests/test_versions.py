"""Versioned folders: failed writes, audits, partitions, two writers, vacuum, decisions."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from millrace.sources.versions import AuditFailed, Conflict, DecisionLog, VersionedFolder


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, n int")


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    folder = VersionedFolder(spark, str(tmp_path))
    with pytest.raises(KeyError):
        folder.read()
    good = frame(spark, ("a", 1), ("b", 2))
    assert folder.publish(good).number == 1
    broken = good.repartition(2).withColumn("n", F.when(F.col("k") == "b", F.raise_error(F.lit("midway")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="midway"):
        folder.publish(broken)
    with pytest.raises(AuditFailed, match="large"):
        folder.publish(frame(spark, ("c", 9)), {"some": lambda df: not df.isEmpty(), "large": lambda df: df.where("n > 9").count() > 0})
    assert rows(folder.read()) == [("a", 1), ("b", 2)] and folder.versions() == [1]
    assert os.listdir(tmp_path / "data") == [os.path.basename(folder.current().folders[""])]
    folder.publish(frame(spark))
    assert rows(folder.read()) == [] and rows(folder.read(1)) == [("a", 1), ("b", 2)]
    with pytest.raises(KeyError):
        folder.read(7)


def test_partitions_are_replaced_kept_and_dropped(spark, tmp_path):
    folder = VersionedFolder(spark, f"file://{tmp_path}/with space")
    folder.publish(frame(spark, ("a", 1), ("b/é =%", 2), (None, 3), ("c", 4)), by="k")
    old = folder.current()
    folder.publish(frame(spark, ("b/é =%", 20), ("d", 5)), by="k", expected=["a", "b/é =%", "d", "not there"])
    assert sorted(folder.read().collect()) == [("a", 1), ("b/é =%", 20), ("d", 5)]
    assert folder.current().folders["a"] == old.folders["a"]
    assert folder.vacuum(keep=2) == []
    gone = folder.vacuum(keep=1)
    assert folder.versions() == [2] and len(gone) == 3 and sorted(folder.read().collect()) == [("a", 1), ("b/é =%", 20), ("d", 5)]


def test_one_of_two_writers_is_refused(spark, tmp_path):
    folder = VersionedFolder(spark, str(tmp_path))
    base = folder.publish(frame(spark, ("a", 0)))

    def write(n):
        try:
            return VersionedFolder(spark, str(tmp_path)).publish(frame(spark, ("a", n)), base=base).number
        except Conflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(write, range(1, 5)))
    assert sorted(x for x in done if x) == [2] and rows(folder.read()) == [("a", done.index(2) + 1)]
    assert len(os.listdir(tmp_path / "data")) == 2 and all(n.endswith(".json") for n in os.listdir(tmp_path / "_log") if not n.startswith("."))


def test_decisions(spark, tmp_path):
    log = DecisionLog(spark, str(tmp_path), "k")
    decided = lambda *d: spark.createDataFrame(list(d), "k string, decision string, note string")
    records = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "k string, n int")
    assert rows(log.merge(records, {"decision": F.lit("pending")})) == [("a", 1, "pending", 0), ("b", 2, "pending", 0), ("z", 3, "pending", 0)]
    first = log.append(decided(("a", "approved", "x"), ("b", "approved", None)))
    log.append(decided(("a", "rejected", "y")))
    with pytest.raises(Conflict):
        log.append(decided(("b", "late", None)), first)
    with pytest.raises(AuditFailed):
        log.append(decided(("b", "one", None), ("b", "two", None)))
    with pytest.raises(ValueError, match="other columns"):
        log.append(frame(spark, ("a", 1)))
    want = [("a", "rejected", "y", 2), ("b", "approved", None, 1)]
    assert sorted(map(tuple, log.state().collect())) == want and log.history().count() == 3 and sorted(map(tuple, log.state(1).collect())) == [("a", "approved", "x", 1), ("b", "approved", None, 1)]
    assert log.compact().number == 3 and log.history().count() == 2 and sorted(map(tuple, log.state().collect())) == want
    assert log.compact().number == 3
    log.append(decided(("b", "rejected", "w")))
    got = log.merge(records, {"decision": F.lit("pending")}).select("k", "n", "decision", "note", "_version").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "rejected", "y", 2), ("b", 2, "rejected", "w", 4), ("z", 3, "pending", None, 0)]
