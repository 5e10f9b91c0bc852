from __future__ import annotations

import pytest

from varloom.plans import versions


def _table(spark, folder, n):
    spark.range(n).write.mode("overwrite").parquet(f"{folder}/SNV")


def _read(spark, target):
    return spark.read.parquet(f"{versions.current_version(spark, target)}/data/SNV").count()


def test_a_job_killed_midway_leaves_the_old_set_whole(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "in"), str(tmp_path / "hub")
    assert versions.current_version(spark, target) is None
    _table(spark, source, 10)
    first = versions.publish_version(spark, source, target)
    assert first.copied == first.plan.count() and _read(spark, target) == 10
    _table(spark, source, 7)
    real = versions.point_to

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "point_to", dies)
    with pytest.raises(RuntimeError):
        versions.publish_version(spark, source, target)
    assert _read(spark, target) == 10
    monkeypatch.setattr(versions, "point_to", real)
    versions.publish_version(spark, source, target)
    assert _read(spark, target) == 7


def test_unchanged_files_come_from_the_version_in_force(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "hub")
    _table(spark, source, 10)
    versions.publish_version(spark, source, target)
    before = versions.current_version(spark, target)
    again = versions.publish_version(spark, source, target)
    assert again.copied == 0 and set(r.reason for r in again.plan.collect()) == {"size_match"}
    assert versions.current_version(spark, target) != before and _read(spark, target) == 10
    assert not [p.name for p in (tmp_path / "hub").iterdir() if p.name.startswith(".CURRENT-")]


def test_nothing_to_publish_changes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    done = versions.publish_version(spark, str(tmp_path / "in"), str(tmp_path / "hub"))
    assert done.copied == 0 and versions.current_version(spark, str(tmp_path / "hub")) is None
