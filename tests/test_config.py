"""Settings from code and from the environment, session and scratch paths."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from quotelake import LakeConfig, session
from quotelake.operators import clean_events
from quotelake.session import require_utc, scratch_path, shuffle_partitions, use_settings


def test_bucket_is_required():
    with pytest.raises(ValueError, match="S3_BUCKET_NAME"):
        LakeConfig.from_env({})


def test_defaults_from_the_environment():
    lake = LakeConfig.from_env({"S3_BUCKET_NAME": "b"})
    assert lake.bronze == "s3a://b/bronze/crypto_quotes_raw"
    assert lake.history == "s3a://b/silver/crypto_quotes_history"
    assert lake.latest == "s3a://b/silver/crypto_quotes_latest"
    assert lake.quotes == "s3a://b/gold/quotes_1m"
    assert lake.daily == "s3a://b/gold/daily_symbol"
    assert lake.snapshot == "s3a://b/gold/latest_snapshot"
    assert lake.max_lag_minutes == 20000 and lake.shuffle_partitions is None


def test_environment_overrides():
    lake = LakeConfig.from_env(
        {
            "S3_BUCKET_NAME": "b",
            "BRONZE_PREFIX": "/raw/",
            "GOLD_FRESHNESS_MAX_LAG_MINUTES": "5",
            "GOLD_SHUFFLE_PARTITIONS": "64",
            "COIN_IDS": " a, ,b ",
            "POLL_SECONDS": "",
        }
    )
    assert lake.bronze == "s3a://b/raw"
    assert (lake.max_lag_minutes, lake.shuffle_partitions) == (5, 64)
    assert lake.coin_ids == ("a", "b") and lake.poll_seconds == 60


@pytest.mark.parametrize("bad", [{"root": ""}, {"gold_write": "merge"}, {"days_per_job": 0}])
def test_bad_settings_are_refused(bad):
    with pytest.raises(ValueError):
        LakeConfig(**{"root": "/r", **bad})


def test_shuffle_partitions_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    with shuffle_partitions(spark, None):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


class FakeSession:
    """What ``scratch_path`` asks of a session."""

    def __init__(self, master, **settings):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))


def test_scratch_lies_in_the_shared_folder(monkeypatch):
    cluster = FakeSession("spark://host", **{"spark.checkpoint.dir": "hdfs://shared/x/"})
    monkeypatch.setattr(session, "_SHARED_SCRATCH", [])
    first, second = scratch_path(cluster, "a"), scratch_path(cluster, "a")
    assert first != second
    assert all(path.startswith("hdfs://shared/x/quotelake-a-") for path in (first, second))


def test_shared_scratch_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_SHARED_SCRATCH", [(spark, str(tmp_path / "x"))])
    spark.range(3).write.parquet(str(tmp_path / "x"))
    session.remove_scratch()
    assert not (tmp_path / "x").exists() and not session._SHARED_SCRATCH


def test_scratch_without_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession("spark://host"), "a")
    assert Path(scratch_path(FakeSession("local[2]"), "a")).is_dir()


def test_settings_are_reached_from_the_environment():
    env = {
        "LAKE_ROOT": "x",
        "KAFKA_BOOTSTRAP_SERVERS": "b:1",
        "RECORDS_PER_FILE": "50",
        "FILES_PER_BATCH": "7",
        "CLUSTER_HISTORY": "false",
        "INTEGRAL_AMOUNTS": "yes",
        "GOLD_WRITE": "append",
        "GOLD_REJECT_NAN": "1",
        "SERVE_SECONDS": "30",
    }
    lake = LakeConfig.from_env(env)
    assert (lake.servers, lake.records_per_file, lake.files_per_batch, lake.serve_seconds) == ("b:1", 50, 7, 30)
    assert (lake.cluster_history, lake.integral_amounts, lake.gold_write, lake.reject_nan) == (False, True, "append", True)
    with pytest.raises(ValueError, match="flag"):
        LakeConfig.from_env({**env, "CLUSTER_HISTORY": "maybe"})


def test_other_zones_are_refused_or_set(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="Asia/Tokyo"):
            require_utc(spark)
        with pytest.raises(ValueError, match="UTC"):
            clean_events(spark.range(1))
    finally:
        use_settings(spark)
    require_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
