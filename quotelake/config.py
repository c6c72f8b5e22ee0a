"""Paths and settings of one lake, from code or from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def _flag(text: str) -> bool:
    known = {"1": True, "true": True, "yes": True, "0": False, "false": False, "no": False}
    if text.strip().lower() not in known:
        raise ValueError(f"a flag is true or false, not {text!r}")
    return known[text.strip().lower()]


@dataclass(frozen=True)
class LakeConfig:
    """Where the tables of one lake lie and how its jobs are tuned.

    ``root`` is any Hadoop path every executor can reach; all other paths are
    relative to it.
    """

    root: str
    # Default table locations, limits and poll settings.
    pages_prefix: str = "landing/pages"
    bronze_prefix: str = "bronze/crypto_quotes_raw"
    silver_history_prefix: str = "silver/crypto_quotes_history"
    silver_latest_prefix: str = "silver/crypto_quotes_latest"
    gold_quotes_prefix: str = "gold/quotes_1m"
    gold_daily_prefix: str = "gold/daily_symbol"
    gold_snapshot_prefix: str = "gold/latest_snapshot"
    topic: str = "crypto_quotes_raw"
    vs_currency: str = "usd"
    source: str = "market_api"
    poll_seconds: int = 60
    coin_ids: tuple[str, ...] = ()
    max_lag_minutes: int = 20000
    # None leaves the session's own number of shuffle partitions in place.
    shuffle_partitions: int | None = None
    # "replace" makes a second run a no-op; "append" adds the rows again; "delta"
    # keeps gold by what changes, and is for a lake from its first run on.
    gold_write: str = "replace"
    # Folders of coins below a day of quotes that are kept by deltas.
    delta_buckets: int = 16
    reject_nan: bool = False
    # Backfills: deduplicate this many days per job, None for all in one job.
    days_per_job: int | None = None
    # Brokers of the topic, as the connector takes them.
    servers: str = ""
    # Gold is made of whole days: less often than the polls come.
    serve_seconds: int = 600
    # None leaves the size of files and of batches to Spark.
    records_per_file: int | None = None
    files_per_batch: int | None = None
    # Gather each day in few files, at the price of a shuffle.
    cluster_history: bool = True
    # For a history whose amounts are longs already: it goes on with longs.
    integral_amounts: bool = False

    def __post_init__(self) -> None:
        if not self.root:
            raise ValueError("a lake needs a root path")
        if self.gold_write not in ("replace", "append", "delta"):
            raise ValueError(f"gold_write is 'replace', 'append' or 'delta', not {self.gold_write!r}")
        for name in ("delta_buckets", "days_per_job", "records_per_file", "files_per_batch", "serve_seconds"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} is at least 1")

    def path(self, prefix: str) -> str:
        return f"{self.root.rstrip('/')}/{prefix.strip('/')}"

    @property
    def pages(self) -> str:
        return self.path(self.pages_prefix)

    @property
    def records(self) -> str:
        """Files of keyed JSON records, where there is no broker."""
        return self.path(f"topics/{self.topic}")

    @property
    def bronze(self) -> str:
        return self.path(self.bronze_prefix)

    @property
    def history(self) -> str:
        return self.path(self.silver_history_prefix)

    @property
    def latest(self) -> str:
        return self.path(self.silver_latest_prefix)

    @property
    def quotes(self) -> str:
        return self.path(self.gold_quotes_prefix)

    @property
    def daily(self) -> str:
        return self.path(self.gold_daily_prefix)

    @property
    def snapshot(self) -> str:
        return self.path(self.gold_snapshot_prefix)

    @property
    def staging(self) -> str:
        """Deduplicated quotes of the last gold run, checked before publishing."""
        return self.path("staging/gold_quotes")

    @property
    def latest_staging(self) -> str:
        """Latest rows of the days the last micro-batch touched."""
        return self.path("staging/silver_latest")

    @property
    def daily_state(self) -> str:
        """What daily metrics that are kept by deltas are made of."""
        return self.path("state/gold_daily")

    @property
    def changes_staging(self) -> str:
        """New quotes of the last batch, ranked against those there were."""
        return self.path("staging/gold_changes")

    @property
    def state_staging(self) -> str:
        """Daily state of the days the last batch touched."""
        return self.path("staging/gold_state")

    @property
    def snapshot_staging(self) -> str:
        """The snapshot after the last batch of its stream."""
        return self.path("staging/gold_snapshot")

    @property
    def check_states(self) -> str:
        """The checks of the history, by day."""
        return self.path("state/history_checks")

    @property
    def check_staging(self) -> str:
        """Check states of the days the last batch touched."""
        return self.path("staging/history_checks")

    @property
    def run_log(self) -> str:
        """What every poll and batch did."""
        return self.path("log/runs")

    @property
    def compacted(self) -> str:
        """History files that stand for many small ones, and the list of those."""
        return self.path("compacted/history")

    @property
    def quarantine(self) -> str:
        return self.path("quarantine/bronze")

    @property
    def rejects(self) -> str:
        """Topic records that did not land."""
        return self.path("quarantine/topic")

    def checkpoint(self, stream: str) -> str:
        return self.path(f"checkpoints/{stream}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> LakeConfig:
        """Read the settings from environment variables.

        Only the place is required: a bucket, or any root path as ``LAKE_ROOT``.
        """
        env = os.environ if env is None else env
        root = env.get("LAKE_ROOT")
        if not root:
            bucket = env.get("S3_BUCKET_NAME")
            if not bucket:
                raise ValueError("set LAKE_ROOT or S3_BUCKET_NAME")
            root = f"s3a://{bucket}"

        # Variable names, each with the field it sets and its type.
        known = {
            "BRONZE_PREFIX": ("bronze_prefix", str),
            "SILVER_HISTORY_PREFIX": ("silver_history_prefix", str),
            "SILVER_LATEST_PREFIX": ("silver_latest_prefix", str),
            "GOLD_QUOTES_PREFIX": ("gold_quotes_prefix", str),
            "GOLD_DAILY_PREFIX": ("gold_daily_prefix", str),
            "GOLD_SNAPSHOT_PREFIX": ("gold_snapshot_prefix", str),
            "GOLD_FRESHNESS_MAX_LAG_MINUTES": ("max_lag_minutes", int),
            "GOLD_SHUFFLE_PARTITIONS": ("shuffle_partitions", int),
            "KAFKA_TOPIC": ("topic", str),
            "POLL_SECONDS": ("poll_seconds", int),
            "VS_CURRENCY": ("vs_currency", str),
            "GOLD_DAYS_PER_JOB": ("days_per_job", int),
            "GOLD_WRITE": ("gold_write", str),
            "GOLD_DELTA_BUCKETS": ("delta_buckets", int),
            "GOLD_REJECT_NAN": ("reject_nan", _flag),
            "KAFKA_BOOTSTRAP_SERVERS": ("servers", str),
            "SERVE_SECONDS": ("serve_seconds", int),
            "RECORDS_PER_FILE": ("records_per_file", int),
            "FILES_PER_BATCH": ("files_per_batch", int),
            "CLUSTER_HISTORY": ("cluster_history", _flag),
            "INTEGRAL_AMOUNTS": ("integral_amounts", _flag),
        }
        given = {
            field: convert(env[name])
            for name, (field, convert) in known.items()
            if env.get(name)
        }
        ids = tuple(part.strip() for part in env.get("COIN_IDS", "").split(",") if part.strip())
        return cls(root=root, coin_ids=ids, **given)
