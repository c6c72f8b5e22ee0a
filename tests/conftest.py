from __future__ import annotations

import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quotelake import LakeConfig  # noqa: E402
from quotelake.schemas import SILVER_SCHEMA  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(TESTDATA / "sf0.01")


@pytest.fixture
def lake(tmp_path) -> LakeConfig:
    return LakeConfig(root=str(tmp_path), max_lag_minutes=10**9)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def event(**changes) -> dict:
    """A complete raw event with invented values."""
    row = {
        "event_time": "2024-01-01T00:00:00.123456+00:00",
        "ingestion_run_id": "r1",
        "source": "api",
        "vs_currency": "usd",
        "coin_id": "a",
        "symbol": "a",
        "name": "A",
        "price_usd": 1.5,
        "market_cap_usd": 10,
        "total_volume_usd": 5,
        "price_change_percentage_24h": 0.1,
        "market_cap_rank": 1,
        "last_updated": "2024-01-01T00:00:00.000Z",
    }
    row.update(changes)
    return row


def write_lines(folder: str, name: str, *lines: dict | str, partition: int = 0) -> None:
    target = Path(folder) / f"partition={partition}"
    target.mkdir(parents=True, exist_ok=True)
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (target / name).write_text("\n".join(texts) + "\n")


def silver(spark, *rows: dict):
    """Silver rows; columns that are not given have one value throughout."""
    base = {
        "event_time_ts": at("2024-01-01T00:00:00"),
        "last_updated_ts": None,
        "ingestion_time": at("2024-02-01T00:00:00"),
        "ingestion_run_id": "r1",
        "source": "api",
        "vs_currency": "usd",
        "coin_id": "a",
        "symbol": "a",
        "name": "A",
        "market_cap_rank": 1,
        "price_usd": 1.0,
        "price_change_percentage_24h": 0.0,
        "market_cap_usd": 10.0,
        "total_volume_usd": 5.0,
        "source_file": "f",
    }
    full = []
    for row in rows:
        values = {**base, **row}
        values.setdefault("dt", values["event_time_ts"] and values["event_time_ts"].date())
        full.append(tuple(values[c] for c in SILVER_SCHEMA.fieldNames()))
    return spark.createDataFrame(full, SILVER_SCHEMA)


def rows_of(df, *without: str) -> list[tuple]:
    """Rows as sorted tuples, columns by name."""
    names = sorted(c for c in df.columns if c not in without)
    kinds = dict(df.dtypes)
    shown = [
        F.col(c).cast("string") if kinds[c] in ("timestamp", "double") else F.col(c)
        for c in names
    ]
    return sorted(map(tuple, df.select(*shown).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
