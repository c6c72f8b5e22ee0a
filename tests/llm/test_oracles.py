"""Every text query with SQL gives the same rows in both engines."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from quotelake.llm.oracles import ORACLES
from quotelake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    engine = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        engine.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    frames = [QUERIES[name](spark, sf_dir).toPandas(), engine.sql(ORACLES[name]).df()]
    columns = sorted(frames[1].columns)
    sides = [frame[columns].sort_values(columns).reset_index(drop=True) for frame in frames]
    pd.testing.assert_frame_equal(*sides, check_dtype=False)
