"""Queries against their SQL on events of which many share a millisecond, and some a microsecond."""

import duckdb
import pytest

from oddsline.plans.catalog import ORACLES, QUERIES
from tests.conftest import DATA
from tests.oracle import connect, differences

# A copy differs in number, prices and its microsecond; the order of numbers is not that of times.
CLOSE = f"""
SELECT event_id + i * 100000 AS event_id,
  date_trunc('second', ts) + to_microseconds(CAST((event_id * 7 + i * 13) % 5 * 300 AS BIGINT)) AS ts,
  user_id + i % 3 * 35 AS user_id, event_type, value + i AS value,
  '{{"k": ' || CAST((CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) + i * 17) % 100 AS VARCHAR) || '}}' AS props
FROM range(8) copies(i), '{DATA}/sf0.001/events.parquet' ORDER BY i, event_id"""

NAMES = ("batch_view", "cells_to_rows", "merged_timeline", "live_price_1m", "live_ranges", "live_view",
         "live_view_newer", "live_view_upsert", "live_book_1m", "live_probability_ranges", "live_view_cells",
         "dedup_klines", "drop_repeated",
         "legacy_live_view")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("close")
    duckdb.sql(f"COPY ({CLOSE}) TO '{path}/events.parquet' (FORMAT parquet)")
    return str(path)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == []
