"""Shaping of serving views: flat rows, column families, cells and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from oddsline import schemas
from oddsline.config import (BATCH_CELLS, EVENT_CELLS, EVENT_FAMILY, EVENT_KEY, KEY_SEPARATOR, LIVE_CELLS,
                             NUMBER, PRICE_ROWS)
from oddsline.functions import rowkeys

CELL_COLUMNS = ("rowkey", "family", "qualifier", "value")


def batch_view(analysis: DataFrame) -> DataFrame:
    """The flat batch view: row key, renamed prices, bets and verdict of each window."""
    return analysis.select(
        rowkeys.batch_rowkey("symbol", "window_start").alias("rowkey"),
        F.col("window_start").cast("string").alias("timestamp"), "crypto", "symbol",
        F.col("window_open").alias("price_open"), F.col("window_close").alias("price_close"),
        F.col("window_high").alias("price_high"), F.col("window_low").alias("price_low"),
        "avg_volume", "avg_probability", "max_probability",
        F.col("bet_activity_count").cast("int").alias("bet_activity_count"),
        "price_movement", "actual_direction", "predicted_direction", "prediction_result")


def live_view(aggregated: DataFrame, row_type: str, truncate: int | None = None) -> DataFrame:
    """Flat live rows of one type: row key, window end and the cells of that type."""
    identifier = "symbol" if row_type == PRICE_ROWS else "market_id"
    _, cells = LIVE_CELLS[row_type]
    end_ms = F.unix_millis("window_end")
    keyed = aggregated.withColumn("window_end_ms", end_ms)
    return keyed.select(
        rowkeys.live_rowkey(row_type, identifier, "window_end_ms", truncate).alias("rowkey"),
        F.col(identifier).alias("identifier"),
        *[F.col(column).alias(qualifier) for qualifier, column in cells.items()])


def event_view(events: DataFrame) -> DataFrame:
    """Flat live rows of the older one-row-per-event format.

    Events of one symbol and millisecond share a row key. Events with a number also get an
    ``event_key``, the row key and the number, which no two of them share.
    """
    rowkey = rowkeys.event_rowkey("symbol", "timestamp")
    numbered = [F.concat_ws(KEY_SEPARATOR, rowkey, F.col(NUMBER).cast("string")).alias(EVENT_KEY)]
    return events.select(*(numbered if NUMBER in events.columns else []), rowkey.alias("rowkey"),
                         F.col("symbol").alias("identifier"),
                         F.col("timestamp").alias("window_end"), *EVENT_CELLS)


def families(flat: DataFrame, cells: dict[str, dict[str, str]] = BATCH_CELLS) -> DataFrame:
    """Row key plus one struct per column family."""
    return flat.select("rowkey", *[
        F.struct(*[F.col(column).alias(q) for q, column in qualifiers.items()]).alias(family)
        for family, qualifiers in cells.items()])


def batch_cells() -> dict[str, dict[str, str]]:
    return BATCH_CELLS


def live_cells(row_type: str) -> dict[str, dict[str, str]]:
    """Cells of flat live rows, whose columns already carry the qualifier names."""
    family, cells = LIVE_CELLS[row_type]
    return {family: {q: q for q in cells}}


def event_cells() -> dict[str, dict[str, str]]:
    return {EVENT_FAMILY: {q: q for q in EVENT_CELLS}}


def to_cells(flat: DataFrame, cells: dict[str, dict[str, str]], carry: tuple[str, ...] = ()) -> DataFrame:
    """Long form (rowkey, family, qualifier, value as text); null values give no cell."""
    entries = F.array(*[
        F.struct(F.lit(family).alias("family"), F.lit(q).alias("qualifier"),
                 F.col(column).cast("string").alias("value"))
        for family, qualifiers in cells.items() for q, column in qualifiers.items()])
    return (flat.select("rowkey", *carry, F.explode_outer(entries).alias("cell"))
            .select("rowkey", *carry, "cell.*").filter(F.col("value").isNotNull()))


def from_cells(cells: DataFrame, types: dict[str, str], version: str | None = None) -> DataFrame:
    """Cells back to one row per key with typed columns ``{qualifier: type}``.

    Given a ``version`` column, the newest version of each cell counts, else the largest
    value.  Texts become typed before they are aggregated, so numbers keep a hash aggregate.
    """
    def pick(qualifier: str, kind: str) -> Column:
        hit = F.col("qualifier") == qualifier
        value = F.col("value").try_cast(kind)
        if version is None:
            return F.max(F.when(hit, value)).alias(qualifier)
        return F.max_by(value, F.when(hit, F.col(version))).alias(qualifier)

    return cells.groupBy("rowkey").agg(*[pick(q, kind) for q, kind in types.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema: missing nullable columns become null, missing values in
    required columns are an error."""
    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            if not field.nullable:
                raise ValueError(f"required column {field.name} is missing")
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(
                F.lit(f"null in required column {field.name}")).cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema])


def legacy_batch_frame(df: DataFrame) -> DataFrame:
    return conform(df, schemas.LEGACY_BATCH)


def legacy_live_frame(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return conform(df, T.StructType([*schemas.LEGACY_LIVE.fields, *[df.schema[c] for c in keep]]))


def legacy_batch_view(frame: DataFrame) -> DataFrame:
    """Older batch records keyed by ``SYMBOL#<window end>``."""
    return frame.withColumn("rowkey", rowkeys.window_end_rowkey("symbol", "window_end_ts"))
