"""Stored event metadata: markets, tokens, outcomes, paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from oddsline import schemas
from oddsline.functions.times import as_column


_TOKEN_EVENT = schemas.struct(markets=T.ArrayType(schemas.struct(clobTokenIds=schemas.STRING)))
_OUTCOME_MARKET = T.StructType([schemas.MARKET_INFO[name] for name in (
    "id", "slug", "outcomes", "outcomePrices", "clobTokenIds")])


def _texts(json_list: Column) -> Column:
    """A JSON list of texts that is itself stored as a JSON text."""
    return F.from_json(json_list, "array<string>")


def parse_event_map(metadata: DataFrame, value: Column | str = "value",
                    carry: tuple[str, ...] = (),
                    event: T.StructType = schemas.EVENT_INFO) -> DataFrame:
    """One row (crypto, event) per entry of ``{"btc": {...}, "eth": {...}, ...}``.

    Fields missing from ``event`` are skipped by the parser.
    """
    parsed = F.from_json(as_column(value).cast("string"), T.MapType(T.StringType(), event))
    return (metadata.select(*carry, F.explode_outer(parsed).alias("crypto", "event"))
            .filter(F.col("crypto").isNotNull()))


def token_ids(metadata: DataFrame, value: Column | str = "value",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """Tokens of the first market of each event: (crypto, position, token_id).

    Events without markets or with an unreadable token list give no rows.
    """
    first_market = F.try_element_at("event.markets", F.lit(1))
    return (parse_event_map(metadata, value, carry, _TOKEN_EVENT)
            .select(*carry, "crypto", F.posexplode_outer(
                _texts(first_market["clobTokenIds"])).alias("position", "token_id"))
            .filter(F.col("token_id").isNotNull()))


def market_outcomes(markets: DataFrame, value: Column | str = "value",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """(market id, slug, outcome, price, token) for every outcome of a market object."""
    market = markets.select(*carry, F.from_json(as_column(value).cast("string"),
                                                _OUTCOME_MARKET).alias("m"))
    zipped = F.arrays_zip(_texts(F.col("m.outcomes")).alias("outcome"),
                          _texts(F.col("m.outcomePrices")).alias("price"),
                          _texts(F.col("m.clobTokenIds")).alias("token_id"))
    return (market.select(*carry, F.col("m.id").alias("market_id"), F.col("m.slug").alias("slug"),
                          F.posexplode_outer(zipped).alias("position", "o"))
            .filter(F.col("o").isNotNull())
            .select(*carry, "market_id", "slug", "position",
                    F.col("o.outcome").alias("outcome"),
                    F.col("o.price").try_cast("double").alias("price"),
                    F.col("o.token_id").alias("token_id")))


def events_page(events: DataFrame, closed: bool | None = None, limit: int | None = None,
                offset: int = 0, order: str = "id") -> DataFrame:
    """Stored events by id, optionally only closed/open ones and one page of them.

    ``limit=None`` gives all events; a page is a bounded top-k, not a full sort.
    """
    chosen = events if closed is None else events.filter(F.col("closed") == F.lit(closed))
    if limit is None and offset == 0:
        return chosen
    ordered = chosen.orderBy(order)
    if offset:
        ordered = ordered.offset(offset)
    return ordered if limit is None else ordered.limit(limit)
