"""Instrument master -> option chain -> at-the-money strike table -> instrument dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import clock, text

# Market segment, contract types, names left out of the company chain.
SEGMENT = "NSE_FO"
OPTION_TYPES = ["PE", "CE"]
INDEX_MARK = "NSE_INDEX"
EXCLUDED_NAME = "RELIANCE"
OFFSETS = (4, 5, 6)

CONTRACT_COLUMNS = [
    "name",
    "expiry",
    "instrument_type",
    "asset_symbol",
    "instrument_key",
    "strike_price",
    "lot_size",
    "exchange_token",
    "tick_size",
    "trading_symbol",
    "underlying_key",
]
CHAIN_INDEX = ["name", "asset_symbol", "expiry", "strike_price", "lot_size", "tick_size", "underlying_key"]
CHAIN_COLUMNS = [
    "name",
    "asset_symbol",
    "expiry",
    "ce_instrument_key",
    "strike_price",
    "pe_instrument_key",
    "lot_size",
    "tick_size",
    "underlying_key",
]


def contracts(master: DataFrame, expiry: datetime) -> DataFrame:
    """Options of one expiry, given in zone-less UTC; `seq`, if present, is the file order."""
    seq = [F.col("seq")] if "seq" in master.columns else [F.monotonically_increasing_id().alias("seq")]
    return (
        master.select(*master.columns, *(seq if "seq" not in master.columns else []))
        .filter((F.col("segment") == SEGMENT) & F.col("instrument_type").isin(OPTION_TYPES))
        .select(*CONTRACT_COLUMNS, "seq")
        .withColumn("expiry", clock.utc_clock(F.col("expiry")))
        .filter(F.col("expiry") == F.lit(expiry).cast("timestamp_ntz"))
        .withColumn("strike_price", text.number(F.col("strike_price").cast("string")))
    )


def sorted_contracts(contracts: DataFrame) -> DataFrame:
    """By name, PE before CE, strike ascending (missing strikes last)."""
    put_first = F.when(F.col("instrument_type") == "PE", 0).otherwise(1)
    return contracts.orderBy("name", put_first, F.asc_nulls_last("strike_price"), "seq")


def option_chain(master: DataFrame, expiry: datetime) -> DataFrame:
    """CE and PE key side by side per strike: the first key of each side in file order.

    Contracts with a gap in an index column are not in the chain; a missing side is null.
    """
    first_key = F.min_by("instrument_key", "seq")
    kept = contracts(master, expiry).na.drop(subset=CHAIN_INDEX).filter(F.col("instrument_key").isNotNull())
    wide = kept.groupBy(*CHAIN_INDEX).pivot("instrument_type", OPTION_TYPES).agg(first_key)
    return wide.withColumnsRenamed({"CE": "ce_instrument_key", "PE": "pe_instrument_key"}).select(*CHAIN_COLUMNS)


def sorted_chain(chain: DataFrame) -> DataFrame:
    return chain.orderBy(*CHAIN_INDEX)


def _lacks(column: str, text: str):
    """Not containing the text; a null does not contain it."""
    return ~F.coalesce(F.contains(F.col(column), F.lit(text)), F.lit(False))


def companies(chain: DataFrame, excluded: str = EXCLUDED_NAME) -> DataFrame:
    """The chain without index underlyings and the excluded company."""
    return chain.filter(_lacks("underlying_key", INDEX_MARK) & _lacks("name", excluded))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def spot_prices(quotes: DataFrame) -> DataFrame:
    """Latest quote per underlying; a missing price stays null."""
    return quotes.groupBy("underlying_key").agg(F.max_by("last_price", "quoted_ms").alias("spot_price"))


def directional_strikes(chain: DataFrame, spot: DataFrame, offsets: Sequence[int] = OFFSETS) -> DataFrame:
    """Per underlying: both keys at the strike nearest to spot, puts `offsets` ranks below it
    and calls `offsets` ranks above it.

    Ranks count chain rows, so a strike listed twice takes two ranks; both show the keys of
    its first row. Only the strikes around the money are ever ranked: the nearest one comes
    from an aggregate, and the ranks from a window limited to max(offsets) rows.
    """
    reach = max(offsets)
    usable = spot.filter(F.col("spot_price").isNotNull() & (F.col("spot_price") != 0))
    place = F.struct("name", "asset_symbol", "expiry", "lot_size", "tick_size")
    # One row per strike; the group-by also folds repeated strikes before any shuffle.
    strikes = (
        chain.filter(F.col("strike_price").isNotNull())
        .groupBy("underlying_key", "strike_price")
        .agg(
            F.count(F.lit(1)).alias("listed"),
            F.min(
                F.struct(
                    place.alias("place"),
                    F.col("ce_instrument_key").alias("ce"),
                    F.col("pe_instrument_key").alias("pe"),
                )
            ).alias("row"),
        )
        .select("underlying_key", "strike_price", "listed", "row.place.name", "row.ce", "row.pe")
        .join(usable, "underlying_key")
    )
    away = F.abs(F.col("strike_price") - F.col("spot_price"))
    center = strikes.groupBy("underlying_key").agg(
        F.min(F.struct(away.alias("away"), F.col("strike_price").alias("atm"), F.col("listed").alias("atm_listed"))).alias("c"),
        F.min(F.struct("strike_price", "name")).alias("lowest"),
    )
    center = center.select("underlying_key", "c.atm", "c.atm_listed", F.col("lowest.name").alias("lowest_name"))
    placed = strikes.join(center, "underlying_key").withColumn(
        "side", F.signum(F.col("strike_price") - F.col("atm")).cast("int")
    )
    outward = W.partitionBy("underlying_key", "side").orderBy(F.col("side") * F.col("strike_price"))
    near = placed.withColumn("nth", F.row_number().over(outward)).filter(F.col("nth") <= reach)
    # Ranks taken by the strikes between this one and the money, repeats of the middle one above it.
    inner = F.sum("listed").over(outward.rowsBetween(W.unboundedPreceding, -1))
    offset_from = F.coalesce(inner, F.lit(0)) + F.when(F.col("side") > 0, F.col("atm_listed")).otherwise(1)
    ranked = near.withColumn(
        "from_rank", F.when(F.col("side") == 0, 0).otherwise(offset_from)
    ).withColumn("to_rank", F.col("from_rank") + F.col("listed") - 1)

    def key_at(side: int, offset: int, key: str):
        at = F.lit(offset).between(F.col("from_rank"), F.col("to_rank"))
        # above the money the repeats of the middle strike come first
        mine = (F.col("side") == side) | ((F.col("side") == 0) & F.lit(side > 0))
        return F.max(F.when(mine & at, F.col(key)))

    middle = F.col("side") == 0
    return (
        ranked.groupBy("underlying_key")
        .agg(
            F.first("lowest_name").alias("name"),
            F.first("spot_price").alias("spot_price"),
            F.max(F.when(middle, F.col("ce"))).alias("atm_ce"),
            F.max(F.when(middle, F.col("pe"))).alias("atm_pe"),
            *[key_at(-1, k, "pe").alias(f"minus_{k}_pe") for k in offsets],
            *[key_at(1, k, "ce").alias(f"plus_{k}_ce") for k in offsets],
        )
        .select(
            "name",
            "underlying_key",
            "spot_price",
            "atm_ce",
            "atm_pe",
            *[f"minus_{k}_pe" for k in offsets],
            *[f"plus_{k}_ce" for k in offsets],
        )
    )


def active_keys(strike_table: DataFrame) -> DataFrame:
    """Distinct instrument keys of every column after the first three."""
    columns = strike_table.columns[3:]
    return (
        strike_table.unpivot(["underlying_key"], columns, "slot", "instrument_key")
        .filter(F.col("instrument_key").isNotNull())
        .select("instrument_key")
        .distinct()
    )


def instrument_dim(chain: DataFrame, keys: DataFrame | None = None, calls_first: bool = False) -> DataFrame:
    """One row per instrument key: name, strike and type.

    On a key listed more than once the last chain row wins, PE after CE; with `calls_first`
    every CE row is older than every PE row. Without keys the whole chain is mapped.
    """
    stack = "stack(2, 'CE', ce_instrument_key, 0, 'PE', pe_instrument_key, 1) as (type, instrument_key, leg)"
    place = [F.col(c) for c in CHAIN_INDEX]
    rows = chain.select(*CHAIN_INDEX, F.expr(stack)).filter(F.col("instrument_key").isNotNull())
    if keys is not None:
        rows = rows.join(keys, "instrument_key", "left_semi")
    newest = F.struct("leg", *place) if calls_first else F.struct(*place, "leg")
    return (
        rows.groupBy("instrument_key")
        .agg(F.max(F.struct(newest.alias("age"), "name", F.col("strike_price").alias("strike"), "type")).alias("r"))
        .select("instrument_key", "r.name", "r.strike", "r.type")
    )


def atm_keys(strike_table: DataFrame, order: str = "underlying_key") -> DataFrame:
    """First strike-table row per name: its two at-the-money keys."""
    row = F.min(F.struct(F.col(order), F.col("atm_ce"), F.col("atm_pe")))
    return strike_table.groupBy("name").agg(row.alias("r")).select("name", "r.atm_ce", "r.atm_pe")
