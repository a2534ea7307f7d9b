import random
from datetime import datetime

import pytest
from pyspark.sql import types as T

from optionflow.operators import chain as chains
from optionflow.sources import schemas

from . import model

EXPIRY = datetime(2026, 2, 24, 18, 29, 59)
MS = 1771957799000


def contract(key, kind, strike, name="ACME", seq=0, **over):
    row = dict(
        segment="NSE_FO",
        name=name,
        expiry=MS,
        instrument_type=kind,
        asset_symbol=f"S{name}",
        instrument_key=key,
        strike_price=strike,
        lot_size=25,
        exchange_token=None,
        tick_size=5.0,
        trading_symbol=None,
        underlying_key=f"NSE_EQ|{name}",
        seq=seq,
    )
    return {**row, **over}


def master(spark, rows):



    schema = T.StructType([*schemas.INSTRUMENT_MASTER, T.StructField("seq", T.LongType())])
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def test_chain_pivot_and_filters(spark):
    rows = [
        contract("c1", "CE", 100.0, seq=1),
        contract("p1", "PE", 100.0, seq=2),
        contract("c1b", "CE", 100.0, seq=3),  # second key of the same place
        contract("c2", "CE", 110.0, seq=4),  # no PE
        contract("x1", "CE", None, seq=5),  # gap in the index
        contract("x2", "FUT", 100.0, seq=6),
        contract("x3", "CE", 100.0, seq=7, segment="NSE_EQ"),
        contract("x4", "CE", 100.0, seq=8, expiry=MS - 1000),
        contract("p3", "PE", 120.0, seq=9, lot_size=50),
    ]
    out = chains.sorted_chain(chains.option_chain(master(spark, rows), EXPIRY)).collect()
    got = [(r.strike_price, r.ce_instrument_key, r.pe_instrument_key, r.lot_size) for r in out]
    assert got == [(100.0, "c1", "p1", 25), (110.0, "c2", None, 25), (120.0, None, "p3", 50)]
    assert out[0].expiry == EXPIRY and list(out[0].asDict()) == chains.CHAIN_COLUMNS


def test_contract_order(spark):
    rows = [
        contract("b", "CE", 90.0, seq=1),
        contract("d", "PE", 200.0, seq=2),
        contract("c", "PE", 100.0, seq=3),
        contract("e", "PE", None, seq=4),
        contract("a", "CE", 50.0, name="AAA", seq=5),
    ]
    out = chains.sorted_contracts(chains.contracts(master(spark, rows), EXPIRY)).collect()
    assert [r.instrument_key for r in out] == ["a", "c", "d", "e", "b"]


def test_companies_keeps_nulls(spark):
    rows = [("A", "NSE_EQ|A"), ("RELIANCE X", "NSE_EQ|R"), ("B", "NSE_INDEX|B"), (None, "NSE_EQ|N"), ("C", None)]
    df = spark.createDataFrame(rows, "name string, underlying_key string")
    assert [tuple(r) for r in chains.companies(df).collect()] == [rows[0], rows[3], rows[4]]
    assert {r[0] for r in chains.distinct_values(df, "underlying_key").collect()} == {r[1] for r in rows if r[1]}


def chain_frame(spark, rows):
    """rows: (underlying, name, strike, ce, pe, lot)"""
    full = [(n, f"S{n}", EXPIRY, ce, k, pe, lot, 5.0, u) for u, n, k, ce, pe, lot in rows]
    return spark.createDataFrame(full, schemas.OPTION_CHAIN)


@pytest.mark.parametrize("seed", range(4))
def test_directional_strikes_equal_the_model(spark, seed):
    rng = random.Random(seed)
    rows, spots = [], []
    for u in range(12):
        n = rng.choice([1, 3, 8, 20])
        for i in range(n):
            strike = float(rng.randrange(1, 15) * 10)
            rows.append((f"u{u:02}", f"n{u}", strike, f"ce{u}-{i:02}", f"pe{u}-{i:02}" if i % 3 else None, 25 + i))
        spots.append((f"u{u:02}", rng.choice([float(rng.randrange(0, 160)), rng.randrange(0, 32) * 5.0, None, 0.0])))
    spot = spark.createDataFrame(spots, "underlying_key string, spot_price double")
    out = chains.directional_strikes(chain_frame(spark, rows), spot).collect()
    got = {r.underlying_key: (r.name, *r[3:]) for r in out}
    want = {}
    for u, price in spots:
        # lot size puts rows of one strike in their listing order
        mine = [(n, k, ce, pe) for uu, n, k, ce, pe, _ in rows if uu == u]
        if price:
            want[u] = model.strikes(mine, price)
    assert got == want


def test_midway_spot_takes_the_lower_strike(spark):
    rows = [("u", "n", float(k), f"c{k}", f"p{k}", 25) for k in (100, 110)]
    spot = spark.createDataFrame([("u", 105.0)], "underlying_key string, spot_price double")
    (row,) = chains.directional_strikes(chain_frame(spark, rows), spot, offsets=(1, 2)).collect()
    assert (row.atm_ce, row.plus_1_ce, row.plus_2_ce, row.minus_1_pe) == ("c100", "c110", None, None)


def test_latest_quote_counts_even_if_missing(spark):
    rows = [("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 1), ("b", None, 5)]
    df = spark.createDataFrame(rows, schemas.SPOT_QUOTE)
    assert sorted(map(tuple, chains.spot_prices(df).collect())) == [("a", 2.0), ("b", None)]


def test_instrument_dim_last_row_wins(spark):
    rows = [
        ("u", "A", 100.0, "x", "y", 25),
        ("u", "A", 110.0, "y", "x", 25),
        ("u", "A", 120.0, "z", None, 25),
    ]
    chain = chain_frame(spark, rows)
    read = lambda df: {r.instrument_key: (r.strike, r.type) for r in df.collect()}
    # row by row: later rows win, PE after CE
    assert read(chains.instrument_dim(chain)) == {"x": (110.0, "PE"), "y": (110.0, "CE"), "z": (120.0, "CE")}
    # all CE rows first: a PE row always wins
    assert read(chains.instrument_dim(chain, calls_first=True)) == {"x": (110.0, "PE"), "y": (100.0, "PE"), "z": (120.0, "CE")}
    keys = spark.createDataFrame([("z",)], "instrument_key string")
    assert read(chains.instrument_dim(chain, keys)) == {"z": (120.0, "CE")}


def test_active_keys_and_atm(spark):
    row = lambda n, u, *k: (n, u, 1.0, *k)
    rows = [row("A", "u1", "a", "b", "c", None, "a", "d", None, None), row("A", "u2", "e", None, *[None] * 6)]
    table = spark.createDataFrame(rows, schemas.STRIKE_TABLE)
    assert sorted(r[0] for r in chains.active_keys(table).collect()) == ["a", "b", "c", "d", "e"]
    assert [tuple(r) for r in chains.atm_keys(table).collect()] == [("A", "a", "b")]
