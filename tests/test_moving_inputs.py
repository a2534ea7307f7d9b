"""As-of joins, JSON arrays in ranges, tables that grow columns, upserts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from optionflow.operators import asof, board, registry
from optionflow.plans import profiles as P
from optionflow.sources import json_array, readers, schemas, sinks, versions


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_asof_equals_the_model(spark, chunk):
    rng = random.Random(4)
    left = [(rng.choice(["a", "b", None]), rng.choice([None, *range(60)]), i) for i in range(80)]
    right = [(rng.choice(["a", "b", None]), t, t * 10 + rng.randrange(3)) for t in rng.sample(range(-5, 70), 30)] + [("a", 5, 1), ("a", None, 2)]
    got = asof.asof_join(
        spark.createDataFrame(left, "k string, t bigint, n int"), spark.createDataFrame(right, "k string, s bigint, v int"), ["k"], "t", "s", ["v"], chunk
    )
    want = []
    for k, t, n in left:
        seen = [(s, v) for kk, s, v in right if kk == k and t is not None and s is not None and s <= t]
        want.append((k, t, n, max(seen)[1] if seen else None))
    key = lambda r: r[2]
    assert sorted((tuple(r) for r in got.collect()), key=key) == want


def test_asof_of_empty_tables(spark):
    left, right = spark.createDataFrame([], "k string, t bigint"), spark.createDataFrame([], "k string, s bigint, v int")
    assert asof.asof_join(left, right, ["k"], "t", "s", ["v"]).count() == 0
    one = spark.createDataFrame([("a", 1)], "k string, t bigint")
    assert asof.asof_join(one, right, ["k"], "t", "s", ["v"]).collect() == [("a", 1, None)]


def test_alerts_are_flagged_by_the_table_in_force(spark, tmp_path):
    path = str(tmp_path / "strikes")
    empty = [None] * 6
    for start, ce in ((100, "x"), (200, "y")):
        versions.write(spark.createDataFrame([("ONE", "u", 1.0, ce, "p", *empty)], schemas.STRIKE_TABLE), path, start)
    alerts = spark.createDataFrame([("x", "ONE", t) for t in (50, 100, 199, 200)] + [("p", "ONE", 500), ("p", "TWO", 500)], "instrument_key string, ticker string, alert_ms bigint")
    flagged = registry.with_atm_versions(alerts, versions.every(spark, path), versions.intervals(spark, path))
    got = {(r.ticker, r.instrument_key, r.alert_ms): (r.version, r.is_atm) for r in flagged.collect()}
    assert [got["ONE", "x", t] for t in (50, 100, 199, 200)] == [(None, False), (100, True), (100, True), (200, False)]
    assert got["ONE", "p", 500] == (200, True) and got["TWO", "p", 500] == (200, False)


ODD = ["}", "{", "[]", '"', "\\", '\\"}', '","}],[{"', "a\\\\", "é}\n{", "", '\\\\"']


@pytest.mark.parametrize("indent, size", [(None, 64), (2, 100), (None, 1 << 20)])
def test_json_array_in_ranges(spark, tmp_path, indent, size):
    rng = random.Random(size)
    rows = [{"a": rng.choice(ODD) + rng.choice(ODD), "n": i, "in": {"b": [rng.choice(ODD)] * rng.randrange(3), "c": {}}} for i in range(200)]
    path = str(tmp_path / "a.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, indent=indent, ensure_ascii=bool(size % 3))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert size > 1000 or spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 50
        got = json_array.elements(spark, path).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0]), spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert [r.seq for r in got] == list(range(200)) and [json.loads(r.value) for r in got] == rows


@pytest.mark.parametrize("text, n", [("[]", 0), ("[ ]\n", 0), ('[{"name":"x"}]', 1), ('\n[ {"name":"}"} ,\n {} ]\n', 2)])
def test_small_json_arrays(spark, tmp_path, text, n):
    (tmp_path / "a.json").write_text(text)
    got = readers.instrument_master(spark, str(tmp_path / "a.json")).orderBy("seq").collect()
    assert len(got) == n and (n != 2 or (got[0].name, got[1].name) == ("}", None))


def test_upserts_replace_rows_and_repeat_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.upsert(path, ["k"])
    batches = [[("a", 1), (None, 2)], [("b", 3), ("a", 4)], [(None, 5)], []]
    for i, rows in enumerate(batches):
        for _ in range(2):
            write(spark.createDataFrame(rows, "k string, v int"), i)
    assert sorted(tuple(r) for r in sinks.upserted(spark, path).collect() if r.k) == [("a", 4), ("b", 3)]
    assert [r.v for r in sinks.upserted(spark, path).collect() if r.k is None] == [5]
    assert versions.known(spark, path) == [2, 3]


def test_ranked_board(spark):
    scores = spark.createDataFrame([("a", 100.0, 5), ("b", 300.0, 5), ("c", 500.0, 0), ("d", 1.0, 0), ("e", 100.0, 5)], "ticker string, heat double, at_tick bigint")
    got = [tuple(r) for r in board.ranked(scores, 5).collect()]
    assert [(r, t) for r, t, _ in got] == [(1, "c"), (2, "b"), (3, "a"), (4, "e"), (5, "d")]
    assert got[0][2] == pytest.approx(500 * 0.98**5) and got[4][2] == 0
    assert len(board.ranked(scores, 5, n=2).collect()) == 2


def test_movers_document_is_json(spark):
    rows = [("A", "a", 1.5, 2.0, 1), ("B", "b", 3.0, None, 2), ("C", "c", 1.5, 1.0, 0)]
    movers = spark.createDataFrame(rows, "name string, symbol string, pct_change double, change double, line_no bigint")
    document = json.loads("".join(r.value for r in board.movers_document(movers).collect()))
    assert [s["name"] for s in document["stocks"]] == ["B", "C", "A"] and (document["count"], document["failed"]) == (3, 0)
    assert json.loads("".join(r.value for r in board.movers_document(movers.limit(0)).collect())) == {"stocks": [], "count": 0, "failed": 0}


def test_table_grows_columns(spark, tmp_path):
    name = "grown_log"
    spark.sql(f"drop table if exists {name}")
    sinks.create_alert_table(spark, name, P.RESET.name, str(tmp_path / "log"))
    day = F.lit("2024-01-01").cast("date").alias("trade_date")

    def rows(profile, n):
        fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ALERT_LOG[profile.name] if f.name != "oi"]
        return spark.range(n).select(day, F.col("id").alias("oi"), *fields)

    for batch, profile, n in ((0, P.RESET, 3), (1, P.SLIDING, 4), (1, P.SLIDING, 2), (2, P.RESET, 1)):
        sinks.append_to_table(spark, name, rows(profile, n), batch)
    assert {(r.batch_id, r["count"]) for r in spark.table(name).groupBy("batch_id").count().collect()} == {(0, 3), (1, 2), (2, 1)}
    assert {"side", "acceleration", "delta_pct"} < set(spark.table(name).columns)
    assert set(readers.alert_log(spark, str(tmp_path / "log")).columns) == set(spark.table(name).columns)
    spark.sql(f"drop table {name}")
