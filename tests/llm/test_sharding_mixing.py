import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from optionflow.llm import mixing, ranks, sharding
from optionflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string")


def odd(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", f"text {i}") for i in range(900)]
    rows += [(1000, None, None), (1001, None, ""), (None, "hot", "x"), (5, "hot", "text 5"), (5, "hot", "text 5")]
    return docs(spark, rows)


def test_shards_are_even_whole_and_mixed(spark, monkeypatch):
    monkeypatch.setattr(ranks, "CHUNK_ROWS", 20)
    df = odd(spark)
    got = sharding.shards(df, "source", ["doc_id", "text"], 24, seed=1).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == Counter(tuple(r) for r in df.collect())
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = Counter(r.shard for r in got if r.source == "hot")
    share = sum(hot.values()) / 24
    assert all(abs(hot[s] - share) < 3 for s in range(24))


def test_shards_do_not_depend_on_partitions(spark):
    df = odd(spark)
    one = sharding.shards(df.repartition(1), "source", ["doc_id", "text"], 24)
    two = sharding.shards(df.repartition(7, "text"), "source", ["doc_id", "text"], 24)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_fewer_rows_than_shards_and_none(spark):
    few = sharding.shards(docs(spark, [(1, "a", "x"), (2, "b", "y")]), "source", ["doc_id"], 24).collect()
    assert len({r.shard for r in few}) == 2 and {r.slot for r in few} == {0}
    assert sharding.shards(docs(spark, []), "source", ["doc_id"], 24).count() == 0


def test_op2_against_plain_sorting(spark):
    got = QUERIES["op2_stratified_shards"](spark, SF).collect()
    texts = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        body = (texts[r.doc_id][0] or "").encode()
        assert r.size == len(body) + 8 and r.text_crc32 == zlib.crc32(body) and r.law == "rows"
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    seen, totals = Counter(), Counter(s for _, s in texts.values())
    for place, r in enumerate(order):
        seen[r.source] += 1
        # a stratum's share of any first stretch is its share of the table, to about one row
        assert abs(seen[r.source] - totals[r.source] * (place + 1) / len(order)) <= 2


def test_draws_have_their_mean_and_are_repeatable(spark):
    df = docs(spark, [(i, "a" if i % 2 else "b", f"t{i}") for i in range(4000)])
    rates = spark.createDataFrame([("a", 0.5), ("b", 40.0)], "source string, rate double")
    got = mixing.replicate(df, rates, seed=9)
    counts = Counter(r.source for r in got.collect())
    assert abs(counts["a"] - 1000) < 4 * 1000**0.5 and abs(counts["b"] - 80000) < 4 * 80000**0.5
    again = mixing.replicate(df.repartition(3), rates, seed=9)
    assert again.select(F.sum(F.xxhash64("shuffle_key").cast("decimal(20)"))).first() == got.select(
        F.sum(F.xxhash64("shuffle_key").cast("decimal(20)"))
    ).first()


def test_inversion_against_the_definition(spark):
    import math

    table = spark.range(1).select(mixing.thresholds(F.lit(3.5)).alias("t")).first().t
    total = 0.0
    for k, bound in enumerate(table):
        total += math.exp(-3.5) * 3.5**k / math.factorial(k)
        assert abs(bound - total) < 1e-12


def test_mixture_of_odd_rows(spark):
    df = odd(spark)
    rates = mixing.tempered(df, 0.5, epochs=2.0)
    assert rates.filter("source is null").count() == 1
    copies = mixing.positions(mixing.replicate(df, rates))
    places = sorted(r.position for r in copies.select("position").collect())
    assert places == list(range(len(places))) and 1400 < len(places) < 2200
    mixed = mixing.shuffled(mixing.replicate(df, rates))
    assert mixed.count() == len(places)
    assert mixing.replicate(docs(spark, []), rates).count() == 0
    given = mixing.weighted(df, {"hot": 1.0}, epochs=1.0)
    assert {r.source for r in mixing.replicate(df, given).select("source").distinct().collect()} == {"hot"}


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError):
        mixing.replicate(docs(spark, []).withColumn("copy", F.lit(1)), mixing.tempered(docs(spark, []), 1.0))


def test_op2_equals_one_plain_sort(spark):
    """All 24 shards, slots and their order from windows over the whole table."""
    from pyspark.sql import Window as W

    seed, n = 0, 24
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "source", (F.octet_length(body) + 8).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    identity = ["doc_id", "text_crc32", "size"]
    mix = F.xxhash64(F.lit(seed), *identity)
    within = W.partitionBy("source").orderBy(F.shiftrightunsigned("mix", 11), "mix", *identity)
    offset = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("stratum"), "source"), 11).cast("double") * 2.0**-53
    share = (F.row_number().over(within) - 1 + offset) / F.count("*").over(W.partitionBy("source"))
    place = F.row_number().over(W.orderBy("share", "mix", *identity)) - 1
    plain = rows.withColumn("mix", mix).withColumn("share", share).withColumn("place", place).collect()
    total = len(plain)
    want = {}
    for r in plain:
        shard = r.place * n // total
        want[r.doc_id] = (shard, r.place - -(-shard * total // n))
    got = {r.doc_id: (r.shard, r.slot) for r in QUERIES["op2_stratified_shards"](spark, SF).collect()}
    assert got == want and {s for s, _ in want.values()} == set(range(24))


def test_clashing_names(spark):
    df = odd(spark)
    inner = df.withColumnsRenamed({"text": "position"}).withColumn("n_rows", F.lit(1))
    plain = sharding.shards(df.withColumn("n_rows", F.lit(1)), "source", ["doc_id", "text"], 24)
    got = sharding.shards(inner, "source", ["doc_id", "position"], 24)
    assert sorted((str(r.doc_id), r.shard, r.slot) for r in got.collect()) == sorted((str(r.doc_id), r.shard, r.slot) for r in plain.collect())
    for name in ("Shard", "slot", "__fraction"):
        with pytest.raises(ValueError, match=name.lower()):
            sharding.shards(df.withColumn(name, F.lit(1)), "source", ["doc_id"], 24)
    rates = mixing.tempered(df, 0.7)
    for name in ("PART", "shuffle_key", "__cdf"):
        with pytest.raises(ValueError, match=name.lower()):
            mixing.replicate(df.withColumn(name, F.lit(1)), rates)
    with pytest.raises(ValueError, match="position"):
        mixing.positions(mixing.replicate(df.withColumn("Position", F.lit(1)), rates))


def test_very_long_text(spark):
    df = docs(spark, [(1, "a", "word " * 400_000), (2, "a", "x"), (3, "b", None)])
    assert sharding.shards(df, "source", ["doc_id", "text"], 2).count() == 3
    copies = mixing.replicate(df, mixing.tempered(df, 1.0))
    assert {r.n for r in copies.select(F.length("text").alias("n")).collect()} <= {2_000_000, 1, None}
