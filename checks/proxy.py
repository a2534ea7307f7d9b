"""Option-market shaped views over the given tables, used by the registered queries.

Every view is derived by Spark from the whole table it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from optionflow.operators import ordered, registry

START_US = 1_704_067_200_000_000  # 2024-01-01
CHUNK_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts) -> F.Column:
    """Microseconds of a zone-less timestamp, whatever the session zone is."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", epoch, ts)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monotone tick feed: one instrument per user, time compressed a thousandfold."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    event_id = F.col("event_id")
    step = (
        F.when(F.col("event_type") == "purchase", 900)
        .when(F.col("event_type") == "signup", 400)
        .when(F.col("event_type") == "error", -800)
        .otherwise(0)
    )
    run = ordered.running(
        ev,
        ["user_id"],
        ["event_id"],
        ordered.row_chunk(event_id, CHUNK_ROWS),
        sums={"vtt": 1 + event_id % 400, "oi_move": step},
    )
    ms = F.floor((micros(F.col("ts")) - START_US) / 1_000_000).cast("bigint")
    return run.select(
        F.concat(F.lit("NSE_FO|"), F.col("user_id").cast("string")).alias("instrument_key"),
        event_id.alias("seq"),
        (ms + 250).alias("arrival_ms"),
        ms.alias("ltt"),
        F.col("value").alias("ltp"),
        (1 + event_id % 400).alias("ltq"),
        F.col("vtt").cast("bigint").alias("vtt"),
        (100000 + F.col("oi_move")).cast("bigint").alias("oi"),
        (F.col("value") - 0.5 + (event_id % 3).cast("double") / 4).alias("bid_p"),
        (F.col("value") + 0.25).alias("ask_p"),
    )


def noisy_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with late times, volume drops and resent ticks."""
    seq = F.col("seq")
    late = F.when(seq % 5 == 0, 20_000).when(seq % 11 == 0, 90_000).otherwise(0)
    drop = F.when(seq % 7 == 0, 700).when(seq % 13 == 0, F.col("vtt")).otherwise(0)
    return ticks(spark, sf_dir).withColumns(
        {"ltt": F.greatest(F.col("ltt") - late, F.lit(0)), "vtt": F.greatest(F.col("vtt") - drop, F.lit(0))}
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed messages; each seventh one carries another feed variant."""
    return noisy_ticks(spark, sf_dir).select("seq", "arrival_ms", F.create_map("instrument_key", _feed()).alias("feeds"))


def _feed() -> F.Column:
    first_level = F.struct(
        F.struct("ltp", "ltt", "ltq").alias("ltpc"),
        F.struct("bid_p", "ask_p").alias("first_depth"),
        "vtt",
        "oi",
    )
    return F.struct(F.when(F.col("seq") % 7 != 6, first_level).alias("first_level"))


def grouped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed messages of several instruments: the last feed of each among four ticks."""
    ticks = noisy_ticks(spark, sf_dir).withColumns({"message": F.call_function("div", F.col("seq"), F.lit(4)), "feed": _feed()})
    last = ticks.groupBy("message", "instrument_key").agg(F.max_by("feed", "seq").alias("feed"), F.max("arrival_ms").alias("arrival_ms"))
    feeds = F.map_from_entries(F.collect_list(F.struct("instrument_key", "feed"))).alias("feeds")
    return last.groupBy(F.col("message").alias("seq")).agg(F.max("arrival_ms").alias("arrival_ms"), feeds)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    key, brand = F.col("p_partkey"), F.col("p_brand")
    rows = part.withColumn("instrument_type", F.explode(F.array(F.lit("CE"), F.lit("PE"), F.lit("FUT"))))
    kind = F.col("instrument_type")
    return rows.filter(~((key % 23 == 22) & (kind == "PE"))).select(
        key.alias("seq"),
        F.when(key % 40 == 39, "NSE_EQ").otherwise("NSE_FO").alias("segment"),
        F.when(brand == "Brand#9", "RELIANCE INDUSTRIES").otherwise(brand).alias("name"),
        F.when(key % 50 == 49, 1771900000000).otherwise(1771957799000).cast("bigint").alias("expiry"),
        kind,
        F.concat(F.lit("SYM"), brand).alias("asset_symbol"),
        F.concat(F.lit("NSE_FO|"), (2 * key + F.when(kind == "CE", 0).otherwise(1)).cast("string")).alias(
            "instrument_key"
        ),
        F.when(key % 97 != 96, F.col("p_retailprice").cast("double")).alias("strike_price"),
        (25 * (1 + F.col("p_size") % 4)).cast("int").alias("lot_size"),
        F.lit(None).cast("string").alias("exchange_token"),
        F.lit(5.0).alias("tick_size"),
        F.lit(None).cast("string").alias("trading_symbol"),
        F.when(brand == "Brand#3", "NSE_INDEX|3").otherwise(F.concat(F.lit("NSE_EQ|"), brand)).alias("underlying_key"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two quotes per underlying; the later one counts. Some are missing or zero."""
    under = F.col("underlying_key")
    level = (
        master(spark, sf_dir)
        .groupBy(under)
        .agg(((F.min("strike_price") * 3 + F.max("strike_price") * 2) / 5).alias("level"))
    )
    price = F.when(under == "NSE_EQ|Brand#5", F.lit(None)).when(under == "NSE_EQ|Brand#6", 0.0).otherwise(F.col("level"))
    return level.select(
        "underlying_key",
        F.explode(
            F.array(
                F.struct((F.col("level") + 7).alias("last_price"), F.lit(1).cast("bigint").alias("quoted_ms")),
                F.struct(price.alias("last_price"), F.lit(2).cast("bigint").alias("quoted_ms")),
            )
        ).alias("q"),
    ).select("underlying_key", "q.last_price", "q.quoted_ms")


TODAY = "2024-01-30"


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert log in normal form: paise, milliseconds and the strike's parts."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    event_id = F.col("event_id")
    return ev.select(
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("timestamp"),
        F.floor(micros(F.col("ts")) / 1000).cast("bigint").alias("alert_ms"),
        event_id.alias("seq"),
        F.concat(F.lit("T"), (F.col("user_id") % 40).cast("string")).alias("ticker"),
        (900 + 10 * (F.col("user_id") % 3)).cast("double").cast("string").alias("strike"),
        F.when(F.col("event_type").isin("purchase", "signup"), "CE").otherwise("PE").alias("option_type"),
        (F.round(F.col("value") * 100).cast("bigint") * (1 + event_id % 400)).alias("paise"),
    )


def option_log(spark: SparkSession, sf_dir: str, dim: DataFrame) -> DataFrame:
    """Alert log of the feed's own instruments, so that its history meets the feed's alerts."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    rows = ev.select(
        F.concat(F.lit("NSE_FO|"), F.col("user_id").cast("string")).alias("instrument_key"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("timestamp"),
        F.floor(micros(F.col("ts")) / 1000).cast("bigint").alias("alert_ms"),
        F.col("event_id").alias("seq"),
        (F.round(F.col("value") * 100).cast("bigint") * (1 + F.col("event_id") % 400)).alias("paise"),
    )
    return registry.with_instrument(rows, dim)


def movers_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    key, name = F.col("s_suppkey"), F.col("s_name")
    full = F.concat(
        F.when(key % 4 == 0, F.concat(F.lit("SYMBrand#"), (key % 25).cast("string"))).otherwise(name),
        F.lit("  |  "),
        (F.col("s_nationkey") - 12).cast("string"),
        F.lit(".25%  |  "),
        key.cast("string"),
        F.lit(".5"),
    )
    return s.select(
        key.alias("line_no"),
        F.when(key % 10 == 0, "---- header ----")
        .when(key % 10 == 1, F.concat(name, F.lit(" | n/a | 1.0")))
        .when(key % 10 == 2, F.concat(name, F.lit(" | 3.0%")))
        .otherwise(full)
        .alias("line"),
    )
