"""Adapters from the driver's TPC-style test tables to this workload's inputs.

* ``raw_plays``          — plays as export text (lineitem-grain, some exact copies, some
  unreadable durations, times with several zones, fields that the clean step drops)
* ``metadata_payloads``  — batches of the metadata service's answers, some landed before with other values
* ``weather_payloads``   — daily arrays per country and year, some landed before with other values
* ``city_coordinates``   — the fixed country -> city table

Every adapter is a plain DataFrame plan over the given tables, so its work
grows with them. Copies are generated with ``explode`` over a 1- or 2-element
sequence rather than a second pass over the joined tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Country -> (city, latitude, longitude).
CITY_COORDS = [
    ("PK", "Karachi", 24.8607, 67.0011),
    ("DE", "Berlin", 52.5200, 13.4050),
]

# Per-country synthetic weather constants
# (base temperature, slope per month from peak, peak month, rain offset).
WEATHER_CONSTANTS = [
    ("DE", 20, 3, 7, 0),
    ("PK", 26, 2, 6, 5),
]

# Region name -> raw country text, line number % 5 -> raw platform text.
REGION_COUNTRY = {"EUROPE": "de", "ASIA": " PK", "AMERICA": "US"}
LINE_PLATFORM = {0: "Android", 1: "ios ", 2: "web_player", 3: "desktop"}
URI_PREFIX = "music:track:"
# Texts that are no whole number of milliseconds; read as 0.
UNREADABLE_MS = ["n/a", "60000d", ""]
# Answers per metadata batch.
BATCH = 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: _table(spark, sf_dir, n)
    # 25 nations x 5 regions: a fixed-size TPC table, broadcast is bounded.
    nation_country = (t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("n_nationkey", _case(F.col("r_name"), REGION_COUNTRY).alias("conn_country")))
    customers = (t("customer").select("c_custkey", "c_nationkey")
                 .join(F.broadcast(nation_country), F.col("c_nationkey") == F.col("n_nationkey"))
                 .select("c_custkey", "conn_country"))
    # the customers meet the orders, not the lines, and a line is cut to what its play
    # needs: the lines are shuffled twice, by order and by part
    orders = (t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
              .join(customers, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderdate", "conn_country"))
    parts = t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                              (F.col("l_tax") >= 0.04).alias("taxed"), (F.col("l_tax") == 0).alias("untaxed"),
                              (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_linestatus") == "O").alias("open"))
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(parts, F.col("l_partkey") == F.col("p_partkey")))

    ln, pk, sk = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    hours = ((ln * 3 + sk) % 24).cast("int")
    live = (ln == 7) & (pk % 50 == 0)
    feat = (ln == 7) & (pk % 40 == 0)
    # one instant as text: with Z, with an offset, without a zone
    clock = lambda h: (F.col("o_orderdate") + F.make_dt_interval(hours=h)).cast("string")
    ts = (F.when(ln % 3 == 0, F.concat(F.replace(clock(hours), F.lit(" "), F.lit("T")), F.lit("Z")))
           .when(ln % 3 == 1, F.concat(F.replace(clock(hours + 2), F.lit(" "), F.lit("T")), F.lit("+02:00")))
           .otherwise(clock(hours)))
    ms = ((F.col("l_quantity") - 1) * 6000 + (pk % 21) * 300).cast("long").cast("string")
    unreadable = F.element_at(F.array(*[F.lit(t) for t in UNREADABLE_MS]), (sk % len(UNREADABLE_MS) + 1).cast("int"))
    plays = j.select(
        ts.alias("ts"),
        F.when((pk % 89 == 0) & (ln == 6), unreadable).when(pk % 89 == 1, F.concat(ms, F.lit(".0"))).otherwise(ms)
         .alias("ms_played"),
        F.concat(F.lit("10.0.0."), (sk % 250).cast("string")).alias("ip_addr"),
        F.lit(None).cast("string").alias("episode_name"),
        F.unix_timestamp(F.lit("2024-01-01 00:00:00")).alias("offline_timestamp"),
        F.col("conn_country"),
        _case(ln % 5, LINE_PLATFORM).alias("platform"),
        F.when(sk % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("p_name"), F.lit(" #"), F.col("p_size").cast("string"),
                             F.when(live, " (live)").otherwise(""))).alias("master_metadata_track_name"),
        F.concat(F.col("p_brand"), F.when(feat, " feat").otherwise("")).alias("master_metadata_album_artist_name"),
        F.col("p_type").alias("master_metadata_album_album_name"),
        F.concat(F.lit(URI_PREFIX), (pk * 3 + sk % 3).cast("string")).alias("spotify_track_uri"),
        F.when(ln <= 3, "trackdone").otherwise("clickrow").alias("reason_start"),
        F.when(F.col("returned"), "fwdbtn").otherwise("trackdone").alias("reason_end"),
        # flags as texts of JSON values: true and false, 1 and 0
        F.when(F.col("open"), F.col("taxed").cast("string")).alias("shuffle"),
        F.when(ln % 2 == 0, F.col("returned").cast("string"))
         .otherwise(F.col("returned").cast("int").cast("string")).alias("skipped"),
        F.when(F.col("untaxed"), F.lit("true")).alias("offline"),
        F.lit(None).cast("string").alias("incognito_mode"),
        F.explode(F.sequence(F.lit(1), F.when(pk % 97 == 0, 2).otherwise(1))).alias("_copy"),
    )
    return plays.drop("_copy")


def _landings(repeated: Column) -> Column:
    """Days of landing: the second; the first too where ``repeated`` (a stale one)."""
    return F.explode(F.when(repeated, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))).alias("_day")


def _landing(name: str) -> list[Column]:
    return [F.to_timestamp(F.format_string("2024-01-%02d 00:00:00", "_day")).alias("landed_at"),
            F.format_string(f"{name}/%d.json", "_day").alias("landed_in"), F.lit(0).cast("long").alias("landed_row")]


def metadata_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service's answers for three ids per part, in batches of 50; an unavailable
    track is null. Every seventh batch landed the day before, with a greater
    popularity and duration of each track."""
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    answer = F.struct(
        (F.col("p_size") * 2).cast("int").alias("popularity"),
        (F.lit(120000) + F.col("p_size") * 3000).cast("long").alias("duration_ms"),
        (F.col("p_type") == "PROMO").alias("explicit"),
        F.struct(F.concat((F.lit(1950) + F.col("p_size")).cast("string"), F.lit("-01-01")).alias("release_date")).alias("album"))
    number = F.col("p_partkey") * 3 + F.col("k")
    asked = (p.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
              .select(F.floor(number / BATCH).alias("batch"), number.cast("string").alias("id"),
                      F.when(F.col("p_partkey") % 83 != 0, answer).alias("track")))
    batches = asked.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("id", "track"))).alias("answers"))
    stale = F.col("_day") == 1
    track = lambda a: F.when(stale, a["track"].withField("popularity", a["track"]["popularity"] + 100)
                             .withField("duration_ms", a["track"]["duration_ms"] + 50000)).otherwise(a["track"])
    return (batches.select("answers", _landings(F.col("batch") % 7 == 0))
                   .select(F.lit(None).cast("array<bigint>").alias("track_ids"),
                           F.col("answers.id").alias("source_ids"), F.transform("answers", track).alias("tracks"),
                           *_landing("metadata")))


def constant_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table built in the JVM (no Python data transfer)."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def city_coordinates(spark: SparkSession) -> DataFrame:
    return constant_table(spark, ["country", "city", "lat", "lon"], CITY_COORDS)


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service's daily arrays per country and year over every order date; even
    years landed the day before, with greater measures.

    Distinct order dates are bounded by the calendar, so the per-country
    expansion and an array of one year's days stay small whatever the order volume.
    """
    days = (_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
            .where(F.col("date").isNotNull()).distinct())
    consts = F.array(*[
        F.struct(F.lit(c).alias("country"), F.lit(b).alias("base"), F.lit(s).alias("slope"),
                 F.lit(pm).alias("peak"), F.lit(o).alias("offset"))
        for c, b, s, pm, o in WEATHER_CONSTANTS
    ])
    cities = _case(F.col("country"), {c: city for c, city, _, _ in CITY_COORDS})
    x = (days.select("date", F.inline(consts))
             .withColumn("n", (F.dayofyear("date") + F.year("date") * 3).cast("long"))
             .withColumn("m", F.month("date")))
    n = F.col("n")
    temp = F.when(n % 101 != 0,
                  (F.col("base") - F.col("slope") * F.abs(F.col("peak") - F.col("m"))).cast("double")
                  + (n * 7 % 100).cast("double") / 10)
    measures = {
        "time": F.date_format("date", "yyyy-MM-dd"),
        "temperature_2m_max": temp + 4, "temperature_2m_min": temp - 4, "temperature_2m_mean": temp,
        "precipitation_sum": F.when(n % 97 != 0, ((n * 13 + F.col("offset")) % 40).cast("double") / 10),
        # odd days end 18 s after the whole: half a hundredth of an hour when 9 divides the thousands
        "sunshine_duration": F.when(n % 89 != 0, ((n * 11 % 50) * 1000 + n % 2 * 18).cast("double")),
        "wind_speed_10m_max": (n % 30).cast("double"),
    }
    day = F.struct(*[v.alias(k) for k, v in measures.items()])
    spans = (x.groupBy("country", cities.alias("city"), F.year("date").alias("year"))
              .agg(F.array_sort(F.collect_list(day)).alias("days")))
    more = F.when(F.col("_day") == 1, 50.0).otherwise(0.0)
    arrays = {k: F.col(f"days.{k}") if k == "time" else F.transform(f"days.{k}", lambda v: v + more) for k in measures}
    return (spans.select("country", "city", "days", _landings(F.col("year") % 2 == 0))
                 .select("country", "city", F.struct(*[v.alias(k) for k, v in arrays.items()]).alias("daily"),
                         *_landing("weather")))
