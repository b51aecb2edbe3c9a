"""Inputs of the registered queries, derived by Spark from the driver's tables.

The tables hold orders, line items, events and texts. Each function below renames or computes columns
so that the table has the shape a plan expects; every derived table grows with its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import epoch_ms
from tidemark.plans.classification import POWER, PRICE, WEATHER
from tidemark.session import spread

SEASON = "2017-2018"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as daily records: the country is the return flag."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_returnflag").alias("country"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_quantity") - 20).alias("temperature_avg"),
        (F.col("l_quantity") - 20 - F.col("l_tax") * 100).alias("temperature_min"),
        (F.col("l_quantity") - 20 + F.col("l_discount") * 100).alias("temperature_max"),
        (F.col("l_extendedprice") / 100).alias("snow_depth"),
    )


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sparse readings: the event type tells the sensor, all other sensors are NULL."""
    events = table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value")
    even = F.col("user_id") % 2 == 0
    return events.select(
        epoch_ms("ts").alias("Time"),
        F.when(kind == "click", value * 100).alias("SolarPower"),
        F.when(kind == "error", value * 100).alias("WaterCooling01Power"),
        F.when(kind == "purchase", value * 100).alias("WaterCooling02Power"),
        F.when(kind == "signup", value * 100).alias("VentilationPower"),
        F.when((kind == "view") & even, value).alias("Temperature"),
        F.when((kind == "view") & ~even, value).alias("ElectricityPrice"),
    )


def autumn_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with their times folded into the two days around the change of the clock in 2024."""
    start, span = 1_729_900_800_000, 2 * 86_400_000  # 2024-10-26 00:00 UTC
    return sensor_readings(spark, sf_dir).withColumn("Time", F.lit(start) + F.pmod(F.col("Time"), F.lit(span)))


def retail_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.to_date("l_shipdate").alias("orderDate"),
        F.col("l_extendedprice").alias("productPrice"),
        F.col("l_quantity").cast("int").alias("productCount"),
    )


def game_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as game titles: published in the customer's nation, pending ones without regional sales."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    keyed = orders.withColumnRenamed("o_custkey", "c_custkey")
    joined = keyed.join(customers.select("c_custkey", "c_nationkey"), ["c_custkey"])
    return joined.select(
        F.concat(F.lit("Publisher"), F.col("c_nationkey")).alias("Publisher"),
        F.col("o_orderdate").alias("release_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("NA_Sales"),
        F.col("o_totalprice").alias("total_sales"),
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as incident records with text ids."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("A-"), F.col("o_orderkey")).alias("ID"),
        F.col("o_orderdate").alias("Start_Time"),
        F.concat(F.lit("Order "), F.col("o_orderpriority")).alias("Description"),
        F.concat(F.lit("City"), F.col("o_custkey") % 50).alias("City"),
        F.col("o_orderstatus").alias("State"),
        F.round(F.col("o_totalprice") / 5000, 1).alias("Temperature_F"),
    )


def tagged_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents, one in seven with the suffix _Z1 and one in eleven with _Z2."""
    number = F.regexp_extract("ID", r"([0-9]+)$", 1).cast("long")
    suffix = F.when(number % 7 == 1, "_Z1").when(number % 11 == 2, "_Z2").otherwise("")
    return incidents(spark, sf_dir).withColumn("ID", F.concat(F.col("ID"), suffix))


def text_lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _match_columns(key: Column) -> dict[str, Column]:
    league, home = key % 5, F.expr("(l_orderkey div 5) % 10")
    away = F.expr("((l_orderkey div 5) % 10 + 1 + (l_orderkey div 50) % 9) % 10")
    return {
        "matchId": key,
        "competition": F.concat(F.lit("League"), league),
        "season": F.when(key % 3 == 0, "2016-2017").otherwise(SEASON),
        "homeTeam": F.concat(F.lit("T"), league, F.lit("-"), home),
        "awayTeam": F.concat(F.lit("T"), league, F.lit("-"), away),
        "homeNumber": league * 10 + home,
        "awayNumber": league * 10 + away,
    }


def football_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as match events; the order is the match."""
    items = table(spark, sf_dir, "lineitem")
    columns = _match_columns(F.col("l_orderkey"))
    flag, tagged = F.col("l_returnflag"), F.col("l_discount") >= 0.05
    named = items.withColumns({name: columns[name] for name in ("homeTeam", "awayTeam")})
    return named.select(
        columns["competition"].alias("competition"),
        columns["season"].alias("season"),
        F.col("l_orderkey").alias("matchId"),
        "homeTeam",
        "awayTeam",
        F.when(F.col("l_linenumber") % 2 == 1, F.col("homeTeam")).otherwise(F.col("awayTeam")).alias("eventTeam"),
        F.when(flag == "R", "Save attempt").when(flag == "A", "Pass").otherwise("Foul").alias("event"),
        F.when(F.col("l_linestatus") == "F", "1H").otherwise("2H").alias("eventPeriod"),
        (F.col("l_quantity") * 58 + F.col("l_linenumber")).alias("eventTime"),
        F.when(
            tagged, F.array(F.when(flag == "R", "Goal").when(flag == "A", "Accurate").otherwise("Foul"))
        ).otherwise(F.array().cast("array<string>")).alias("tags"),
    )


def football_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with line-ups, benches and up to three substitutions for both teams."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    key = F.col("l_orderkey")
    columns = _match_columns(key)

    def team_data(name: Column, number: Column) -> Column:
        base = number * 100

        def change(i: int) -> Column:
            made = F.struct(
                (base + 11 + i).cast("int").alias("playerIn"),
                (base + 1 + (key + 3 * i) % 11).cast("int").alias("playerOut"),
                (40 + (7 * key + 13 * i) % 50).cast("int").alias("minute"),
            )
            return F.when((key + i) % 4 != 0, made).alias(f"substitution{i}")

        def listed(first: int, last: int) -> Column:
            return F.sequence((base + first).cast("int"), (base + last).cast("int"))

        return F.struct(
            name.alias("team"),
            listed(1, 11).alias("lineup"),
            listed(12, 14).alias("bench"),
            *[change(i) for i in (1, 2, 3)],
        )

    return keys.select(
        *[columns[name].alias(name) for name in ("matchId", "competition", "season")],
        team_data(columns["homeTeam"], columns["homeNumber"]).alias("homeTeamData"),
        team_data(columns["awayTeam"], columns["awayNumber"]).alias("awayTeamData"),
    )


def football_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen players for each team that occurs in the matches."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey")
    columns = _match_columns(F.col("l_orderkey"))
    teams = keys.select(F.explode(F.array(columns["homeNumber"], columns["awayNumber"])).alias("team")).distinct()
    players = teams.select("team", F.explode(F.sequence(F.lit(1), F.lit(14))).alias("n"))
    ident, n = F.col("team") * 100 + F.col("n"), F.col("n")
    role = F.when(n == 1, "Goalkeeper").when(n <= 5, "Defender").when(n <= 9, "Midfielder").otherwise("Forward")
    return players.select(
        ident.cast("int").alias("playerId"),
        F.concat(F.lit("F"), ident).alias("firstName"),
        F.concat(F.lit("L"), ident).alias("lastName"),
        F.concat(F.lit("Area"), ident % 7).alias("birthArea"),
        role.alias("role"),
    )


def hex_pixels_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pixel per line item; the supplier is the image."""
    items = table(spark, sf_dir, "lineitem")
    pixel = F.upper(F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 8))
    return items.select(F.col("l_suppkey").alias("image"), pixel.alias("pixel"))


def page_images(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Pages in the shape of an image scan, four bytes to a pixel.

    Plain letters are below the alpha limit and would all be transparent, so the bits of each half
    byte are reversed. The pixels are the bytes of the whole page. ``partitions`` are those of ``spread``.
    """
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id", partitions=partitions)
    hexadecimal = F.translate(F.hex(F.encode("html", "UTF-8")), "0123456789ABCDEF", "084C2A6E195D3B7F")
    code = F.upper(F.hex(F.col("page_id")))
    return pages.select(
        "page_id",
        F.struct(
            F.concat(F.lit("file:/images/"), code, F.lit(".png")).alias("origin"),
            F.lit(4).alias("nChannels"),
            F.unhex(hexadecimal).alias("data"),
        ).alias("image"),
    )


def image_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the page images."""
    pages = table(spark, sf_dir, "pages")
    group = F.when(F.col("page_id") % 3 == 0, "activities-sport").otherwise("symbols")
    return pages.select(
        F.upper(F.hex(F.col("page_id"))).alias("hexcode"),
        F.concat(F.lit("page "), F.col("page_id")).alias("annotation"),
        group.alias("group"),
    )


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity against price of the line items."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("X"), F.col("l_extendedprice").alias("label")
    )


def minute_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measurements with gaps; weather follows the month, power the hour."""
    items = table(spark, sf_dir, "lineitem")
    month = F.month("l_shipdate")
    second = (F.col("l_orderkey") * 61 + F.col("l_linenumber") * 997) % 86400
    hour = F.floor(second / 3600)
    summer, noon = 6 - F.abs(month - 7), 12 - F.abs(hour - 12)
    gap = F.col("l_linenumber") == 7
    values = {
        "temperature": F.when(~(gap & (F.col("l_returnflag") == "R")), summer * 5 + F.col("l_tax") * 50),
        "humidity": 90 - summer * 4 + F.col("l_discount") * 100,
        "wind_speed": F.col("l_quantity") / 10 + F.when(month > 6, 3).otherwise(0),
        "power_tenants": F.when(~(gap & (F.col("l_returnflag") == "A")), noon * 100 + F.col("l_quantity")),
        "power_maintenance": F.when(hour > 12, 50).otherwise(20) + F.col("l_tax") * 100,
        "power_solar_panels": noon * summer * 10 + F.col("l_discount") * 10,
        "electricity_price": F.when(~(gap & (F.col("l_returnflag") == "N")), F.col("l_extendedprice") / 1000),
    }
    time = F.unix_date(F.to_date("l_shipdate")).cast("long") * 86400 + second
    columns = [values[name].cast("double").alias(name) for name in (*WEATHER, *POWER, *PRICE)]
    return items.select("l_orderkey", "l_linenumber", time.alias("time"), *columns)


def customer_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed balances for every tenth customer, and as many new customers with other keys."""
    customers = table(spark, sf_dir, "customer")
    chosen = customers.where(F.col("c_custkey") % 10 == 3)
    known = chosen.withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100, 2))
    unknown = chosen.withColumns(
        {"c_custkey": -F.col("c_custkey"), "c_name": F.concat(F.lit("New "), F.col("c_name"))}
    )
    return known.unionByName(unknown)
