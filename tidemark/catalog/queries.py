"""The registered queries: each runs an operator or plan over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.catalog import inputs
from tidemark.catalog.inputs import SEASON, table
from tidemark.functions.colors import color_histogram, color_name, color_names, hex_number, hex_pixels, tiff_file, without_none
from tidemark.functions import keyed_random
from tidemark.functions.columns import celsius, epoch_ms, local_hour, newton_root, signed_text, sum_of, utc_time
from tidemark.operators import aggregates, bayes, intervals, ml, ranking, reshape, tables, widening
from tidemark.operators.joins import keyed_join
from tidemark.plans import classification, corpus, energy, football, images, regression, sales, storage, weather
from tidemark.session import shared_path, stored
from tidemark.sources import rewrites
from tidemark.sources.inventory import file_inventory, file_name, rows_per_file
from tidemark.sources.readers import frame_of, read_csv, read_images, read_parquet, stream_csv, view_of
from tidemark.sources.writers import write_binary_files, write_csv, write_format, write_parquet
from tidemark.streaming import control
from tidemark.streaming import sales as stream_sales

LINE_KEY = ["l_orderkey", "l_linenumber"]
STORED_TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
#: Tasks that write, list and read image files, whatever the cluster.
IMAGE_TASKS = 64
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


# Aggregations and rankings


@query
def year_minmax(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return weather.yearly_extremes(orders, "o_orderdate", "o_totalprice", "o_totalprice", ("price_min", "price_max"))


@query
def year_status_stats(spark: SparkSession, sf: str) -> DataFrame:
    names = ("price_min", "price_max", "price_avg")
    price = "o_totalprice"
    return weather.yearly_statistics(
        table(spark, sf, "orders"), "o_orderdate", "o_orderstatus", price, price, price, names
    )


@query
def point_look_ups(spark: SparkSession, sf: str) -> DataFrame:
    days = inputs.weather_days(spark, sf)
    statistics = weather.yearly_statistics(
        days, "date", "country", "temperature_min", "temperature_max", "snow_depth"
    )
    return weather.statistics_look_ups(statistics, "country", (1996, "A"), (1997, "N"), (1998, "R"), 1995)


@query
def cond_count_zero_groups(spark: SparkSession, sf: str) -> DataFrame:
    days = inputs.weather_days(spark, sf)
    return weather.cold_days(days, "date", "country", "A", "temperature_avg", -18.5)


@query
def warm_snow_days(spark: SparkSession, sf: str) -> DataFrame:
    return weather.warm_snow_days(inputs.weather_days(spark, sf), "country", "temperature_avg", "snow_depth", 5, 100)


@query
def widest_days(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("date"),
        (F.col("o_totalprice") / 1000).alias("low"),
        (F.col("o_totalprice") / 1000 + F.col("o_orderkey") % 97).alias("high"),
    )
    return weather.widest_days(orders, "date", "low", "high")


@query
def top_range_days(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    days = aggregates.extremes(items, ["day"], "l_extendedprice", "l_extendedprice", ("low", "high"))
    return weather.widest_days(days, "day", "low", "high", name="price_range")


@query
def global_minmax(spark: SparkSession, sf: str) -> DataFrame:
    price = "l_extendedprice"
    return aggregates.extremes(table(spark, sf, "lineitem"), [], price, price, ("price_min", "price_max"))


@query
def global_average(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(
        F.round(F.avg("l_quantity"), 3).alias("quantity_avg"), F.max("l_quantity").alias("quantity_max")
    )


@query
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.row_count(table(spark, sf, "lineitem"))


@query
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_count(table(spark, sf, "orders"), "o_custkey", "customers")


@query
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.first_rows(table(spark, sf, "orders"), "o_orderkey", 7)


@query
def last_rows(spark: SparkSession, sf: str) -> DataFrame:
    chosen = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ranking.last_rows(chosen, "o_orderkey", 6)


@query
def ordered_index(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.ordered_index(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], name="place")


@query
def ordered_index_by_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ranking.ordered_index(orders, order, ["o_orderstatus"], name="place")


@query
def top_per_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ranking.top_k_per_group(orders, ["o_orderpriority"], order, 3, ties=False, position="place")


@query
def ranks_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Rank and dense rank of every line item by its quantity: three groups, fifty ties in each."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return ranking.with_ranks(items, ["l_returnflag"], {"l_quantity": False}, dense="dense")


@query
def ranks_of_many_values(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks in groups of many values, by two columns in opposite directions."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return ranking.with_ranks(orders, ["o_orderstatus"], {"o_orderdate": True, "o_totalprice": False}).drop("o_totalprice")


@query
def top_days_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Line items shipped on a flag's last days, down to the hundredth row and all that tie with it."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.to_date("l_shipdate").alias("day"))
    return ranking.with_ranks(items, ["l_returnflag"], {"day": False}, k=100)


@query
def commonest_words_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """The three commonest words of each length and those as common as the third."""
    counts = corpus.word_counts(_words(spark, sf))
    return ranking.with_ranks(stored(counts.withColumn("length", F.length("word")), "word-counts"), ["length"], {"count": False}, k=3)


@query
def lowest_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey", F.floor(F.col("s_acctbal") / 2000).alias("band")
    )
    return ranking.lowest_per_group(suppliers, ["s_nationkey"], "band")


@query
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.sample_by_suffix(inputs.tagged_incidents(spark, sf), "ID", ["Z1", "Z2"], 3)


@query
def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    counts = aggregates.group_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "orders")
    return aggregates.share_of_total(counts, ["o_orderstatus"], "orders")


@query
def poly_sum_max(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").withColumn("number", F.col("l_linenumber").cast("long"))
    return aggregates.polynomial_reduce(
        items, ["l_returnflag"], "number", {"sum_of_cubes": (0, 0, 0, 1)}, {"quadratic_max": (1, 9, -1)}
    )


@query
def fifth_root(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    return parts.select("p_partkey", F.round(newton_root("p_retailprice"), 6).alias("root"))


@query
def int_add(spark: SparkSession, sf: str) -> DataFrame:
    size, number = F.col("p_size"), F.col("p_partkey")
    return table(spark, sf, "part").select(
        "p_partkey", sum_of(size, number).alias("two"), sum_of(size, number, F.lit(7)).alias("three")
    )


@query
def hex_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Keys as hexadecimal text and back."""
    parts = table(spark, sf, "part").select("p_partkey", F.hex("p_partkey").alias("digits"))
    return parts.withColumn("number", hex_number("digits"))


@query
def named_priorities(spark: SparkSession, sf: str) -> DataFrame:
    """Orders counted under names that come from in-memory rows."""
    names = frame_of(spark, [("1-URGENT", "now"), ("2-HIGH", "soon"), ("3-MEDIUM", "later")], "priority string, name string")
    counts = aggregates.group_counts(table(spark, sf, "orders"), ["o_orderpriority"], "orders")
    return keyed_join(counts, names, {"o_orderpriority": "priority"}).select("o_orderpriority", "name", "orders")


@query
def composite_key_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    keys = ["o_custkey", "o_orderstatus"]
    all_orders = aggregates.group_counts(orders, keys, "orders")
    urgent = aggregates.group_counts(orders.where(F.col("o_orderpriority").startswith("1")), keys, "urgent")
    return keyed_join(all_orders, urgent, {key: key for key in keys}).select(*keys, "orders", "urgent")


# Time series


@query
def hourly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    hourly = energy.hourly_averages(inputs.sensor_readings(spark, sf))
    values = ["AvgTemperature", "ProducedEnergy", "ConsumedEnergy", "Price"]
    return hourly.select("Time", *[F.round(name, 6).alias(name) for name in values])


@query
def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return energy.daily_totals(energy.hourly_averages(inputs.sensor_readings(spark, sf)))


@query
def weekly_cost(spark: SparkSession, sf: str) -> DataFrame:
    daily = energy.daily_totals(energy.hourly_averages(inputs.sensor_readings(spark, sf), zone="+03:00"))
    return energy.total_cost(daily)


@query
def repeated_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly rows around the last Sunday of October, when the local hour from three to four comes twice."""
    readings = inputs.autumn_readings(spark, sf)
    hourly = energy.hourly_averages(readings)
    return hourly.select("Time", F.round("ProducedEnergy", 6).alias("ProducedEnergy"), F.round("AvgTemperature", 6).alias("AvgTemperature"))


@query
def local_hours(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", local_hour(epoch_ms("ts"), "Europe/Helsinki").alias("hour"))


@query
def epoch_month_hour(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.expr("epoch_ms div 1000") * 1000
    events = table(spark, sf, "events").select(epoch_ms("ts").alias("epoch_ms"))
    moment = utc_time(seconds)
    return aggregates.group_counts(
        events.select(F.month(moment).alias("month"), F.hour(moment).alias("hour")), ["month", "hour"]
    )


def _sessions(spark: SparkSession, sf: str, kind: str, name: str) -> DataFrame:
    """Events of a kind as intervals of a millisecond to some ten days."""
    events = table(spark, sf, "events").where(F.col("event_type") == kind)
    length = F.pow(F.col("event_id") % 97, 3).cast("long") * 1000 + 1
    begin = epoch_ms("ts")
    return events.select("user_id", F.col("event_id").alias(name), begin.alias(f"{name}_start"), (begin + length).alias(f"{name}_end"))


@query
def events_in_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks within each signed-up user's sessions, which run over days and into each other."""
    sessions = _sessions(spark, sf, "signup", "session")
    clicks = table(spark, sf, "events").where("event_type = 'click'").select("user_id", "event_id", epoch_ms("ts").alias("time"))
    pairs = intervals.contained(clicks, sessions, "time", "session_start", "session_end", ["user_id"])
    return pairs.groupBy("user_id", "session").agg(F.count("*").alias("clicks"), F.min("event_id").alias("least"), F.sum("event_id").alias("ids"))


@query
def events_near_errors(spark: SparkSession, sf: str) -> DataFrame:
    """All events up to half a minute before an error, of any user: a join by time alone."""
    events = table(spark, sf, "events").select("event_id", "event_type", epoch_ms("ts").alias("time"))
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error"), (F.col("time") - 30_000).alias("from"), F.col("time").alias("to")
    )
    pairs = intervals.contained(events, errors, "time", "from", "to")
    return pairs.groupBy("error").agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))


@query
def overlapping_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of sessions of one user that overlap, and for how long in all."""
    one, two = _sessions(spark, sf, "signup", "session"), _sessions(spark, sf, "purchase", "other")
    pairs = intervals.overlapping(one, two, ("session_start", "session_end"), ("other_start", "other_end"), ["user_id"])
    shared = F.least("session_end", "other_end") - F.greatest("session_start", "other_start")
    return pairs.groupBy("user_id").agg(F.count("*").alias("pairs"), F.sum(shared).alias("milliseconds"))


# Sales


@query
def best_days(spark: SparkSession, sf: str) -> DataFrame:
    daily = sales.daily_sales(inputs.retail_sales(spark, sf))
    return sales.best_days(daily).select("orderDate", F.round("totalSales", 2).alias("totalSales"), "totalCount")


def _sales_stream(spark: SparkSession, sf: str, files: int = 12, files_per_batch: int = 4) -> tuple[DataFrame, str]:
    """The sales as header-less CSV files in the shared folder, read as a stream of three batches.

    The number of files is given, not derived: batches and merges of state are the same at every size.
    """
    source = inputs.retail_sales(spark, sf)
    folder = shared_path(spark, "sales-stream")
    dealt = source.repartition(files, *source.columns)
    write_csv(dealt, f"{folder}/in", sep=";", header=False)
    return stream_csv(spark, f"{folder}/in", source.schema, files_per_batch=files_per_batch), folder


@query
def daily_sales_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream, folder = _sales_stream(spark, sf)
    result = stream_sales.daily_sales_table(stream, f"{folder}/out", f"{folder}/state")
    return result.select("orderDate", F.round("totalSales", 2).alias("totalSales"), "totalCount")


@query
def best_days_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream, folder = _sales_stream(spark, sf)
    result = stream_sales.best_days_table(stream, f"{folder}/out", f"{folder}/state")
    return result.select("orderDate", F.round("totalSales", 2).alias("totalSales"), "totalCount")


@query
def sorted_days_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The sorted result of the stream, each day with its place as the last batch saw it."""
    stream, folder = _sales_stream(spark, sf)
    ordered = stream_sales.sorted_daily_sales(stream)
    place = F.row_number().over(Window.orderBy(F.round("totalSales", 2).desc(), "orderDate"))
    placed = lambda batch: batch.withColumn("place", place)  # noqa: E731  one row per day
    stream_sales.start_table_query(ordered, f"{folder}/out", f"{folder}/state", placed, once=True).awaitTermination()
    result = stream_sales.latest_version(spark, f"{folder}/out")
    return result.select("orderDate", F.round("totalSales", 2).alias("totalSales"), "place")


@query
def resumed_days_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A stream stopped after the first of its batches, given more files, and started again.

    The interval is longer than any batch, so exactly one batch has ended when the query stops.
    """
    source, folder = inputs.retail_sales(spark, sf), shared_path(spark, "sales-resumed")
    late = F.pmod(F.hash(*source.columns), F.lit(3)) == 0
    dealt = source.repartition(9, *source.columns)
    write_csv(dealt.where(~late), f"{folder}/in", sep=";", header=False)

    def start(**trigger: object) -> StreamingQuery:
        stream = stream_csv(spark, f"{folder}/in", source.schema, files_per_batch=4)
        return stream_sales.start_table_query(sales.daily_sales(stream), f"{folder}/out", f"{folder}/state", **trigger)

    control.run_batches(start(interval="12 hours"), batches=1, seconds=6 * 3600)
    write_csv(dealt.where(late), f"{folder}/in", sep=";", header=False, mode="append")
    control.run_to_end(lambda: start(once=True), seconds=12 * 3600)
    result = stream_sales.latest_version(spark, f"{folder}/out")
    return result.select("orderDate", F.round("totalSales", 2).alias("totalSales"), "totalCount")


def _best_publisher(spark: SparkSession, sf: str) -> DataFrame:
    games = inputs.game_sales(spark, sf)
    publishers = sales.publisher_sales(games, "Publisher", "release_date", "NA_Sales", "total_sales", 1996, 1999)
    return sales.best_publisher(publishers)


@query
def best_publisher(spark: SparkSession, sf: str) -> DataFrame:
    best = _best_publisher(spark, sf)
    return best.select("publisher", F.round("regional_total", 2).alias("regional_total"))


@query
def missing_titles(spark: SparkSession, sf: str) -> DataFrame:
    return _best_publisher(spark, sf).select(F.col("missing_titles").alias("titles"))


@query
def top_group_then_filter(spark: SparkSession, sf: str) -> DataFrame:
    return sales.sales_by_year(_best_publisher(spark, sf))


# Text


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.words_of(inputs.text_lines_source(spark, sf), "text")


@query
def line_total(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.line_total(corpus.lines_of(inputs.text_lines_source(spark, sf), "text"))


@query
def line_starts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.line_starts(corpus.lines_of(inputs.text_lines_source(spark, sf), "text"))


@query
def word_total(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.word_total(_words(spark, sf))


@query
def word_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.word_distinct(_words(spark, sf))


@query
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.rarest_first(corpus.word_counts(_words(spark, sf)))


@query
def word_counts_typed(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.typed_word_counts(corpus.word_counts(_words(spark, sf)))


@query
def top_word_len7_s(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.most_common_word(_words(spark, sf), 7, "s")


@query
def text_line_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "text")
    lines = storage.text_round_trip(spark, path, inputs.text_lines_source(spark, sf), "text")
    return lines.agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("characters"))


# Football


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    lengths = football.match_lengths(inputs.football_events(spark, sf), SEASON)
    return football.player_intervals(inputs.football_matches(spark, sf), lengths, SEASON)


def _standings(spark: SparkSession, sf: str) -> DataFrame:
    return football.season_standings(football.match_results(inputs.football_events(spark, sf)))


@query
def match_results(spark: SparkSession, sf: str) -> DataFrame:
    return football.match_results(inputs.football_events(spark, sf))


@query
def season_standings(spark: SparkSession, sf: str) -> DataFrame:
    return _standings(spark, sf)


@query
def league_tables(spark: SparkSession, sf: str) -> DataFrame:
    return football.league_tables(_standings(spark, sf))


@query
def league_table(spark: SparkSession, sf: str) -> DataFrame:
    return football.league_table(_standings(spark, sf), "League2", SEASON)


@query
def signed_diff(spark: SparkSession, sf: str) -> DataFrame:
    difference = F.col("goalsScored") - F.col("goalsConceded")
    return _standings(spark, sf).select("season", "team", signed_text(difference).alias("difference"))


@query
def team_passes(spark: SparkSession, sf: str) -> DataFrame:
    return football.team_passes(inputs.football_events(spark, sf))


@query
def worst_passers(spark: SparkSession, sf: str) -> DataFrame:
    return football.worst_passers(football.team_passes(inputs.football_events(spark, sf)), SEASON)


@query
def best_two(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.football_events(spark, sf)
    standings = football.season_standings(football.match_results(events))
    return football.best_teams(standings, football.team_passes(events), SEASON)


@query
def match_length(spark: SparkSession, sf: str) -> DataFrame:
    return football.match_lengths(inputs.football_events(spark, sf), SEASON)


@query
def player_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return _intervals(spark, sf).drop("matchLength")


@query
def player_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return football.player_minutes(_intervals(spark, sf))


@query
def most_minutes_per_role(spark: SparkSession, sf: str) -> DataFrame:
    return football.most_minutes_per_role(_intervals(spark, sf), inputs.football_players(spark, sf))


@query
def plus_minus(spark: SparkSession, sf: str) -> DataFrame:
    return football.plus_minus(_intervals(spark, sf), inputs.football_events(spark, sf), SEASON)


@query
def plus_minus_top(spark: SparkSession, sf: str) -> DataFrame:
    totals = football.plus_minus(_intervals(spark, sf), inputs.football_events(spark, sf), SEASON)
    return football.plus_minus_above(totals, inputs.football_players(spark, sf), 20)


# Pixels and images


@query
def pixel_color_name(spark: SparkSession, sf: str) -> DataFrame:
    pixels = inputs.hex_pixels_by_supplier(spark, sf)
    return aggregates.group_counts(pixels.select("pixel", color_name("pixel").alias("color")), ["pixel", "color"])


def _supplier_histograms(spark: SparkSession, sf: str) -> DataFrame:
    return images.pixel_histograms(inputs.hex_pixels_by_supplier(spark, sf), ["image"], "pixel")


@query
def color_shares(spark: SparkSession, sf: str) -> DataFrame:
    return images.color_shares(_supplier_histograms(spark, sf), ["image"])


@query
def top_three_colors(spark: SparkSession, sf: str) -> DataFrame:
    return images.leading_colors(_supplier_histograms(spark, sf), ["image"])


@query
def leading_color_images(spark: SparkSession, sf: str) -> DataFrame:
    return images.count_with_leading(_supplier_histograms(spark, sf), ["Green", "Blue", "Purple"])


@query
def red_count_top(spark: SparkSession, sf: str) -> DataFrame:
    return images.most_of_color(_supplier_histograms(spark, sf), "image", "Red")


def _page_histograms(spark: SparkSession, sf: str) -> DataFrame:
    histograms = images.image_histograms(inputs.page_images(spark, sf))
    return images.with_metadata(histograms, inputs.image_metadata(spark, sf))


@query
def image_histogram(spark: SparkSession, sf: str) -> DataFrame:
    histograms = images.image_histograms(inputs.page_images(spark, sf))
    return histograms.select(
        "hexcode",
        "total_pixels",
        images.colored_pixels().alias("colored"),
        *[images.color_pixels(name).alias(name.lower()) for name in ("Red", "Blue", "Gray")],
    )


@query
def image_pixels_by_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts through the column form: binary to pixels to colours."""
    image = inputs.page_images(spark, sf).select(
        "page_id", hex_pixels("image.data", "image.nChannels").alias("pixels")
    )
    colors = image.withColumn("colors", without_none(color_names("pixels")))
    return colors.select("page_id", F.size("pixels").alias("total"), F.size("colors").alias("colored"))


@query
def image_most_colored(spark: SparkSession, sf: str) -> DataFrame:
    return images.most_colored(_page_histograms(spark, sf), "annotation")


@query
def image_least_colored(spark: SparkSession, sf: str) -> DataFrame:
    least = images.least_colored(_page_histograms(spark, sf), "annotation")
    return least.select("annotation", F.round("ratio", 6).alias("ratio"))


@query
def image_leading_shares(spark: SparkSession, sf: str) -> DataFrame:
    return images.leading_shares(_page_histograms(spark, sf), ["hexcode"])


@query
def image_most_red_in_group(spark: SparkSession, sf: str) -> DataFrame:
    chosen = images.in_group(_page_histograms(spark, sf), "activities")
    return images.most_of_color(chosen, "annotation", "Red")


@query
def image_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The page images as image files, and a tenth of them once more cut off, scanned and counted."""
    path = shared_path(spark, "images")
    pages = inputs.page_images(spark, sf, IMAGE_TASKS)
    code, content = F.upper(F.hex("page_id")).alias("code"), tiff_file("image.data")
    broken = pages.where("page_id % 10 = 0").select(code, F.substring(content, 1, 100).alias("content"))
    write_binary_files(pages.select(code, content.alias("content")).unionByName(broken), "content", path, "code")
    scanned = color_histogram(read_images(spark, path, IMAGE_TASKS).select("image"), "image.data", "image.nChannels", ["image"])
    return scanned.select(
        F.regexp_extract("image.origin", "code=([0-9A-F]+)/", 1).alias("hexcode"),
        "total_pixels",
        images.colored_pixels().alias("colored"),
        *[images.color_pixels(name).alias(name.lower()) for name in ("Red", "Blue", "Gray")],
    )


# Storage and table changes


@query
def rekey_latest(spark: SparkSession, sf: str) -> DataFrame:
    return sales.latest_rows(inputs.incidents(spark, sf), "City", "City7", "Start_Time", "ID", 73, "_Z1")


def _drifted(spark: SparkSession, sf: str) -> DataFrame:
    rows = REGISTRY["rekey_latest"](spark, sf)
    drifted = sales.drifted_rows(
        rows,
        changed={"ID": F.concat(F.regexp_replace("ID", "_Z1$", ""), F.lit("_Z2")), "Temperature_F": celsius("Temperature_F")},
        added={"AddedColumn1": F.concat(F.lit("prefix-"), "City"), "AddedColumn2": F.lit("New column")},
        renamed={"Temperature_F": "Temperature_C"},
        dropped=["Description"],
    )
    return drifted.withColumn("Temperature_C", F.round("Temperature_C", 4))


@query
def modified_schema(spark: SparkSession, sf: str) -> DataFrame:
    return _drifted(spark, sf)


@query
def evolve_append(spark: SparkSession, sf: str) -> DataFrame:
    return tables.evolve_append(inputs.incidents(spark, sf), _drifted(spark, sf))


@query
def widening_append(spark: SparkSession, sf: str) -> DataFrame:
    """Three generations of a table: keys grow from int to long, amounts from long to decimal, states gain a field."""
    orders = table(spark, sf, "orders")
    key, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")
    status, priority = F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    first = orders.select(key.cast("int").alias("id"), (cents / 100).cast("int").cast("long").alias("amount"), F.struct(status).alias("state"))
    second = orders.select((key + (1 << 40)).alias("ID"), cents.cast("int").alias("amount"), F.struct(priority, status).alias("state"))
    third = orders.select(
        (key % 1000).cast("short").alias("id"),
        (cents.cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("amount"),
        F.when(key % 2 == 0, F.struct(status)).alias("state"),
        F.to_date("o_orderdate").alias("day"),
    )
    grown = widening.widening_append(widening.widening_append(first, second), third)
    return grown.select("id", F.col("amount").cast("string").alias("amount"), "state.status", "state.priority", "day")


@query
def parquet_merge_schema(spark: SparkSession, sf: str) -> DataFrame:
    frames = [inputs.incidents(spark, sf), REGISTRY["rekey_latest"](spark, sf), _drifted(spark, sf)]
    merged = storage.parquet_with_drift(spark, shared_path(spark, "parquet-drift"), frames)
    return merged.select("ID", "Start_Time", "Description", "Temperature_F", "Temperature_C", "AddedColumn1")


@query
def csv_drift(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "csv-drift")
    return storage.csv_with_drift(spark, path, inputs.incidents(spark, sf), _drifted(spark, sf))


@query
def csv_safe_append(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    open_orders = orders.where(F.col("o_orderstatus") == "O")
    others = orders.where(F.col("o_orderstatus") != "O").select("o_totalprice", "o_orderstatus", "o_orderkey")
    return storage.csv_append(spark, shared_path(spark, "csv-append"), open_orders, others)


@query
def csv_text_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with breaks, quotes, backslashes, edge spaces and codes, empty texts, NULLs and microseconds."""
    number = F.col("doc_id")
    text = F.when(number % 7 == 0, None).when(number % 7 == 1, "").otherwise(F.concat(F.lit('  "q" \\ %0A|'), "text", F.lit("\r\n ")))
    moment = F.lit("2024-03-01").cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND") * (number * 1_000_003)
    rows = table(spark, sf, "documents").select("doc_id", text.alias("text"), moment.alias("moment"))
    again = storage.csv_round_trip(spark, shared_path(spark, "csv-texts"), rows)
    return again.select("doc_id", F.md5(F.encode("text", "utf-8")).alias("digest"), F.length("text").cast("long").alias("characters"), "moment")


@query
def csv_inferred_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "csv-inferred")
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, sep=";")
    return read_csv(spark, path, sep=";", infer=True).select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal"
    )


@query
def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "parquet")
    write_parquet(table(spark, sf, "customer"), path)
    return read_parquet(spark, path)


@query
def json_lines_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "json")
    objects = storage.json_lines_round_trip(spark, path, table(spark, sf, "events"), "props")
    return objects.groupBy("k").agg(F.count("*").alias("count"))


@query
def sql_view_scan(spark: SparkSession, sf: str) -> DataFrame:
    return view_of(table(spark, sf, "nation"), "tidemark_nations")


@query
def storage_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each table file, read, and whether the inventory has the file with bytes in it."""
    files = file_inventory(spark, sf).select(file_name("path").alias("file"), "bytes")
    counts = [
        rows_per_file(table(spark, sf, name)).select(F.lit(name).alias("table"), "file", "rows") for name in STORED_TABLES
    ]
    found = keyed_join(reshape.union_all(counts), files, {"file": "file"})
    return found.groupBy("table").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("files"), (F.min("bytes") > 0).alias("sized")
    )


@query
def format_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The same incidents as CSV and as Parquet: rows read back per file, and whether Parquet is smaller."""
    rows, sizes = inputs.incidents(spark, sf), []
    for fmt, options in (("csv", {"header": True, "sep": "|"}), ("parquet", {})):
        path = shared_path(spark, f"sizes-{fmt}")
        write_format(rows, path, fmt, **options)
        again = read_csv(spark, path, rows.schema, "|") if fmt == "csv" else read_parquet(spark, path)
        files = file_inventory(spark, path).select(file_name("path").alias("file"), "bytes")
        counted = keyed_join(rows_per_file(again), files, {"file": "file"})
        sizes.append(counted.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).withColumn("format", F.lit(fmt)))
    both = reshape.union_all(sizes)
    least = F.min("bytes").over(Window.partitionBy(F.lit(0)))
    return both.select("format", "rows", (F.col("bytes") == least).alias("smaller"))


@query
def parquet_first_schema(spark: SparkSession, sf: str) -> DataFrame:
    """A folder with two schemas read under the one that is asked for: columns of the other are left out."""
    path = shared_path(spark, "parquet-plain")
    rows = inputs.incidents(spark, sf)
    write_parquet(rows, path)
    write_parquet(_drifted(spark, sf), path, mode="append")
    return spark.read.schema(rows.schema).parquet(path).select("ID", "Start_Time", "Description", "Temperature_F")


@query
def bag_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    parts = [orders.where(F.col("o_orderstatus") == status) for status in ("F", "O", "F")]
    return reshape.union_all(parts)


@query
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    customers, changes = table(spark, sf, "customer"), inputs.customer_update(spark, sf)
    columns = ["c_name", "c_acctbal", "c_nationkey"]
    return tables.merge_upsert(customers, changes, ["c_custkey"], columns, columns)


@query
def update_where(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return tables.update_where(
        table(spark, sf, "customer"),
        {"c_acctbal": F.round((balance - 32) * 5 / 9, 3), "c_mktsegment": F.concat("c_mktsegment", F.lit("*"))},
        balance > 0,
    )


def _customer_files(spark: SparkSession, sf: str) -> str:
    """The customers as files by ranges of their key, so that a change of some keys leaves files alone."""
    path = shared_path(spark, "customer-files")
    write_parquet(table(spark, sf, "customer").repartitionByRange(8, "c_custkey"), path)
    return path


@query
def upsert_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _customer_files(spark, sf)
    changes = inputs.customer_update(spark, sf).where("c_custkey % 1000 < 250")
    columns = ["c_name", "c_acctbal", "c_nationkey"]
    rewrites.upsert_files(spark, path, changes, ["c_custkey"], columns, columns)
    return read_parquet(spark, path)


@query
def update_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _customer_files(spark, sf)
    change = {"c_acctbal": F.round(F.col("c_acctbal") / 2, 3), "c_mktsegment": F.concat("c_mktsegment", F.lit("*"))}
    rewrites.update_files(spark, path, change, F.col("c_custkey").between(40, 90) & (F.col("c_acctbal") > 0))
    return read_parquet(spark, path)


@query
def delete_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "order-files")
    orders = table(spark, sf, "orders")
    orders.repartitionByRange(4, "o_orderkey").write.partitionBy("o_orderpriority").parquet(path)
    rewrites.delete_files(spark, path, (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_totalprice") < 100000), ["o_orderpriority"])
    return read_parquet(spark, path).select(orders.columns)


@query
def update_everywhere(spark: SparkSession, sf: str) -> DataFrame:
    """An update whose condition is always true."""
    change = {"c_acctbal": F.round(F.col("c_acctbal") / 2, 3)}
    return tables.update_where(table(spark, sf, "customer"), change, F.lit(True))


@query
def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_nationkey") != 3, F.col("c_acctbal"))
    )
    return tables.delete_where(customers, F.col("c_acctbal") < 1000)


@query
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ranking.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


# Learning


@query
def linreg_fit(spark: SparkSession, sf: str) -> DataFrame:
    model = ml.fit_line(inputs.line_points(spark, sf), ["X"], "label")
    figures = regression.line_figures(spark, model, ["X"])
    return figures.select(F.round("X", 3).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query
def linreg_by_groups(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    lines = ml.line_by_groups(items, ["l_returnflag"], "l_quantity", "l_extendedprice")
    rounded = [F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept")]
    return lines.select("l_returnflag", *rounded, "points")


@query
def linreg_score(spark: SparkSession, sf: str) -> DataFrame:
    points = inputs.line_points(spark, sf)
    _, _, tested = regression.fit_and_score(points, ["X"], "label", LINE_KEY, portable=True)
    error = regression.with_error(tested, "label")
    return error.select("l_orderkey", "l_linenumber", "X", *[F.round(c, 2).alias(c) for c in ("prediction", "error")])


@query
def linreg_rmse(spark: SparkSession, sf: str) -> DataFrame:
    points = inputs.line_points(spark, sf)
    _, trained, tested = regression.fit_and_score(points, ["X"], "label", LINE_KEY, portable=True)
    parts = [ml.rmse(part, "label").select(F.lit(name).alias("part"), F.round("rmse", 2).alias("rmse"))
             for name, part in (("train", trained), ("test", tested))]
    return reshape.union_all(parts)


@query
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    train, test = ml.key_split(orders, ["o_orderkey"], 0.83, seed=1, portable=True)
    sizes = [part.agg(F.lit(name).alias("part"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"))
             for name, part in (("train", train), ("test", test))]
    return reshape.union_all(sizes)


@query
def keyed_random_values(spark: SparkSession, sf: str) -> DataFrame:
    """Two draws for each line item, the same on any cluster."""
    items = table(spark, sf, "lineitem").repartition(7)
    draws = [keyed_random.keyed_value(LINE_KEY, 5, draw=k).alias(f"draw{k}") for k in (0, 1)]
    return items.select(*LINE_KEY, *draws, F.round(keyed_random.keyed_normal(LINE_KEY, 5, 1), 6).alias("normal"))


@query
def keyed_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = keyed_random.keyed_split(table(spark, sf, "orders"), ["o_orderkey"], (6, 3, 1), seed=9)
    return reshape.union_all(
        [part.agg(F.lit(k).alias("part"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum")) for k, part in enumerate(parts)]
    )


@query
def cyclic_eval(spark: SparkSession, sf: str) -> DataFrame:
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    month = F.month("o_orderdate") - 1
    months = orders.select(month.alias("label"), ((month + F.col("o_orderkey") % 5) % 12).alias("prediction"))
    hour = F.hour("ts")
    hours = events.select(hour.alias("label"), ((hour + F.col("event_id") % 7) % 24).alias("prediction"))

    def chances(period: int) -> Column:
        """Half for the prediction, the rest shared by the other classes."""
        each = F.transform(F.sequence(F.lit(0), F.lit(period - 1)), lambda k: F.when(k == F.col("prediction"), 0.5).otherwise(0.5 / (period - 1)))
        return array_to_vector(each)

    results = [
        ml.cyclic_evaluation(scored.withColumn("probability", chances(period)), "label", period, probability="probability").select(
            F.lit(name).alias("case"), "*"
        )
        for name, scored, period in (("month", months, 12), ("hour", hours, 24))
    ]
    figures = ("within_0", "within_1", "within_2", "mean_probability")
    return reshape.union_all(results).select("case", "predictions", *[F.round(name, 4).alias(name) for name in figures])


def _measurements(spark: SparkSession, sf: str) -> DataFrame:
    """Each case reads the rows several times, so the derived columns are computed and stored once."""
    return stored(classification.with_labels(inputs.minute_measurements(spark, sf)), "measurements")


def _study(spark: SparkSession, sf: str, cases: dict[str, classification.Case]) -> DataFrame:
    """Tested rows, share of the commonest class and whether the model does at least as well, per case."""
    rows = _measurements(spark, sf)
    measured = classification.run_study(rows, LINE_KEY, cases, portable=True)
    joined = keyed_join(classification.commonest(rows, LINE_KEY, cases), measured, {"case": "case"})
    better = (F.col("within_0") > F.col("commonest")) & (F.col("within_0") <= F.col("within_1")) & (F.col("within_1") <= F.col("within_2"))
    probable = F.col("mean_probability").between(0, 1)
    return joined.select("case", "tested", F.round("commonest", 6).alias("commonest"), (better & probable).alias("better"))


@query
def forest_study(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf, classification.study_cases())


@query
def classifier_choices(spark: SparkSession, sf: str) -> DataFrame:
    return _study(spark, sf, classification.further_cases())


def _bayes_scored(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, str, int]]:
    rows, out = _measurements(spark, sf), {}
    for name, label, columns in (
        ("month_weather_solar", classification.MONTH, (*classification.WEATHER, classification.POWER[2])),
        ("hour_power_price", classification.HOUR, (*classification.POWER, *classification.PRICE)),
    ):
        train, test = ml.key_split(rows.dropna(subset=[label]), LINE_KEY, 0.8, portable=True)
        period = classification.PERIODS[label]
        model = bayes.fit_gaussian_bayes(train, columns, label)
        out[name] = (model.scored(test, period), label, period)
    return out


@query
def bayes_study(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy within 0, 1 and 2 steps, mean probability, and the accuracy that the built-in evaluator finds."""
    results = []
    for name, (scored, label, period) in _bayes_scored(spark, sf).items():
        figures = ml.cyclic_evaluation(scored, label, period, probability="probability")
        rounded = [F.round(c, 5).alias(c) for c in ("within_0", "within_1", "within_2", "mean_probability")]
        built_in = F.round(F.lit(100 * ml.accuracy_value(scored, label)), 5).alias("evaluator")
        results.append(figures.select(F.lit(name).alias("case"), "predictions", *rounded, built_in))
    return reshape.union_all(results)


@query
def bayes_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions by true and told class."""
    results = [
        bayes.confusion(scored, label, period).select(F.lit(name).alias("case"), "*")
        for name, (scored, label, period) in _bayes_scored(spark, sf).items()
    ]
    return reshape.union_all(results)
