"""Sparse sensor readings to hourly energy, daily cost and the price of a week."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import kilo, local_hour, local_time, utc_time

CONSUMERS = ("WaterCooling01Power", "WaterCooling02Power", "VentilationPower")


def hourly_averages(
    readings: DataFrame,
    time: str = "Time",
    zone: str = "Europe/Helsinki",
    temperature: str = "Temperature",
    producer: str = "SolarPower",
    consumers: Sequence[str] = CONSUMERS,
    price: str = "ElectricityPrice",
) -> DataFrame:
    """Averages per hour under its local label; the mean watts of an hour, divided by 1000, are its kWh.

    The two hours of one label, when the clock is set back, stay two rows: they differ in their offset.
    Each row holds one sensor and NULL for the rest, which averages skip. An hour in which one of the
    consumers has no reading has no consumption.
    """
    consumed = reduce(add, [F.avg(name) for name in consumers])
    offset = F.timestamp_diff("MINUTE", utc_time(time), local_time(time, zone))
    return (
        readings.groupBy(local_hour(time, zone).alias("Time"), offset.alias("_offset"))
        .agg(
            F.avg(temperature).alias("AvgTemperature"),
            kilo(F.avg(producer)).alias("ProducedEnergy"),
            kilo(consumed).alias("ConsumedEnergy"),
            F.avg(price).alias("Price"),
        )
        .drop("_offset")
    )


def daily_totals(hourly: DataFrame) -> DataFrame:
    """Daily mean temperature, energy sums and the cost of the energy bought, rounded to two digits."""
    bought = F.col("ConsumedEnergy") - F.col("ProducedEnergy")
    return (
        hourly.groupBy(F.to_date("Time").alias("Date"))
        .agg(
            F.round(F.avg("AvgTemperature"), 2).alias("Temperature"),
            F.round(F.sum("ProducedEnergy"), 2).alias("ProducedEnergy"),
            F.round(F.sum("ConsumedEnergy"), 2).alias("ConsumedEnergy"),
            F.round(F.sum(bought * F.col("Price") / 1000), 2).alias("DailyCost"),
        )
    )


def total_cost(daily: DataFrame) -> DataFrame:
    """Sum of the rounded daily costs."""
    return daily.agg(F.round(F.sum("DailyCost"), 2).alias("TotalPrice"))
