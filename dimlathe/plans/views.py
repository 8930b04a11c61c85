"""The six denormalising views over the motorsport Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.functions.text import full_name, text_or
from dimlathe.plans.star import Hop, star
from dimlathe.sources.warehouse import Warehouse

# View columns in order. "driver_name" is built; the others come from the joined tables.
RESULTS_COLUMNS = (
    "result_key", "result_id", "race_key", "race_name", "circuit_key", "circuit_references", "driver_key",
    "driver_number", "driver_name", "constructor_key", "constructor_ref", "year", "full_date", "grid", "position",
    "points", "rank", "number_of_laps", "race_duration_hours", "fastest_lap", "fastest_lap_minutes",
    "fastest_lap_speed", "status",
)
LAPS_COLUMNS = (
    "lap_key", "race_key", "race_name", "circuit_key", "circuit_references", "lap", "driver_key", "driver_name",
    "constructor_key", "constructor_ref", "full_date", "lap_position", "lap_minutes", "lap_milliseconds",
)
PITSTOPS_COLUMNS = (
    "pitstop_key", "race_key", "race_name", "driver_key", "driver_name", "stop", "constructor_key",
    "constructor_ref", "full_date", "local_time", "pitlane_duration_seconds",
)
DRIVER_STANDINGS_COLUMNS = (
    "ds_key", "ds_id", "race_key", "race_name", "driver_key", "driver_name", "constructor_key", "constructor_ref",
    "full_date", "ds_position", "ds_wins",
)
CONSTRUCTOR_STANDINGS_COLUMNS = (
    "cs_key", "cs_id", "race_key", "race_name", "constructor_key", "constructor_name", "full_date", "cs_position",
    "cs_wins",
)
NOT_HELD = "not held"
_OPTIONAL = [
    f"{session}_{part}" for session in ("fp1", "fp2", "fp3", "qualification", "sprint") for part in ("date", "time")
]


def races_circuits(house: Warehouse) -> DataFrame:
    """Races with their circuits; sessions that were not held say so."""
    joined = star(house.read("dimensions.race"), Hop(house.read("dimensions.circuit"), {"circuit_key": "circuit_key"}))
    return joined.select(
        "race_key", "race_id", "race_name", "circuit_key", "circuit_references", "race_year", "race_round",
        F.col("race_date").cast("date").alias("race_date"), "race_time",
        *(text_or(F.col(c), NOT_HELD).alias(c) for c in _OPTIONAL), "race_url",
    )


def _fact_view(house: Warehouse, fact: str, columns: tuple[str, ...], driver: str | None = None) -> DataFrame:
    """A fact with the dimensions its view columns need. Snowflaked: the circuit comes through the race."""
    def table(name: str) -> DataFrame:
        return house.read(f"dimensions.{name}")

    hops = [Hop(table("race"), {"race_key": "race_key"})]
    if "circuit_references" in columns:
        hops.append(Hop(table("circuit"), {"circuit_key": "circuit_key"}))
    if "driver_name" in columns:
        drivers = table("driver")
        if driver is not None:
            drivers = drivers.where(F.col("driver_forename") == driver)
        hops.append(Hop(drivers, {"driver_key": "driver_key"}))
    hops.append(Hop(table("constructor"), {"constructor_key": "constructor_key"}))
    hops.append(Hop(table("time"), {"time_key": "time_key"}))
    name = full_name(F.col("driver_forename"), F.col("driver_surname")).alias("driver_name")
    joined = star(house.read(f"facts.{fact}"), *hops)
    return joined.select(*(name if c == "driver_name" else F.col(c) for c in columns))


def results(house: Warehouse, driver: str | None = None) -> DataFrame:
    """Race results; ``driver`` keeps one forename."""
    return _fact_view(house, "race_results", RESULTS_COLUMNS, driver)


def laps(house: Warehouse) -> DataFrame:
    return _fact_view(house, "laps", LAPS_COLUMNS)


def pitstops(house: Warehouse) -> DataFrame:
    return _fact_view(house, "pitstops", PITSTOPS_COLUMNS)


def driver_standings(house: Warehouse) -> DataFrame:
    return _fact_view(house, "driver_standings", DRIVER_STANDINGS_COLUMNS)


def constructor_standings(house: Warehouse) -> DataFrame:
    return _fact_view(house, "constructor_standings", CONSTRUCTOR_STANDINGS_COLUMNS)


def create_views(house: Warehouse, driver: str | None = None) -> None:
    """Register the six views for SQL."""
    for name, view in {
        "races_circuits": races_circuits(house),
        "results": results(house, driver),
        "laps": laps(house),
        "pitstops": pitstops(house),
        "driver_standings": driver_standings(house),
        "constructor_standings": constructor_standings(house),
    }.items():
        house.view(view, name)
