"""The motorsport warehouse: its ten tables, CSV columns and JSON resources, all as declarations."""

from __future__ import annotations

from dataclasses import dataclass, field

from dimlathe.registry import TableSpec

# Lineage names, and the bases of the id ranges given to rows from the interface.
CSV_SOURCE = "f1_data.csv"
API_SOURCE = "api"
WEEKLY_SOURCE = "api_incremental"
ID_BASE = {"driver": 10_000, "constructor": 10_000, "circuit": 10_000, "race": 10_000}
FACT_ID_BASE = 10_000_000

# Race session names in the interface and their column prefixes.
SESSIONS = {
    "fp1": "FirstPractice",
    "fp2": "SecondPractice",
    "fp3": "ThirdPractice",
    "qualification": "Qualifying",
    "sprint": "Sprint",
}

# Column names, order and types of the ten tables.
DRIVER = TableSpec(
    "driver", "dimensions",
    {
        "driver_key": "bigint", "driver_id": "bigint", "driver_ref": "string", "driver_number": "bigint",
        "driver_code": "string", "driver_forename": "string", "driver_surname": "string", "driver_dob": "date",
        "driver_nationality": "string", "driver_url": "string", "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="driver_key", natural=("driver_ref",), identity="driver_id",
    compare=("driver_forename", "driver_surname", "driver_dob", "driver_nationality", "driver_number", "driver_code"),
    unknown_text=("driver_code", "driver_nationality", "driver_url"), topic="f1.dim.drivers", topic_key="driver_ref",
)
CONSTRUCTOR = TableSpec(
    "constructor", "dimensions",
    {
        "constructor_key": "bigint", "constructor_id": "bigint", "constructor_ref": "string",
        "constructor_name": "string", "constructor_nationality": "string", "constructor_url": "string",
        "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="constructor_key", natural=("constructor_ref",), identity="constructor_id",
    compare=("constructor_name", "constructor_nationality", "constructor_url"),
    unknown_text=("constructor_nationality", "constructor_url"), topic="f1.dim.constructors",
    topic_key="constructor_ref",
)
CIRCUIT = TableSpec(
    "circuit", "dimensions",
    {
        "circuit_key": "bigint", "circuit_id": "bigint", "circuit_references": "string", "circuit_name": "string",
        "circuit_city": "string", "circuit_country": "string", "circuit_latitude": "double",
        "circuit_longtitude": "double", "circuit_altitude": "bigint", "circuit_url": "string",
        "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="circuit_key", natural=("circuit_references",), identity="circuit_id",
    compare=("circuit_name", "circuit_city", "circuit_country", "circuit_latitude", "circuit_longtitude", "circuit_url"),
    topic="f1.dim.circuits", topic_key="circuit_references",
)
_RACE_MOMENTS = {
    f"{name}_{part}": part for name in ("race", "fp1", "fp2", "fp3", "qualification", "sprint") for part in ("date", "time")
}
RACE = TableSpec(
    "race", "dimensions",
    {
        "race_key": "bigint", "race_id": "bigint", "circuit_key": "bigint", "race_name": "string",
        "race_year": "bigint", "race_round": "bigint", **_RACE_MOMENTS, "race_url": "string",
        "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="race_key", natural=("race_year", "race_round"), identity="race_id",
    compare=("race_name", "race_year", "race_round", *_RACE_MOMENTS, "race_url"), unknown_text=("race_url",),
    topic="f1.dim.races", topic_key="race_id", foreign=("circuit_key",),
)
TIME = TableSpec(
    "time", "dimensions",
    {
        "time_key": "bigint", "full_date": "date", "year": "bigint", "month": "bigint", "day_of_month": "bigint",
        "day_of_week": "bigint", "day_name": "string", "day_name_short": "string", "month_name": "string",
        "quarter": "string", "week_of_month": "bigint", "is_weekend": "boolean", "is_weekday": "boolean",
    },
    surrogate="time_key", natural=("full_date",),
)
RESULTS = TableSpec(
    "race_results", "facts",
    {
        "result_key": "bigint", "result_id": "bigint", "race_key": "bigint", "driver_key": "bigint",
        "constructor_key": "bigint", "time_key": "bigint", "year": "bigint", "driver_number": "bigint",
        "grid": "bigint", "position": "double", "position_text": "string", "position_order": "bigint",
        "points": "double", "number_of_laps": "bigint", "rank": "double", "race_duration_hours": "string",
        "race_duration_milliseconds": "double", "fastest_lap": "double", "fastest_lap_minutes": "string",
        "fastest_lap_speed": "double", "status": "string", "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="result_key", natural=("race_key", "driver_key"), identity="result_id",
    compare=(
        "driver_number", "grid", "position", "position_text", "position_order", "points", "number_of_laps",
        "race_duration_hours", "race_duration_milliseconds", "fastest_lap", "rank", "fastest_lap_minutes",
        "fastest_lap_speed", "status",
    ),
    unknown_text=("race_duration_hours",), partition="year", topic="f1.fact.results", topic_key="result_id",
    foreign=("race_key", "driver_key", "constructor_key", "time_key"),
)
LAPS = TableSpec(
    "laps", "facts",
    {
        "lap_key": "bigint", "race_key": "bigint", "lap": "bigint", "driver_key": "bigint",
        "constructor_key": "bigint", "time_key": "bigint", "lap_position": "bigint", "lap_minutes": "string",
        "lap_milliseconds": "bigint", "created_at": "timestamp_ntz", "source": "string", "year": "bigint",
    },
    surrogate="lap_key", natural=("race_key", "driver_key", "lap"),
    compare=("lap", "lap_position", "lap_minutes", "lap_milliseconds"), partition="year", topic="f1.fact.laps",
    topic_key="lap_key", foreign=("race_key", "driver_key", "constructor_key", "time_key"),
)
PITSTOPS = TableSpec(
    "pitstops", "facts",
    {
        "pitstop_key": "bigint", "race_key": "bigint", "driver_key": "bigint", "constructor_key": "bigint",
        "time_key": "bigint", "stop": "bigint", "lap": "bigint", "local_time": "string",
        "pitlane_duration_seconds": "double", "pitlane_duration_milliseconds": "bigint", "year": "bigint",
        "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="pitstop_key", natural=("race_key", "driver_key", "stop"),
    compare=("stop", "lap", "local_time", "pitlane_duration_seconds"), partition="year", topic="f1.fact.pitstops",
    topic_key="pitstop_key", foreign=("race_key", "driver_key", "constructor_key", "time_key"),
)
DRIVER_STANDINGS = TableSpec(
    "driver_standings", "facts",
    {
        "ds_key": "bigint", "ds_id": "bigint", "race_key": "bigint", "driver_key": "bigint",
        "constructor_key": "bigint", "time_key": "bigint", "ds_points": "double", "ds_position": "bigint",
        "ds_wins": "bigint", "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="ds_key", natural=("race_key", "driver_key"), identity="ds_id",
    compare=("ds_position", "ds_points", "ds_wins"), topic="f1.fact.driver_standings", topic_key="ds_key",
    foreign=("race_key", "driver_key", "constructor_key", "time_key"),
)
CONSTRUCTOR_STANDINGS = TableSpec(
    "constructor_standings", "facts",
    {
        "cs_key": "bigint", "cs_id": "bigint", "race_key": "bigint", "constructor_key": "bigint",
        "time_key": "bigint", "cs_points": "double", "cs_position": "bigint", "cs_wins": "bigint",
        "created_at": "timestamp_ntz", "source": "string",
    },
    surrogate="cs_key", natural=("race_key", "constructor_key"), identity="cs_id",
    compare=("cs_position", "cs_points", "cs_wins"), topic="f1.fact.constructor_standings", topic_key="cs_key",
    foreign=("race_key", "constructor_key", "time_key"),
)

DIMENSIONS = (DRIVER, CONSTRUCTOR, CIRCUIT, RACE, TIME)
FACTS = (RESULTS, LAPS, PITSTOPS, DRIVER_STANDINGS, CONSTRUCTOR_STANDINGS)
TABLES = {spec.name: spec for spec in (*DIMENSIONS, *FACTS)}


@dataclass(frozen=True)
class CsvTable:
    """How one table is cut out of the wide file.

    ``once_per`` keeps the first row per id; without it whole rows are made distinct. ``order``
    numbers the rows; ``zero`` lists counts that are 0 where the cell holds no number; a ``required``
    id that is missing fails the load.
    """

    spec: TableSpec
    names: dict[str, str]
    order: tuple[str, ...]
    once_per: str | None = None
    zero: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


# Column names of the wide file, per table, with their names here.
_RACE_ID, _DRIVER_ID, _CONSTRUCTOR_ID = {"raceId": "race_id"}, {"driverId": "driver_id"}, {"constructorId": "constructor_id"}
CSV_TABLES = {
    table.spec.name: table
    for table in (
        CsvTable(
            DRIVER,
            {
                "driverId": "driver_id", "driverRef": "driver_ref", "number_drivers": "driver_number",
                "code": "driver_code", "forename": "driver_forename", "surname": "driver_surname",
                "dob": "driver_dob", "nationality": "driver_nationality", "url": "driver_url",
            },
            order=("driver_id",), once_per="driver_id",
        ),
        CsvTable(
            CONSTRUCTOR,
            {
                "constructorId": "constructor_id", "constructorRef": "constructor_ref", "name": "constructor_name",
                "nationality_constructors": "constructor_nationality", "url_constructors": "constructor_url",
            },
            order=("constructor_id",), once_per="constructor_id",
        ),
        CsvTable(
            CIRCUIT,
            {
                "circuitId": "circuit_id", "circuitRef": "circuit_references", "name_y": "circuit_name",
                "location": "circuit_city", "country": "circuit_country", "lat": "circuit_latitude",
                "lng": "circuit_longtitude", "alt": "circuit_altitude", "url_y": "circuit_url",
            },
            order=("circuit_id",), once_per="circuit_id", required=("circuit_id",),
        ),
        CsvTable(
            RACE,
            {
                "raceId": "race_id", "circuitId": "circuit_id", "name_x": "race_name", "year": "race_year",
                "round": "race_round", "date": "race_date", "time_races": "race_time", "url_x": "race_url",
                "fp1_date": "fp1_date", "fp1_time": "fp1_time", "fp2_date": "fp2_date", "fp2_time": "fp2_time",
                "fp3_date": "fp3_date", "fp3_time": "fp3_time", "quali_date": "qualification_date",
                "quali_time": "qualification_time", "sprint_date": "sprint_date", "sprint_time": "sprint_time",
            },
            order=("race_id",), once_per="race_id",
        ),
        CsvTable(
            RESULTS,
            {
                "resultId": "result_id", **_RACE_ID, **_DRIVER_ID, **_CONSTRUCTOR_ID, "number": "driver_number",
                "grid": "grid", "position": "position", "positionText": "position_text",
                "positionOrder": "position_order", "points": "points", "laps": "number_of_laps",
                "time": "race_duration_hours", "milliseconds": "race_duration_milliseconds",
                "fastestLap": "fastest_lap", "rank": "rank", "fastestLapTime": "fastest_lap_minutes",
                "fastestLapSpeed": "fastest_lap_speed", "status": "status", "year": "year",
            },
            order=("result_id",), once_per="result_id",
            zero=("driver_number", "grid", "position_order", "number_of_laps"),
            required=("result_id", "race_id", "driver_id", "constructor_id", "year"),
        ),
        CsvTable(
            LAPS,
            {
                **_RACE_ID, **_DRIVER_ID, **_CONSTRUCTOR_ID, "lap": "lap", "position_laptimes": "lap_position",
                "time_laptimes": "lap_minutes", "milliseconds_laptimes": "lap_milliseconds",
            },
            order=("race_id", "lap", "driver_id"),
        ),
        CsvTable(
            PITSTOPS,
            {
                **_RACE_ID, **_DRIVER_ID, "stop": "stop", **_CONSTRUCTOR_ID, "lap_pitstops": "lap",
                "time_pitstops": "local_time", "duration": "pitlane_duration_seconds",
                "milliseconds_pitstops": "pitlane_duration_milliseconds",
            },
            order=("race_id", "driver_id", "stop"), zero=("stop", "lap", "pitlane_duration_milliseconds"),
            required=("race_id", "driver_id"),
        ),
        CsvTable(
            DRIVER_STANDINGS,
            {
                **_RACE_ID, **_DRIVER_ID, "driverStandingsId": "ds_id", **_CONSTRUCTOR_ID,
                "points_driverstandings": "ds_points", "position_driverstandings": "ds_position", "wins": "ds_wins",
            },
            order=("ds_id",),
        ),
        CsvTable(
            CONSTRUCTOR_STANDINGS,
            {
                **_RACE_ID, **_CONSTRUCTOR_ID, "constructorStandingsId": "cs_id",
                "points_constructorstandings": "cs_points", "position_constructorstandings": "cs_position",
                "wins_constructorstandings": "cs_wins",
            },
            order=("cs_id",),
        ),
    )
}


@dataclass(frozen=True)
class Resource:
    """One JSON resource: where its records are and which fields they give.

    ``levels`` lists array paths from the outside with the fields taken at each. ``order`` numbers the
    records for ids; ``once_per`` keeps the first record per natural id.
    """

    spec: TableSpec
    schema: str
    levels: tuple[tuple[str, dict[str, str]], ...]
    order: tuple[str, ...]
    first_only: bool = False
    once_per: str | None = None
    zero: tuple[str, ...] = field(default=())


def _envelope(table: str, array: str, record: str) -> str:
    return f"MRData struct<url: string, total: string, limit: string, offset: string, {table}: struct<{array}: array<struct<{record}>>>>"


# Field names of the JSON resources.
_ROUND = "season: string, `round`: string"
_YEAR_ROUND = {"race_year": "season", "race_round": "round"}
_SESSION_FIELDS = {
    f"{name}_{part}": f"{session}.{part}" for name, session in SESSIONS.items() for part in ("date", "time")
}
RESOURCES = {
    resource.spec.name: resource
    for resource in (
        Resource(
            DRIVER,
            _envelope(
                "DriverTable", "Drivers",
                "driverId: string, permanentNumber: string, code: string, givenName: string, familyName: string,"
                " dateOfBirth: string, nationality: string, url: string",
            ),
            (
                (
                    "MRData.DriverTable.Drivers",
                    {
                        "driver_ref": "driverId", "driver_number": "permanentNumber", "driver_code": "code",
                        "driver_forename": "givenName", "driver_surname": "familyName", "driver_dob": "dateOfBirth",
                        "driver_nationality": "nationality", "driver_url": "url",
                    },
                ),
            ),
            order=("driver_ref",), once_per="driver_ref",
        ),
        Resource(
            CONSTRUCTOR,
            _envelope(
                "ConstructorTable", "Constructors",
                "constructorId: string, name: string, nationality: string, url: string",
            ),
            (
                (
                    "MRData.ConstructorTable.Constructors",
                    {
                        "constructor_ref": "constructorId", "constructor_name": "name",
                        "constructor_nationality": "nationality", "constructor_url": "url",
                    },
                ),
            ),
            order=("constructor_ref",), once_per="constructor_ref",
        ),
        Resource(
            CIRCUIT,
            _envelope(
                "CircuitTable", "Circuits",
                "circuitId: string, circuitName: string, url: string,"
                " Location: struct<locality: string, country: string, lat: string, long: string>",
            ),
            (
                (
                    "MRData.CircuitTable.Circuits",
                    {
                        "circuit_references": "circuitId", "circuit_name": "circuitName",
                        "circuit_city": "Location.locality", "circuit_country": "Location.country",
                        "circuit_latitude": "Location.lat", "circuit_longtitude": "Location.long",
                        "circuit_url": "url",
                    },
                ),
            ),
            order=("circuit_references",), once_per="circuit_references",
        ),
        Resource(
            RACE,
            _envelope(
                "RaceTable", "Races",
                f"{_ROUND}, raceName: string, `date`: string, `time`: string, url: string,"
                " Circuit: struct<circuitId: string>, "
                + ", ".join(f"{s}: struct<`date`: string, `time`: string>" for s in SESSIONS.values()),
            ),
            (
                (
                    "MRData.RaceTable.Races",
                    {
                        **_YEAR_ROUND, "circuit_ref": "Circuit.circuitId", "race_name": "raceName",
                        "race_date": "date", "race_time": "time", **_SESSION_FIELDS, "race_url": "url",
                    },
                ),
            ),
            order=("race_year", "race_round"),
        ),
        Resource(
            RESULTS,
            _envelope(
                "RaceTable", "Races",
                f"{_ROUND}, Results: array<struct<number: string, grid: string, position: string,"
                " positionText: string, points: string, laps: string, status: string,"
                " Driver: struct<driverId: string>, Constructor: struct<constructorId: string>,"
                " `Time`: struct<`time`: string, millis: string>, FastestLap: struct<`rank`: string, lap: string,"
                " `Time`: struct<`time`: string>, AverageSpeed: struct<speed: string>>>>",
            ),
            (
                ("MRData.RaceTable.Races", _YEAR_ROUND),
                (
                    "Results",
                    {
                        "driver_ref": "Driver.driverId", "constructor_ref": "Constructor.constructorId",
                        "driver_number": "number", "grid": "grid", "position": "position",
                        "position_text": "positionText", "position_order": "position", "points": "points",
                        "number_of_laps": "laps", "race_duration_hours": "Time.time",
                        "race_duration_milliseconds": "Time.millis", "fastest_lap": "FastestLap.lap",
                        "rank": "FastestLap.rank", "fastest_lap_minutes": "FastestLap.Time.time",
                        "fastest_lap_speed": "FastestLap.AverageSpeed.speed", "status": "status",
                    },
                ),
            ),
            order=("race_year", "race_round", "position", "driver_ref"),
            zero=("driver_number", "grid", "position_order", "number_of_laps"),
        ),
        Resource(
            LAPS,
            _envelope(
                "RaceTable", "Races",
                f"{_ROUND}, Laps: array<struct<number: string, Timings: array<struct<driverId: string,"
                " position: string, `time`: string>>>>",
            ),
            (
                ("MRData.RaceTable.Races", _YEAR_ROUND),
                ("Laps", {"lap": "number"}),
                ("Timings", {"driver_ref": "driverId", "lap_position": "position", "lap_minutes": "time"}),
            ),
            order=("race_year", "race_round", "lap", "lap_position", "driver_ref"),
        ),
        Resource(
            PITSTOPS,
            _envelope(
                "RaceTable", "Races",
                f"{_ROUND}, PitStops: array<struct<driverId: string, stop: string, lap: string, `time`: string,"
                " duration: string>>",
            ),
            (
                ("MRData.RaceTable.Races", _YEAR_ROUND),
                (
                    "PitStops",
                    {
                        "driver_ref": "driverId", "stop": "stop", "lap": "lap", "local_time": "time",
                        "pitlane_duration_seconds": "duration",
                    },
                ),
            ),
            order=("race_year", "race_round", "lap", "stop", "driver_ref"),
        ),
        Resource(
            DRIVER_STANDINGS,
            _envelope(
                "StandingsTable", "StandingsLists",
                f"{_ROUND}, DriverStandings: array<struct<position: string, points: string, wins: string,"
                " Driver: struct<driverId: string>, Constructors: array<struct<constructorId: string>>>>",
            ),
            (
                ("MRData.StandingsTable.StandingsLists", _YEAR_ROUND),
                (
                    "DriverStandings",
                    {
                        "driver_ref": "Driver.driverId", "constructors": "Constructors", "ds_position": "position",
                        "ds_points": "points", "ds_wins": "wins",
                    },
                ),
            ),
            order=("race_year", "race_round", "ds_position", "driver_ref"),
        ),
        Resource(
            CONSTRUCTOR_STANDINGS,
            _envelope(
                "StandingsTable", "StandingsLists",
                f"{_ROUND}, ConstructorStandings: array<struct<position: string, points: string, wins: string,"
                " Constructor: struct<constructorId: string>>>",
            ),
            (
                ("MRData.StandingsTable.StandingsLists", _YEAR_ROUND),
                (
                    "ConstructorStandings",
                    {
                        "constructor_ref": "Constructor.constructorId", "cs_position": "position",
                        "cs_points": "points", "cs_wins": "wins",
                    },
                ),
            ),
            order=("race_year", "race_round", "cs_position", "constructor_ref"),
        ),
    )
}
