"""The motorsport warehouse end to end on a hand-made season."""

import csv
import json
import os
from datetime import datetime

import pytest

from dimlathe.plans import flows, racing, views
from dimlathe.sources.lake import Lake
from dimlathe.sources.warehouse import Warehouse

# The tables loaded a second time: one of each way of merging.
REPEATED = ("race", "race_results", "laps", "driver_standings")
LOAD, BACKFILL, WEEK = datetime(2024, 1, 1), datetime(2024, 6, 1), datetime(2026, 3, 9)

DRIVERS = {
    1: ("hamilton", "44", "HAM", "Lewis", "Hamilton", "1985-01-07", "British"),
    2: ("rosberg", "\\N", "\\N", "Nico", "Rosberg", "1985-06-27", "German"),
}
TEAMS = {1: ("mercedes", "Mercedes", "German")}
RACES = {
    10: ("2013", "1", "Melbourne Race", "2013-03-17", "06:00:00", "1"),
    11: ("2014", "1", "Sepang Race", "2014-03-30", "\\N", "2"),
}
CIRCUITS = {"1": ("albert", "Albert Park", "Melbourne", "Australia", "10"), "2": ("sepang", "Sepang", "Sepang", "Malaysia", "x")}


def wide_rows():
    """Two races, two drivers, two laps each, one pit stop each: the cross product a wide file holds."""
    result = 0
    for race, (year, rnd, name, day, clock, circuit) in RACES.items():
        for position, (driver, d) in enumerate(DRIVERS.items(), 1):
            result += 1
            for lap in (1, 2):
                c = CIRCUITS[circuit]
                yield {
                    "driverId": driver, "driverRef": d[0], "number_drivers": d[1], "code": d[2], "forename": d[3],
                    "surname": d[4], "dob": d[5], "nationality": d[6], "url": f"http://d/{driver}",
                    "constructorId": 1, "constructorRef": "mercedes", "name": "Mercedes",
                    "nationality_constructors": "German", "url_constructors": "",
                    "circuitId": circuit, "circuitRef": c[0], "name_y": c[1], "location": c[2], "country": c[3],
                    "lat": "-37.8", "lng": "144.9", "alt": c[4], "url_y": "http://c",
                    "raceId": race, "name_x": name, "year": year, "round": rnd, "date": day, "time_races": clock,
                    "url_x": "http://r", "fp1_date": "2013-03-15" if race == 10 else "\\N",
                    "fp1_time": "01:30:00" if race == 10 else "\\N", "fp2_date": "\\N", "fp2_time": "\\N",
                    "fp3_date": "\\N", "fp3_time": "\\N", "quali_date": "\\N", "quali_time": "\\N",
                    "sprint_date": "\\N", "sprint_time": "\\N",
                    "resultId": 100 + result, "number": d[1], "grid": position, "position": position,
                    "positionText": str(position), "positionOrder": position, "points": 25 if position == 1 else 18,
                    "laps": 2, "time": "1:30:03.225" if position == 1 else "+12.4s", "milliseconds": 5403225,
                    "fastestLap": 2, "rank": position, "fastestLapTime": "1:29.274", "fastestLapSpeed": 213.8,
                    "status": "Finished",
                    "lap": lap, "position_laptimes": position, "time_laptimes": "1:30.000", "milliseconds_laptimes": 90000,
                    "stop": 1, "lap_pitstops": 1, "time_pitstops": "17:05:23", "duration": "22.603" if driver == 1 else "1:02.1",
                    "milliseconds_pitstops": 22603 if driver == 1 else "\\N",
                    "driverStandingsId": 500 + result, "points_driverstandings": 25 if position == 1 else 18,
                    "position_driverstandings": position, "wins": 1 if position == 1 else 0,
                    "constructorStandingsId": 900 + race, "points_constructorstandings": 43,
                    "position_constructorstandings": 1, "wins_constructorstandings": 1,
                }


def land(folder, name, *bodies):
    os.makedirs(f"{folder}/{name}", exist_ok=True)
    for i, body in enumerate(bodies):
        with open(f"{folder}/{name}/page-{i}.json", "w") as out:
            json.dump({"MRData": {"total": "1", **body}}, out, indent=1)


def races_page(season, rnd, **extra):
    return {"RaceTable": {"Races": [{"season": season, "round": rnd, **extra}]}}


def standings_page(season, rnd, **extra):
    return {"StandingsTable": {"StandingsLists": [{"season": season, "round": rnd, **extra}]}}


def result(ref, position, **extra):
    return {
        "number": "1", "grid": "2", "position": position, "positionText": position, "points": "25", "laps": "2",
        "status": "Finished", "Driver": {"driverId": ref}, "Constructor": {"constructorId": "mercedes"}, **extra,
    }


def land_season(folder, season, rnd, ref, extra_results=()):
    """One race with a new driver ``ref``; known drivers repeat with other spellings."""
    def driver(r, name):
        return {"driverId": r, "givenName": name, "familyName": "X", "dateOfBirth": "2000-01-01", "nationality": "Any", "url": "u"}

    land(folder, "driver", {"DriverTable": {"Drivers": [driver("hamilton", "Changed"), driver(ref, "New")]}},
         {"DriverTable": {"Drivers": [driver(ref, "Second page")]}})
    land(folder, "constructor", {"ConstructorTable": {"Constructors": [
        {"constructorId": "mercedes", "name": "M", "nationality": "German", "url": "u"},
        {"constructorId": f"team {ref}", "name": "T", "nationality": "Any", "url": "u"}]}})
    land(folder, "circuit", {"CircuitTable": {"Circuits": [
        {"circuitId": f"track {season}", "circuitName": "Track", "url": "u",
         "Location": {"locality": "Town", "country": "Land", "lat": "1.5", "long": "2.5"}}]}})
    land(folder, "race", races_page(season, rnd, raceName="New Race", date=f"{season}-03-02", time="15:00:00Z", url="u",
                                    Circuit={"circuitId": f"track {season}"},
                                    FirstPractice={"date": f"{season}-02-29", "time": "11:30:00Z"}))
    land(folder, "race_results", races_page(season, rnd, Results=[
        result("hamilton", "2", Time={"time": "+1", "millis": "100"}),
        result(ref, "10", FastestLap={"rank": "1", "lap": "2", "Time": {"time": "1:30.1"}, "AverageSpeed": {"speed": "200.5"}}),
        *extra_results]))
    land(folder, "laps", races_page(season, rnd, Laps=[
        {"number": "1", "Timings": [{"driverId": "hamilton", "position": "1", "time": "1:27.452"},
                                    {"driverId": ref, "position": "2", "time": "1:02.026"}]}]))
    land(folder, "pitstops", races_page(season, rnd, PitStops=[
        {"driverId": "hamilton", "stop": "1", "lap": "1", "time": "17:00:00", "duration": "22.5005"}]))
    land(folder, "driver_standings", standings_page(season, rnd, DriverStandings=[
        {"position": "1", "points": "25", "wins": "1", "Driver": {"driverId": ref}, "Constructors": [{"constructorId": "mercedes"}, {"constructorId": "other"}]},
        {"points": "0", "wins": "0", "Driver": {"driverId": "rosberg"}, "Constructors": []}]))
    land(folder, "constructor_standings", standings_page(season, rnd, ConstructorStandings=[
        {"position": "1", "points": "25", "wins": "1", "Constructor": {"constructorId": "mercedes"}}]))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """The whole life of a warehouse; later tests look at its parts."""
    root = str(tmp_path_factory.mktemp("racing"))
    with open(f"{root}/wide.csv", "w", newline="") as out:
        rows = list(wide_rows())
        writer = csv.DictWriter(out, rows[0])
        writer.writeheader()
        writer.writerows(rows)
    lake = Lake(spark, f"{root}/silver")
    flows.load_csv(lake, f"{root}/wide.csv", LOAD)
    after_csv = {n: snapshot(lake, s) for n, s in racing.TABLES.items() if n != "time"}

    land_season(f"{root}/api", "2015", "1", "newcomer", [result("stranger", "3")])
    flows.backfill(lake, f"{root}/api", BACKFILL)
    after_api = {n: snapshot(lake, s) for n, s in racing.TABLES.items() if n != "time"}
    flows.backfill(lake, f"{root}/api", WEEK, names=REPEATED)
    after_repeat = {n: snapshot(lake, s) for n, s in racing.TABLES.items() if n != "time"}

    house = Warehouse(spark, f"{root}/gold")
    flows.build_gold(lake, house)
    gold_before = {n: house.read(s.qualified).count() for n, s in racing.TABLES.items()}

    land_season(f"{root}/week", "2026", "10", "rookie")
    published = flows.weekly(lake, f"{root}/week", f"{root}/topics", WEEK)
    again = flows.weekly(lake, f"{root}/week", f"{root}/topics", WEEK, names=REPEATED)
    inserted = flows.consume_topics(house, f"{root}/topics", f"{root}/positions")
    nothing = flows.consume_topics(house, f"{root}/topics", f"{root}/positions")
    replayed = {r.table: (r.messages, r.null_keys) for r in flows.republish(lake, f"{root}/topics").collect()}
    after_replay = flows.consume_topics(house, f"{root}/topics", f"{root}/positions")
    views.create_views(house)
    return dict(locals())


def snapshot(lake, spec):
    return {r[spec.surrogate]: r for r in lake.read(spec).collect()}


def by(table, column):
    return {r[column]: r for r in table.values()}


def test_csv_dimensions(world):
    drivers = world["after_csv"]["driver"]
    assert [(k, r.driver_ref, r.driver_number, str(r.driver_dob)) for k, r in sorted(drivers.items())] == [
        (1, "hamilton", 44, "1985-01-07"), (2, "rosberg", None, "1985-06-27"),
    ]
    races = world["after_csv"]["race"]
    assert [(r.race_id, r.circuit_key, r.race_time, r.fp1_time) for _, r in sorted(races.items())] == [
        (10, 1, "06:00:00", "01:30:00"), (11, 2, None, None),
    ]
    assert [r.circuit_altitude for _, r in sorted(world["after_csv"]["circuit"].items())] == [10, None]
    assert world["lake"].read(racing.TIME).count() == 6940


def test_csv_facts(world):
    results = world["after_csv"]["race_results"]
    assert [(k, r.result_id, r.race_key, r.driver_key, r.constructor_key, r.year, r.driver_number) for k, r in sorted(results.items())] == [
        (1, 101, 1, 1, 1, 2013, 44), (2, 102, 1, 2, 1, 2013, 0), (3, 103, 2, 1, 1, 2014, 44), (4, 104, 2, 2, 1, 2014, 0),
    ]
    # 2013-03-17 is day 442 of a calendar from 2012-01-01.
    assert {r.time_key for r in results.values() if r.year == 2013} == {442}
    laps = world["after_csv"]["laps"]
    assert [(r.race_key, r.lap, r.driver_key) for _, r in sorted(laps.items())] == [
        (race, lap, driver) for race in (1, 2) for lap in (1, 2) for driver in (1, 2)
    ]
    stops = world["after_csv"]["pitstops"]
    assert [(r.driver_key, r.pitlane_duration_seconds, r.pitlane_duration_milliseconds) for _, r in sorted(stops.items())] == [
        (1, 22.603, 22603), (2, None, 0), (1, 22.603, 22603), (2, None, 0),
    ]
    assert len(world["after_csv"]["driver_standings"]) == 4
    assert len(world["after_csv"]["constructor_standings"]) == 2
    assert os.listdir(world["root"] + "/silver/facts/race_results/v-00000001").count("year=2013") == 1


def test_backfill_dimensions(world):
    drivers = by(world["after_api"]["driver"], "driver_ref")
    assert drivers["hamilton"].driver_forename == "Lewis"
    new = drivers["newcomer"]
    assert (new.driver_key, new.driver_id, new.driver_forename, new.source, new.created_at) == (3, 10_002, "New", "api", BACKFILL)
    race = world["after_api"]["race"][3]
    assert (race.race_id, race.circuit_key, race.race_time, str(race.fp1_date)) == (10_001, 3, "15:00:00", "None")
    assert race.fp1_time == "11:30:00"


def test_backfill_facts(world):
    results = world["after_api"]["race_results"]
    added = {k: r for k, r in results.items() if k > 4}
    assert [(k, r.result_id, r.driver_key, r.position, r.year, r.fastest_lap_speed) for k, r in sorted(added.items())] == [
        (5, 10_000_001, 1, 2.0, 2015, None), (6, 10_000_003, 3, 10.0, 2015, 200.5),
    ]
    aside = world["spark"].read.parquet(world["root"] + "/silver/quarantine/race_results")
    assert {r.driver_ref for r in aside.collect()} == {"stranger"}
    laps = {k: r for k, r in world["after_api"]["laps"].items() if k > 8}
    assert [(r.driver_key, r.constructor_key, r.lap_milliseconds, r.year) for _, r in sorted(laps.items())] == [
        (1, 1, 87452, 2015), (3, 1, 62025, 2015),
    ]
    stop = world["after_api"]["pitstops"][5]
    assert (stop.pitlane_duration_milliseconds, stop.stop, stop.local_time, stop.constructor_key) == (22500, 1, "17:00:00", 1)
    standings = {k: r for k, r in world["after_api"]["driver_standings"].items() if k > 4}
    assert [(r.driver_key, r.constructor_key, r.ds_position, r.ds_id) for _, r in sorted(standings.items())] == [
        (3, 1, 1, 10_000_001), (2, None, None, 10_000_002),
    ]


def test_exact_times(world):
    spark, landing = world["spark"], world["root"] + "/exact"
    land(landing, "pitstops", races_page("2015", "1", PitStops=[
        {"driverId": "hamilton", "stop": "1", "lap": "1", "time": "17:00:00", "duration": "1:02.100"}]))
    stops = racing.RESOURCES["pitstops"]
    plain = flows.flatten(spark, f"{landing}/pitstops", stops).first()
    assert (plain.pitlane_duration_seconds, plain.pitlane_duration_milliseconds) == (None, None)
    exact = flows.flatten(spark, f"{landing}/pitstops", stops, exact_times=True).first()
    assert (exact.pitlane_duration_seconds, exact.pitlane_duration_milliseconds) == (62.1, 62100)
    laps = flows.flatten(spark, world["root"] + "/api/laps", racing.RESOURCES["laps"], exact_times=True)
    assert {r.lap_milliseconds for r in laps.collect()} == {87452, 62026}


def test_backfill_again_changes_nothing_but_replaced_rows(world):
    for name, table in world["after_repeat"].items():
        before = world["after_api"][name]
        if name in ("laps", "pitstops"):
            def strip(t, s=racing.TABLES[name]):
                return sorted([[v for c, v in r.asDict().items() if c not in (s.surrogate, "created_at")] for r in t.values()], key=str)
            assert strip(table) == strip(before), name
        else:
            assert table == before, name


def test_gold(world):
    house = world["house"]
    assert world["gold_before"]["driver"] == 3 and world["gold_before"]["time"] == 6940
    codes = {r.driver_ref: r.driver_code for r in house.read("dimensions.driver").collect()}
    assert codes["hamilton"] == "HAM" and codes["rosberg"] == "unknown"
    bad = [tuple(r) for r in flows.gold_checks(house).collect() if r.rows and r.column != "constructor_key"]
    assert bad == []


def test_weekly_increment(world):
    assert world["published"] == {
        "dimensions.driver": 1, "dimensions.constructor": 1, "dimensions.circuit": 1, "dimensions.race": 1,
        "facts.race_results": 2, "facts.laps": 2, "facts.pitstops": 1, "facts.driver_standings": 2,
        "facts.constructor_standings": 1,
    }
    assert set(world["again"].values()) == {0}
    assert world["inserted"] == world["published"]
    assert set(world["nothing"].values()) == {0}
    drivers = by(snapshot(world["lake"], racing.DRIVER), "driver_ref")
    rookie = drivers["rookie"]
    assert (rookie.driver_key, rookie.driver_id, rookie.source) == (4, 10_003, "api_incremental")
    gold = {r.driver_ref: r for r in world["house"].read("dimensions.driver").collect()}
    assert str(gold["rookie"].driver_dob) == "2000-01-01"
    results = snapshot(world["lake"], racing.RESULTS)
    assert sorted(k for k, r in results.items() if r.year == 2026) == [7, 8]
    laps = [r for r in snapshot(world["lake"], racing.LAPS).values() if r.year == 2026]
    assert {r.constructor_key for r in laps} == {1}


def test_replay_inserts_nothing(world):
    assert world["replayed"] == {f"dimensions.{n}": (1, 0) for n in ("driver", "constructor", "circuit", "race")}
    assert set(world["after_replay"].values()) == {0}


def test_views(world):
    spark = world["spark"]
    assert spark.table("results").columns == list(views.RESULTS_COLUMNS)
    assert spark.sql("SELECT count(*) AS n FROM results WHERE driver_name = 'Lewis Hamilton'").first().n == 4
    assert {r.driver_name for r in views.results(world["house"], driver="Lewis").collect()} == {"Lewis Hamilton"}
    row = spark.sql("SELECT * FROM races_circuits WHERE race_year = 2013").first()
    assert (row.fp1_date, row.fp1_time, row.sprint_date, row.circuit_references) == ("2013-03-15", "01:30:00", "not held", "albert")
    assert spark.table("laps").count() == 12 and spark.table("laps").columns == list(views.LAPS_COLUMNS)
    assert spark.table("pitstops").count() == 6
    # A standing without a constructor has no row in the inner-joined view.
    assert spark.table("driver_standings").count() == 6
    assert spark.table("constructor_standings").count() == 4


def test_pages_of_both_layouts_are_read_whole(spark, folder):
    def page(ref):
        return {"MRData": {"total": "2", "CircuitTable": {"Circuits": [{"circuitId": ref, "circuitName": ref, "url": "u",
                "Location": {"locality": "Town", "country": "Land", "lat": "1", "long": "2"}}]}}}

    os.makedirs(f"{folder}/lines")
    with open(f"{folder}/lines/a.json", "w") as out:
        out.write(json.dumps(page("one")) + "\n" + json.dumps(page("two")) + "\n")

    def refs(name):
        return sorted(r.circuit_references for r in flows.flatten(spark, f"{folder}/{name}", racing.RESOURCES["circuit"]).collect())

    assert refs("lines") == ["one", "two"]
    with open(f"{folder}/lines/b.json", "w") as out:
        json.dump(page("three"), out, indent=1)
    assert refs("lines") == ["one", "three", "two"]
    with open(f"{folder}/lines/b.json", "a") as out:  # a second page of many lines behind the first
        json.dump(page("four"), out, indent=1)
    with pytest.raises(ValueError, match="b.json"):
        refs("lines")


def test_calendar_holds_all_races_of_the_file(spark):
    wide = spark.createDataFrame([("1950-05-13",), ("\\N",), ("2013-03-17",)], "date string")
    assert flows._race_days(wide) == ("1950-01-01", "2030-12-31")
