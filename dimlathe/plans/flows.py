"""The flows of the motorsport warehouse: wide CSV to Silver, JSON backfill, weekly increment, Gold."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.functions.calendar import FIRST_DAY, LAST_DAY, calendar
from dimlathe.functions.coerce import (
    duration_to_millis,
    seconds_to_millis,
    strict_integer,
    to_integer_or_zero,
    typed,
)
from dimlathe.operators import keys, lookup, merge, quality, shape
from dimlathe.plans import racing
from dimlathe.registry import TableSpec
from dimlathe.session import materialize
from dimlathe.sources import envelopes, files, topics
from dimlathe.sources.lake import Lake
from dimlathe.sources.warehouse import Warehouse
from dimlathe.streaming import consume

# Dimensions before facts, circuits before races, results before the facts that take constructors from them.
ORDER = ("driver", "constructor", "circuit", "race", "race_results", "laps", "pitstops", "driver_standings",
         "constructor_standings")


# ---------------------------------------------------------------- wide CSV to Silver


def bronze(spark: SparkSession, csv: str, multi_line: bool = False) -> DataFrame:
    """The wide file with mostly-numeric text columns as numbers, written once to the shared folder."""
    cells = files.read_csv_as_text(spark, csv, ingest_order=True, multi_line=multi_line)
    table, _ = shape.infer_numeric(cells, always=("alt",))
    return materialize(table, "bronze")


def _typed_rows(rows: DataFrame, spec: TableSpec, zero: Iterable[str], required: Iterable[str] = ()) -> DataFrame:
    """Declared types; ids and the like that are no table columns become integers."""
    columns = []
    for f in rows.schema:
        if f.name in required:
            column = strict_integer(f.name, f.name)
        elif f.name in spec.columns and f.name in zero and isinstance(f.dataType, T.StringType):
            column = to_integer_or_zero(f.name)
        elif f.name in spec.columns:
            column = typed(f.name, f.dataType, spec.columns[f.name])
            column = F.coalesce(column, F.lit(0)) if f.name in zero else column
        elif f.name.endswith(("_id", "_year", "_round")):
            column = typed(f.name, f.dataType, "bigint")
        else:
            column = F.col(f.name)
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def cut_csv(wide: DataFrame, table: racing.CsvTable) -> DataFrame:
    """One table's rows out of the wide file: once per id or distinct, typed, with surrogate keys."""
    if table.once_per:
        named = shape.pick(wide, {**table.names, files.INGEST: files.INGEST})
        rows = keys.keep_first(named, [table.once_per], [files.INGEST]).drop(files.INGEST)
    else:
        rows = shape.pick(wide, table.names).distinct()
    rows = _typed_rows(rows, table.spec, table.zero, table.required)
    total = [*table.order, *(c for c in rows.columns if c not in table.order)]
    return keys.dense_key(rows, table.spec.surrogate, total)


def resolve_csv(rows: DataFrame, spec: TableSpec, lake: Lake) -> DataFrame:
    """Foreign keys from the file's ids; the race gives date and year in the same lookup."""
    # A dimension key stored more than once resolves to its last row, so no lookup multiplies facts.
    if spec.name == "race":
        take = {"circuit_key": "circuit_key"}
        return lookup.lookup(rows, lake.read(racing.CIRCUIT), {"circuit_id": "circuit_id"}, take, ["circuit_key"])
    take = {"race_key": "race_key", "race_date": "__day"}
    if "year" in spec.columns and "year" not in rows.columns:
        take["race_year"] = "year"
    rows = lookup.lookup(rows, lake.read(racing.RACE), {"race_id": "race_id"}, take, ["race_key"])
    rows = lookup.lookup(rows, lake.read(racing.TIME), {"__day": "full_date"}, {"time_key": "time_key"})
    for dim in (racing.DRIVER, racing.CONSTRUCTOR):
        if dim.surrogate in spec.columns:
            take = {dim.surrogate: dim.surrogate}
            rows = lookup.lookup(rows, lake.read(dim), {dim.identity: dim.identity}, take, [dim.surrogate])
    return rows


def _race_days(wide: DataFrame) -> tuple[str, str]:
    """The calendar's usual range, extended by whole years to hold all races of the file."""
    day = F.col("date").cast("string").try_cast("date")
    low, high = wide.agg(F.year(F.min(day)), F.year(F.max(day))).first()
    return min(FIRST_DAY, f"{low or 9999:04d}-01-01"), max(LAST_DAY, f"{high or 0:04d}-12-31")


def load_csv(
    lake: Lake, csv: str, load_ts: datetime, first_day: str | None = None, last_day: str | None = None, multi_line: bool = False
) -> DataFrame:
    """All ten Silver tables from the wide file. Rows without a year are set aside; ``multi_line`` reads quoted line breaks.
    Returns the counts of each load."""
    ledger = Ledger(lake)
    wide = bronze(lake.spark, csv, multi_line)
    span = (first_day, last_day) if first_day else _race_days(wide)
    lake.overwrite(racing.TIME, calendar(lake.spark, *span))
    for name in ORDER:
        table = racing.CSV_TABLES[name]
        rows = cut_csv(wide, table)
        if table.spec.foreign:
            rows = resolve_csv(rows, table.spec, lake)
        rows = shape.stamp_lineage(rows, racing.CSV_SOURCE, load_ts)
        existing, seen = ledger.before(table.spec), Observation()
        if table.spec.partition:
            rows = materialize(rows.observe(seen, F.count(F.lit(1)).alias("rows")), f"csv-{name}")
            lake.set_aside_unplaced(table.spec, rows)
            lake.overwrite(table.spec, rows)
        else:
            lake.overwrite(table.spec, rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        ledger.add(table.spec, existing, seen.get["rows"])
    return ledger.frame()


# ---------------------------------------------------------------- landed JSON


def flatten(
    spark: SparkSession, path: str, resource: racing.Resource, one_per_line: bool | None = None, exact_times: bool = False,
    without: DataFrame | None = None,
) -> DataFrame:
    """Typed rows of one JSON resource, with natural keys and no ids yet.

    ``exact_times`` computes lap times with decimals and reads pit stops of a minute or more; without
    it a lap time may lose a millisecond to truncation and such a stop has no duration. Each file's layout is found out;
    ``one_per_line`` requires a page per line. Pages of the requests in ``without`` are left out.
    """
    spec = resource.spec
    pages = envelopes.read_pages(spark, path, resource.schema, one_per_line)
    if without is not None:
        judged = envelopes.with_interval(pages, "MRData", [array for array, _ in resource.levels])
        pages = judged.join(without.select(F.col("request").alias("__request")), "__request", "left_anti").select(*pages.columns)
    if resource.once_per:
        array, fields = resource.levels[0]
        found = envelopes.records(pages, array, fields, position="__at")
        rows = keys.keep_first(found, [resource.once_per], ["__at"]).drop("__at")
    else:
        rows = envelopes.nested_records(pages, resource.levels, resource.first_only)
    extra = {}
    if "constructors" in rows.columns:
        extra["constructor_ref"] = envelopes.first_element(F.col("constructors"))["constructorId"]
    if spec.name == "laps":
        extra["lap_milliseconds"] = duration_to_millis("lap_minutes", exact=exact_times)
    if spec.name == "pitstops" and exact_times:
        millis = duration_to_millis("pitlane_duration_seconds", exact=True)
        extra["pitlane_duration_seconds"] = (millis / 1000).cast("string")
    rows = _typed_rows(rows.withColumns(extra).drop("constructors"), spec, resource.zero)
    if "pitlane_duration_seconds" in rows.columns:
        rows = rows.withColumn("pitlane_duration_milliseconds", seconds_to_millis("pitlane_duration_seconds"))
    if spec.partition == "year":
        rows = rows.withColumn("year", F.col("race_year"))
    absent = {c: F.lit(None).cast(t) for c, t in spec.columns.items() if c == "circuit_altitude"}
    return rows.withColumns(absent)


def resolve_api(rows: DataFrame, spec: TableSpec, lake: Lake) -> DataFrame:
    """Foreign keys from references and (year, round); laps and pit stops take the constructor of the
    same driver and race from the results."""
    if spec.name == "race":
        take = {"circuit_key": "circuit_key"}
        return lookup.lookup(rows, lake.read(racing.CIRCUIT), {"circuit_ref": "circuit_references"}, take, ["circuit_key"])
    take = {"race_key": "race_key", "race_date": "__day"}
    rounds = {"race_year": "race_year", "race_round": "race_round"}
    rows = lookup.lookup(rows, lake.read(racing.RACE), rounds, take, ["race_key"])
    rows = lookup.lookup(rows, lake.read(racing.TIME), {"__day": "full_date"}, {"time_key": "time_key"})
    for dim in (racing.DRIVER, racing.CONSTRUCTOR):
        reference = dim.natural[0]
        if reference in rows.columns:
            take = {dim.surrogate: dim.surrogate}
            rows = lookup.lookup(rows, lake.read(dim), {reference: reference}, take, [dim.surrogate])
    if "constructor_key" in spec.columns and "constructor_key" not in rows.columns:
        results = lake.read(racing.RESULTS)
        rows = lookup.lookup_via_bridge(rows, results, ["race_key", "driver_key"], "constructor_key", ["result_key"])
    return rows


def page_report(spark: SparkSession, landing: str, name: str, one_per_line: bool | None = None) -> DataFrame:
    """Coverage of each landed request of a resource whose pages tell their offsets."""
    resource = racing.RESOURCES[name]
    pages = envelopes.read_pages(spark, f"{landing}/{name}", resource.schema, one_per_line)
    return envelopes.page_coverage(envelopes.with_interval(pages, "MRData", [array for array, _ in resource.levels]))


def _batch(lake: Lake, landing: str, name: str, one_per_line: bool | None, exact_times: bool) -> DataFrame:
    resource = racing.RESOURCES[name]
    # Requests with missing, repeated or moving pages are set aside; the report names the first missing offset.
    broken = materialize(page_report(lake.spark, landing, name, one_per_line).where("NOT complete"), f"pages-{name}")
    lacking = not broken.isEmpty()
    if lacking:
        broken.write.mode("append").parquet(f"{lake.root}/quarantine/pages/{name}")
    rows = flatten(lake.spark, f"{landing}/{name}", resource, one_per_line, exact_times, broken if lacking else None)
    rows = resolve_api(rows, resource.spec, lake) if resource.spec.foreign else rows
    # Merges read the batch several times; parse and look up once.
    return materialize(rows, f"batch-{name}")


LEDGER = "table string, existing bigint, incoming bigint, final bigint, added bigint"


class Ledger:
    """Row counts of a run's loads. Parquet answers them from file footers, so no rows are read for them."""

    def __init__(self, lake: Lake):
        self.lake, self.held = lake, []

    def before(self, spec: TableSpec) -> int:
        return self.lake.read(spec).count()

    def add(self, spec: TableSpec, existing: int, incoming: int) -> None:
        final = self.before(spec)
        self.held.append((spec.qualified, existing, incoming, final, final - existing))

    def frame(self) -> DataFrame:
        """One row per load; the same counts as ``quality.load_report``."""
        return self.lake.spark.createDataFrame(self.held, LEDGER)


def foreign_key_report(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows per unresolved foreign key."""
    return quality.null_counts(rows, spec.foreign)


def backfill(
    lake: Lake, landing: str, load_ts: datetime, names: Iterable[str] = ORDER, rekey: bool = False,
    one_per_line: bool | None = None, exact_times: bool = False,
) -> DataFrame:
    """Merge landed JSON into Silver. Rows of the wide file always win.

    Rows whose natural key is incomplete, because a lookup missed, are set aside in the lake and not
    merged. Results touch only the years of the batch. Laps and pit stops replace earlier interface rows;
    ``rekey`` numbers those two tables anew, otherwise stored keys stay. Requests whose pages are incomplete are left out and
    reported below ``<lake>/quarantine/pages``. Returns the counts of each load.
    """
    ledger = Ledger(lake)
    for name in (n for n in ORDER if n in set(names)):
        resource = racing.RESOURCES[name]
        spec = resource.spec
        batch = _batch(lake, landing, name, one_per_line, exact_times)
        existing, stored_rows, incoming = lake.read(spec), ledger.before(spec), batch.count()
        if spec.identity:
            # After the largest stored id, so that successive loads give no id twice.
            base = F.lit(racing.ID_BASE.get(name, racing.FACT_ID_BASE)).cast("bigint")
            start = F.greatest(base, keys.max_key(existing, spec.identity))
            batch = keys.dense_key(batch, spec.identity, resource.order, start=start)
        batch = shape.stamp_lineage(batch, racing.API_SOURCE, load_ts)
        if spec.identity:
            lake.set_aside(spec, keys.complete_keys(batch, spec.natural, complete=False))
        if spec.identity and spec.partition:
            merged = merge.upsert_table(
                lake.read_touched(spec, batch), batch, spec, protected=racing.CSV_SOURCE, key_order=[spec.identity], load_ts=load_ts,
                floor=keys.max_key(existing, spec.surrogate),
            )
            lake.rewrite_partitions(spec, merged)
        elif spec.identity:
            merged = merge.upsert_table(
                existing, batch, spec, protected=racing.CSV_SOURCE, key_order=[spec.identity], load_ts=load_ts
            )
            lake.overwrite(spec, merged)
        else:
            lake.set_aside_unplaced(spec, batch)
            batch = files.with_partition_value(batch, spec.partition)
            leading = {"laps": ["year", "race_key", "lap", "lap_position"], "pitstops": ["year", "race_key", "stop"]}
            rest = [c for c in spec.columns if c not in leading[name] and c != spec.surrogate]
            # A table numbered by partition, like one that keeps its numbers, changes in the batch's years only.
            whole = rekey and not lake.numbered(spec)
            merged = merge.replace_unprotected(
                existing if whole else lake.read_touched(spec, batch), shape.select_existing(batch, list(spec.columns)),
                keys=spec.natural, protected=[racing.CSV_SOURCE, racing.WEEKLY_SOURCE], surrogate=spec.surrogate,
                key_order=leading[name] + rest, rekey=rekey or lake.numbered(spec), scope=["year", "race_key"],
                floor=keys.max_key(existing, spec.surrogate),
            )
            if rekey or lake.numbered(spec):
                lake.rewrite_numbered(spec, merged)
            else:
                lake.rewrite_partitions(spec, merged)
        ledger.add(spec, stored_rows, incoming)
    return ledger.frame()


def weekly(
    lake: Lake, landing: str, topic_root: str, load_ts: datetime, names: Iterable[str] = ORDER,
    servers: str | None = None, one_per_line: bool | None = None, exact_times: bool = False,
) -> dict[str, int]:
    """Add the rows not seen before to Silver and publish them; returns the published rows per table."""
    published = {}
    for name in (n for n in ORDER if n in set(names)):
        resource = racing.RESOURCES[name]
        spec = resource.spec
        batch = _batch(lake, landing, name, one_per_line, exact_times)
        order = [c for c in resource.order if c in batch.columns]
        new = merge.increment(
            lake.read(spec), batch, keys=spec.natural, surrogate=spec.surrogate, key_order=order,
            source=racing.WEEKLY_SOURCE, load_ts=load_ts, columns=list(spec.columns), identity=spec.identity,
            identity_floor=racing.ID_BASE.get(name, racing.FACT_ID_BASE), protected=racing.CSV_SOURCE,
        )
        new = materialize(new, f"weekly-{name}")
        if spec.partition:  # what Silver cannot hold is not published either
            lake.set_aside_unplaced(spec, new)
            new = files.with_partition_value(new, spec.partition)
        lake.append(spec, new)
        topics.publish(topics.as_messages(new, spec.topic_key), f"{topic_root}/{spec.topic}" if not servers else spec.topic, servers)
        published[spec.qualified] = new.count()
    return published


def republish(lake: Lake, topic_root: str, names: Iterable[str] = ORDER[:4], servers: str | None = None) -> DataFrame:
    """Send the weekly rows of tables to their topics again; returns messages and NULL keys per table."""
    report = None
    for name in names:
        spec = racing.TABLES[name]
        messages = topics.replay(lake.read(spec), racing.WEEKLY_SOURCE, spec.topic_key)
        topics.publish(messages, f"{topic_root}/{spec.topic}" if not servers else spec.topic, servers)
        row = topics.null_key_count(messages).select(F.lit(spec.qualified).alias("table"), "messages", "null_keys")
        report = row if report is None else report.union(row)
    return report


# ---------------------------------------------------------------- Gold


def build_gold(lake: Lake, house: Warehouse, first_year: int | None = None, last_year: int | None = None) -> None:
    """Recreate the Gold schemas and load the ten tables with final types; a range of years only where it is passed."""
    for area in ("dimensions", "facts"):
        house.recreate_schema(area)
    for spec in racing.TABLES.values():
        rows = lake.read(spec, first_year, last_year) if spec.partition else lake.read(spec)
        house.replace(shape.conform(rows, spec), spec.qualified, spec.partition)


def consume_topics(
    house: Warehouse, topic_root: str, checkpoints: str, servers: str | None = None, timeout: int | None = None
) -> dict[str, int]:
    """Insert published rows that Gold does not hold; returns the inserted rows per table.

    Dimensions are checked by the key of their messages, facts by surrogate key.
    """
    for area in ("dimensions", "facts"):
        house.ensure_schema(area)
    subscriptions = []
    for name in ORDER:
        spec = racing.TABLES[name]
        topic = spec.topic if servers else f"{topic_root}/{spec.topic}"
        key = spec.topic_key if spec.area == "dimensions" else spec.surrogate
        subscriptions.append(consume.Subscription(spec, topic, consume.table_sink(house, spec.qualified, [key], [spec.surrogate])))
    return consume.consume_all(house.spark, subscriptions, checkpoints, servers, timeout)


def gold_checks(house: Warehouse) -> DataFrame:
    """Duplicate surrogate keys, NULL surrogate keys and orphan foreign keys of every Gold table.

    One row per finding kind and column; ``rows`` is 0 where all is well.
    """
    report = None
    for spec in racing.TABLES.values():
        table = house.read(spec.qualified)
        repeated = quality.duplicate_keys(table, [spec.surrogate]).agg(F.count("*").alias("rows"))
        found = [("duplicate", spec.surrogate, repeated)]
        nulls = table.agg(F.count_if(F.col(spec.surrogate).isNull()).alias("rows"))
        found.append(("null key", spec.surrogate, nulls))
        for foreign in spec.foreign:
            dim = next(d for d in racing.DIMENSIONS if d.surrogate == foreign)
            lost = quality.orphan_counts(table, {foreign: (house.read(dim.qualified), foreign)})
            found.append(("orphan", foreign, lost.select(F.col("orphans").alias("rows"))))
        for kind, column, counted in found:
            row = counted.select(
                F.lit(spec.qualified).alias("table"), F.lit(kind).alias("check"), F.lit(column).alias("column"),
                F.col("rows").cast("bigint").alias("rows"),
            )
            report = row if report is None else report.union(row)
    return report
