"""Nested JSON as landed from a paged interface: an envelope, a table object, an array of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimlathe.session import materialize
from dimlathe.sources.files import INGEST, with_ingest_order


def envelope_schema(root: str, table: str, array: str, record: T.StructType) -> T.StructType:
    """``root.table.array[]`` with the page fields next to the table object; every leaf is text."""
    text = T.StringType()
    inner = T.StructType([T.StructField(array, T.ArrayType(record))])
    page = [T.StructField(name, text) for name in ("total", "limit", "offset")]
    return T.StructType([T.StructField(root, T.StructType([*page, T.StructField(table, inner)]))])


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType | str, one_per_line: bool = True) -> DataFrame:
    """Landed pages with their ingest order. A page per line splits well; ``one_per_line=False`` reads
    one page per file."""
    return with_ingest_order(spark.read.schema(schema).option("multiLine", not one_per_line).json(path))


def page_layouts(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Per landed file: whether each line is a page (``lines``), whether it is one page (``single``), or neither."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    root = schema.fieldNames()[0]
    texts = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where("trim(value) <> ''")
    whole = F.from_json("value", schema)[root].isNotNull()
    counted = texts.groupBy("file").agg(
        F.count_if(whole).alias("whole"), F.count_if(~whole).alias("part"),
        F.sum(F.regexp_count("value", F.lit(f'"{root}"\\s*:'))).alias("roots"),
    )
    lines = (F.col("part") == 0) & (F.col("roots") == F.col("whole"))
    return counted.select("file", lines.alias("lines"), ((F.col("whole") == 0) & (F.col("roots") == 1)).alias("single"))


def read_pages(spark: SparkSession, path: str, schema: T.StructType | str, one_per_line: bool | None = None) -> DataFrame:
    """Landed pages with their ingest order, each file in its own layout, which is found out. A file in neither layout raises an
    error, as does one that ``one_per_line`` forbids and a page that does not parse; so no page is lost unseen."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    layouts = materialize(page_layouts(spark, path, schema), "page-layouts")
    fits = F.col("lines") if one_per_line else F.col("lines") | F.col("single")
    wrong = [r["file"] for r in layouts.where(~fits).orderBy("file").limit(5).collect()]
    if wrong:
        raise ValueError(f"files that hold neither a page per line nor one page: {wrong}")

    def read_as(lines: bool, files: str | list[str]) -> DataFrame:
        return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", not lines).json(files)

    kinds = [r["lines"] for r in layouts.select("lines").distinct().collect()] or [True]
    if len(kinds) == 1:
        return with_ingest_order(read_as(kinds[0], path))
    # Names of files only; Spark's driver lists them for any read.
    both = [with_ingest_order(read_as(lines, [r["file"] for r in layouts.where(F.col("lines") == lines).collect()])) for lines in (True, False)]
    return both[0].unionByName(both[1])


def records(pages: DataFrame, array_path: str, fields: Mapping[str, str] | None = None, position: str | None = None) -> DataFrame:
    """One row per record of the array at ``array_path``.

    ``fields`` maps result column to a path inside the record; a path through an absent object gives
    NULL. ``position`` adds the page's and the record's place, an ingest order for keep-first.
    """
    if position is None:
        rows = pages.select(F.explode(array_path).alias("__r"))
        extra: list[Column] = []
    else:
        rows = pages.select(INGEST, F.posexplode(array_path).alias("__at", "__r"))
        extra = [F.struct(INGEST, "__at").alias(position)]
    if fields is None:
        return rows.select("__r.*", *extra)
    return rows.select(*(F.col(f"__r.{p}").alias(c) for c, p in fields.items()), *extra)


def nested_records(
    pages: DataFrame, levels: Sequence[tuple[str, Mapping[str, str]]], first_only: bool = False
) -> DataFrame:
    """One row per element of the innermost array, with the outer levels' fields carried down.

    ``levels`` lists, from the outside, an array path (relative to the enclosing element) and the
    fields to take there. ``first_only`` reads only the first element of the outermost array.
    """
    rows, carried, prefix = pages, [], ""
    for depth, (array, fields) in enumerate(levels):
        path = f"{prefix}{array}"
        element = F.try_element_at(F.col(path), F.lit(1)) if first_only and depth == 0 else F.explode(path)
        rows = rows.select(*carried, element.alias(f"__e{depth}"))
        prefix = f"__e{depth}."
        rows = rows.select(*carried, *(F.col(prefix + p).alias(c) for c, p in fields.items()), f"__e{depth}")
        carried += list(fields)
    return rows.select(*carried)


def first_element(array: Column) -> Column:
    """The first array element; NULL if the array is absent or empty."""
    return F.try_element_at(array, F.lit(1))


def page_completeness(pages: DataFrame, root: str, array_path: str) -> DataFrame:
    """One row: assembled records, the total the pages announce, and whether they agree."""
    counted = pages.agg(
        F.coalesce(F.sum(F.when(F.col(array_path).isNull(), 0).otherwise(F.size(array_path))), F.lit(0))
        .cast("bigint").alias("assembled"),
        F.max(F.col(f"{root}.total").try_cast("bigint")).alias("announced"),
    )
    return counted.withColumn("complete", F.col("assembled") == F.col("announced"))


def innermost_count(levels: Sequence[str]) -> Column:
    """Records of a page in its innermost array; ``levels`` are array paths, each relative to the element before it."""

    def below(element: Column, rest: Sequence[str]) -> Column:
        at = element
        for name in rest[0].split("."):
            at = at[name]
        if len(rest) == 1:
            return F.coalesce(F.size(at), F.lit(0)).cast("bigint")
        return F.coalesce(
            F.aggregate(at, F.lit(0).cast("bigint"), lambda total, e: total + below(e, rest[1:])), F.lit(0).cast("bigint")
        )

    head, _, path = levels[0].partition(".")
    return below(F.col(head), [path, *levels[1:]])


def with_interval(pages: DataFrame, root: str, levels: Sequence[str], request: Column | None = None) -> DataFrame:
    """Pages with the request they answer and the interval ``[__from, __to)`` of its records that they hold.

    The request is the address that the page echoes, else the folder of its file, unless another column is given. A page that
    does not tell its offset has no interval.
    """
    folder = F.regexp_replace(F.col(f"{INGEST}.file_path"), "/[^/]*$", "")
    if request is None:
        names = pages.schema[root].dataType.fieldNames()
        request = F.coalesce(F.col(f"{root}.url"), folder) if "url" in names else folder
    start = F.col(f"{root}.offset").try_cast("bigint")
    return pages.withColumns(
        {"__request": request, "__from": start, "__to": start + innermost_count(levels), "__total": F.col(f"{root}.total").try_cast("bigint")}
    )


def page_coverage(judged: DataFrame) -> DataFrame:
    """One row per request of ``with_interval`` pages that tell their offsets: pages, records, announced total, the first missing
    offset, overlapping records, and whether every record came exactly once.

    Intervals are sorted within a request; a gap or overlap is what the next page's start is off the furthest end so far. The same page
    landed twice counts once. A total that changes between pages makes a request incomplete: it moved while it was read.
    """
    told = judged.where("__from IS NOT NULL").select("__request", "__from", "__to", "__total").distinct()
    # A request has no more pages than its total over the page size.
    order = W.partitionBy("__request").orderBy("__from", "__to")
    reach = F.coalesce(F.max("__to").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = told.withColumn("__reach", reach)
    per = placed.groupBy(F.col("__request").alias("request")).agg(
        F.count("*").alias("pages"),
        F.sum(F.col("__to") - F.col("__from")).cast("bigint").alias("records"),
        F.max("__total").alias("announced"),
        (F.min("__total").eqNullSafe(F.max("__total")) & (F.count("__total") == F.count("*"))).alias("steady"),
        F.min(F.when(F.col("__from") > F.col("__reach"), F.col("__reach"))).alias("gap"),
        F.max("__to").alias("reach"),
        F.coalesce(F.sum(F.when(F.col("__from") < F.col("__reach"), F.least("__to", "__reach") - F.col("__from"))), F.lit(0)).cast("bigint").alias("overlap"),
    )
    missing = F.coalesce(F.col("gap"), F.when(F.col("reach") < F.col("announced"), F.col("reach")))
    whole = F.coalesce(missing.isNull() & F.col("steady") & (F.col("overlap") == 0) & (F.col("records") == F.col("announced")), F.lit(False))
    return per.select("request", "pages", "records", "announced", missing.alias("missing_from"), "overlap", "steady", whole.alias("complete"))


def paged(df: DataFrame, page_size: int) -> DataFrame:
    """Assign rows to pages of at most ``page_size`` by their place in the input, not by a key, so
    the size of a page does not depend on the data."""
    place = F.monotonically_increasing_id()
    offset = place.bitwiseAND((1 << 33) - 1)
    return df.withColumn("__page", F.struct(F.shiftright(place, 33), F.floor(offset / page_size)))


def land_pages(
    df: DataFrame, path: str, root: str, table: str, array: str, record: Column, page_size: int = 100,
    announce: Column | None = None, group: Sequence[str] | None = None, children: str = "Lines",
    parent: Column | None = None,
) -> None:
    """Write rows as envelope pages, one per line: the counterpart of ``records`` and ``nested_records``.

    With ``group``, records of one page that share those columns become one parent (``parent`` gives
    its fields) with the ``children`` array. Pages bound both arrays by ``page_size``.
    """
    rows = paged(df, page_size).withColumn("__record", record)
    if group:
        grouped = rows.groupBy("__page", *group).agg(F.collect_list("__record").alias(children))
        rows = grouped.withColumn("__record", F.struct(parent, F.col(children)) if parent is not None
                                  else F.struct(*group, F.col(children)))
    pages = rows.groupBy("__page").agg(F.collect_list("__record").alias(array))
    body = [F.struct(array).alias(table)]
    if announce is not None:
        body = [announce.cast("string").alias("total"), *body]
    pages.select(F.to_json(F.struct(F.struct(*body).alias(root))).alias("value")).write.text(path)
