"""Readers.

All readers declare their schema (no inference pass over the data) and
return lazy DataFrames; filters and projections applied afterwards reach the
scan (parquet ``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

import datetime as _dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberpulse import schemas
from memberpulse.functions.temporal import lenient_timestamp


#: Page numbers are in the names of the landed files.
FILE_NAME = "file name"


def membership_csv_path(root: str, as_of) -> str:
    """SRC1 object name: ``all_members_{YYYY-MM-DD}.csv`` for the local run date."""
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return f"{root.rstrip('/')}/all_members_{as_of}.csv"


def observed(df: DataFrame, observation: Observation | None, **rejected: Column) -> DataFrame:
    """``df``, whose first action counts its ``rows`` and the rows that meet each condition into ``observation``.

    Count while writing or staging the rows: a plan that runs them twice (a global sort
    samples them first) or a recomputed stage counts them twice.
    """
    if observation is None:
        return df
    zero = F.lit(0).cast("bigint")
    counts = [F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("bigint")), zero).alias(name) for name, c in rejected.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts)


def observed_counts(observation: Observation) -> dict[str, int]:
    """What an observation counted; no rows if Spark found the plan to be empty and dropped its counters."""
    try:
        return observation.get
    except Py4JJavaError:
        return {"rows": 0}


def read_memberships_csv(spark: SparkSession, root: str, as_of, identity_type: str = "string", multi_line: bool = True,
                         observation: Observation | None = None) -> DataFrame:
    """SRC1: the day's membership CSV (header row); a missing file or column fails the read.

    Records follow RFC 4180: quoted fields may hold commas, doubled quotes and line breaks.
    Every record must have as many fields as the header, so none is cut or shifted silently:
    a shorter or longer one fails the read.  ``multi_line=False`` lets Spark split a large
    file at line breaks; a quoted one then fails the read.

    Columns are taken by header name, in any order; others are ignored.  Texts in
    ``NA_TEXTS`` are NULL.  ``*_date`` columns are parsed leniently (FN1): malformed text ->
    NULL, as malformed amounts are.  ``identity`` is text unless ``identity_type`` says
    otherwise.  Without a ``row_id`` column, rows of a single file are numbered in file
    order (T1; up to 64 GB if it is split); several files need one.

    ``observation``: counts ``rows``, ``null_identities``, ``bad_dates`` and ``bad_amounts``
    (rows with text that was read as NULL).
    """
    read = (spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').option("columnPruning", False)
            .option("multiLine", multi_line))
    df = read.csv(membership_csv_path(root, as_of))
    missing = [f.name for f in schemas.MEMBERSHIPS_CSV.fields if f.name not in df.columns and f.name != "row_id"]
    if missing:
        raise ValueError(f"membership CSV lacks columns {missing}")
    if "row_id" in df.columns:
        row_id = F.col("row_id").cast("bigint")
    elif len(df.inputFiles()) > 1:
        raise ValueError("a membership CSV of several files needs a row_id column")
    elif multi_line:  # the file is one task's
        row_id = F.monotonically_increasing_id()
    else:  # byte offset of the split, then the row's place in its task
        row_id = F.col("_metadata.file_block_start") * (1 << 27) + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    names = [f.name for f in schemas.MEMBERSHIPS.fields if f.name != "row_id"]
    raw = df.select(row_id.alias("row_id"), *[F.when(~F.col(c).isin(*schemas.NA_TEXTS), F.col(c)).alias(c) for c in names])
    dates = [c for c in names if c.endswith("_date")]
    amounts = [f.name for f in schemas.MEMBERSHIPS.fields if isinstance(f.dataType, T.DoubleType)]
    parsed = {c: lenient_timestamp(F.col(c)) for c in dates} | {c: F.col(c).try_cast("double") for c in amounts}
    parsed["identity"] = F.col("identity").cast(identity_type)
    if observation is None:
        return raw.select("row_id", *[parsed.get(c, F.col(c)).alias(c) for c in names])
    both = raw.select("*", *[v.alias(f"_{c}") for c, v in parsed.items()])

    def lost(columns: list[str]) -> Column:
        return F.exists(F.array(*[F.col(c).isNotNull() & F.col(f"_{c}").isNull() for c in columns]), lambda x: x)

    both = observed(both, observation, null_identities=F.col("_identity").isNull(), bad_dates=lost(dates), bad_amounts=lost(amounts))
    return both.select("row_id", *[F.col(f"_{c}" if c in parsed else c).alias(c) for c in names])


def _parse_text_timestamps(df: DataFrame, target: T.StructType) -> DataFrame:
    """Text timestamps of API records, parsed strictly: text that is no timestamp fails the read."""
    cols = []
    for f in target.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            parsed = lenient_timestamp(col)
            bad = F.raise_error(F.concat(F.lit(f"{f.name} is no timestamp: "), col))
            col = F.when(col.isNotNull() & parsed.isNull(), bad).otherwise(parsed)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def _check_complete(spark: SparkSession, path: str, schema: T.StructType, field: str, page: str | None, multi_line: bool) -> None:
    """Fail unless the landed pages are a whole dump: numbers 1 to n, once each, and only the last one empty.

    One pass over the pages reads their numbers and lengths; a row per page is aggregated.
    """
    element = schema[field].dataType.elementType
    narrow = T.StructType([T.StructField(field, T.ArrayType(T.StructType(element.fields[:1])))])
    if page and page != FILE_NAME:
        narrow = narrow.add(page, T.LongType())
    landed = spark.read.schema(narrow).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)
    number = (F.lit(1) if page is None else F.col(page) if page != FILE_NAME
              else F.regexp_extract("_metadata.file_name", r"(\d+)\D*$", 1).try_cast("bigint"))
    pages = landed.select(number.cast("bigint").alias("number"), F.size(field).alias("records"))
    by_number = pages.groupBy("number").agg(F.count(F.lit(1)).alias("times"), F.sum("records").alias("records"))
    found = by_number.agg(
        F.count(F.lit(1)).alias("numbers"), F.min("number").alias("low"), F.max("number").alias("high"),
        F.count_if(F.col("number").isNull()).alias("unnumbered"), F.min(F.when(F.col("times") > 1, F.col("number"))).alias("repeated"),
        F.min(F.when(F.col("records") == 0, F.col("number"))).alias("empty")).first()
    if not found["numbers"]:
        raise ValueError(f"no landed page of {field} in {path}")
    if page is None:
        if found["repeated"]:
            raise ValueError(f"{field}: a dump without page numbers must be one document")
        return
    if found["unnumbered"]:
        raise ValueError(f"{field}: a landed page has no number ({page})")
    if found["repeated"] is not None:
        raise ValueError(f"{field}: page {found['repeated']} landed more than once")
    if (found["low"], found["high"]) != (1, found["numbers"]):
        raise ValueError(f"{field}: of pages 1 to {found['high']} only {found['numbers']} landed, the first is {found['low']}")
    if found["empty"] != found["high"]:
        raise ValueError(f"{field}: the dump ends with an empty page, but page {found['empty'] or found['high']} of {found['high']} "
                         + ("is empty" if found["empty"] else "is not empty"))


def _page_records(spark: SparkSession, path: str, schema: T.StructType, field: str, page: str | None, multi_line: bool) -> DataFrame:
    """Records of a complete landed dump; a damaged page, or one without ``field``, fails the read."""
    _check_complete(spark, path, schema, field, page, multi_line)
    pages = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)
    return pages.select(F.inline(required(F.col(field), f"landed page without {field}")))


def read_member_pages(spark: SparkSession, path: str, multi_line: bool = False, page: str | None = "page") -> DataFrame:
    """SRC2: landed member-dump pages, one JSON document ``{"page": n, "members": [..]}`` per line.

    ``multi_line``: one (pretty-printed) document per file.  The dump is fetched page by
    page until an empty one, so it is whole only if pages 1 to n landed once each and the
    last alone is empty; anything else fails here, before a record is used.  ``page``: the
    field with a page's number, ``FILE_NAME`` to take the last number in the file's name,
    None for a dump of one document without a number.

    Pages are read in parallel and unnested with ``inline``.  Truncated pages, error answers
    and malformed timestamps fail, so no member is lost silently.
    """
    members = _parse_text_timestamps(_page_records(spark, path, schemas.MEMBER_PAGE, "members", page, multi_line), schemas.MEMBERS)
    return members.withColumn("email", required(F.col("email"), "member record without email"))


def required(col, message: str):
    """``col``, failing the job on a NULL (T17: keys declared non-NULL are enforced on read,
    since file readers do not enforce schema nullability)."""
    return F.when(col.isNull(), F.raise_error(F.lit(message))).otherwise(col)


def read_post_pages(spark: SparkSession, path: str, multi_line: bool = False, page: str | None = "page") -> DataFrame:
    """SRC3: landed post dumps ``{"page": n, "posts": [..]}``, strict and whole like ``read_member_pages``.

    A dump of one request has no page number (``page=None``).  OP8 applies the tag filter (FLT1).
    """
    return _parse_text_timestamps(_page_records(spark, path, schemas.POST_PAGE, "posts", page, multi_line), schemas.NEWSLETTERS)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """SRC4/SRC5: an event table, by catalog name or by path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_registry(spark: SparkSession, name_or_path: str, status: str | None = None,
                  columns: tuple[str, ...] | None = None, fmt: str = "parquet",
                  observation: Observation | None = None) -> DataFrame:
    """SRC6: the registry, optionally filtered by status and projected (pushed to the scan).

    ``observation`` counts the ``rows`` read and those with ``null_emails`` (T17), before the
    filter; the filter is then applied after the scan.
    """
    df = observed(read_table(spark, name_or_path, fmt), observation, null_emails=F.col("email").isNull())
    if status is not None:
        df = df.where(F.col("status") == status)
    return df.select(*columns) if columns else df


def unnest_json_records(df: DataFrame, col: str = "members",
                        element: str = schemas.UPSERT_RECORD) -> DataFrame:
    """SRC8/FN19/RSH3: a column of JSON array texts -> one row per element.

    Missing fields become NULL, as ``JSON_VALUE`` does; rows whose text is not
    a JSON array yield nothing.
    """
    return df.select(F.inline(F.from_json(F.col(col), element)))


def to_json_pages(records: DataFrame, page_col: str, col: str = "members") -> DataFrame:
    """Pack records into JSON array texts, one per value of ``page_col``.

    The caller picks a page key with a bounded number of records per page.
    """
    fields = [c for c in records.columns if c != page_col]
    return (records.groupBy(page_col)
            .agg(F.to_json(F.collect_list(F.struct(*fields))).alias(col)))
