"""Read raw event logs into canonical events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.schema import EVENT_COLUMNS, require_columns, to_events

# The column names of the two raw log formats.
JSON_COLUMNS = ["timestamp", "user_id", "action", "page_id"]
CSV_COLUMNS = ["UserID", "Timestamp", "EventType", "ProductID"]

CORRUPT = "_corrupt_record"
# JSON lines looked at before all are searched for a column's name.
SAMPLE_LINES = 1000
# A number, which as a timestamp means epoch seconds, and the largest that the timestamp type holds.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
LAST_SECOND = (2**63 - 1) // 1_000_000 - 1


def parse_timestamp(text: Column) -> Column:
    """The instant in `text`; NULL where it is none, whatever the ANSI mode."""
    return F.try_to_timestamp(text)


def parse_epoch_or_timestamp(text: Column) -> Column:
    """As `parse_timestamp`, but a number is seconds since 1970, as far as the type reaches.

    That is to the year 294,246; epoch milliseconds are instants far in the future.
    """
    seconds = F.when(text.rlike(NUMBER), text.try_cast("decimal(20,6)"))
    instant = F.timestamp_seconds(F.when(F.abs(seconds) <= LAST_SECOND, seconds))
    return F.when(seconds.isNull(), F.when(~text.rlike(NUMBER), parse_timestamp(text))).otherwise(instant)


def _names(lines: DataFrame) -> set[str]:
    """Which of the required columns any of the JSON objects in `lines` has."""
    names = lines.select(F.explode(F.json_object_keys("value")).alias("name"))
    return {row["name"] for row in names.where(F.col("name").isin(JSON_COLUMNS)).distinct().collect()}


def read_json_table(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON lines: the required columns and `keep` as text, and `_corrupt_record`.

    Every value is text, whatever the lines hold; nothing is inferred. The
    required columns are looked for in the first lines, and in all lines only
    if those lack one, to tell a rare column from a missing one.
    """
    lines = spark.read.text(path)
    if len(_names(lines.limit(SAMPLE_LINES))) < len(JSON_COLUMNS):
        found = _names(lines)
        missing = [name for name in JSON_COLUMNS if name not in found]
        if missing:
            raise ValueError(f"JSON input lacks the columns {missing}")
    fields = [T.StructField(name, T.StringType()) for name in [*JSON_COLUMNS, *keep, CORRUPT]]
    return spark.read.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every column is text.

    Columns are found by name in the header of the first file, in whatever
    order they come. Spark compares every file's header with it as it reads
    the file, and the job fails at one that differs.
    """
    header = require_columns(spark.read.option("header", True).csv(path), CSV_COLUMNS, "CSV input")
    return spark.read.schema(header.schema).option("header", True).option("enforceSchema", False).csv(path)


def json_events(table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical events of a JSON log table; the items are pages."""
    return to_events(
        require_columns(table, JSON_COLUMNS, "JSON input"),
        user_id=F.col("user_id"),
        ts=parse_epoch_or_timestamp(F.col("timestamp")),
        event_type=F.col("action"),
        item_id=F.col("page_id"),
        keep=keep,
    )


def csv_events(table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical events of a CSV log table; the items are products."""
    return to_events(
        require_columns(table, CSV_COLUMNS, "CSV input"),
        user_id=F.col("UserID"),
        ts=parse_timestamp(F.col("Timestamp")),
        event_type=F.col("EventType"),
        item_id=F.col("ProductID"),
        keep=keep,
    )


def read_json_events(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    return json_events(read_json_table(spark, path, keep), keep)


# --- what a log has that is no event ------------------------------------------

# Why a line of a log is rejected.
MALFORMED, NO_INSTANT = "malformed", "timestamp"


@dataclass(frozen=True)
class Log:
    """The events of a log and the lines that are none.

    `rejects` has file, line (its text) and reason: `malformed`, or `timestamp`
    where one is given that stands for no instant. Each line that isn't blank is
    in one of the two.
    """

    events: DataFrame
    rejects: DataFrame

    def reject_counts(self) -> DataFrame:
        """Rejected lines per file and reason."""
        return self.rejects.groupBy("file", "reason").agg(F.count("*").alias("lines"))


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of all lines that aren't blank."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return lines.where(F.trim(F.regexp_replace("line", r"[\s\x00]", "")) != "")


def _unreadable(text: Column, instant: Column) -> Column:
    return text.isNotNull() & (F.trim(text) != "") & instant.isNull()


def read_json_log(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> Log:
    """The events of JSON lines, and the lines that are no JSON object or have no readable timestamp.

    Unlike `read_json_events`, which keeps a bad line as an event without values.
    A line without a timestamp is an event without one.
    """
    fields = [T.StructField(name, T.StringType()) for name in [*JSON_COLUMNS, *keep, CORRUPT]]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("line", T.StructType(fields), options)
    lines = _text_lines(spark, path).withColumn("parsed", parsed)
    instant = parse_epoch_or_timestamp(F.col("parsed.timestamp"))
    # A line that is no object at all, such as a number or a list, isn't parsed.
    is_object = F.substring(F.ltrim("line"), 1, 1) == "{"
    reason = F.when(~is_object | F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull(), MALFORMED)
    reason = reason.when(_unreadable(F.col("parsed.timestamp"), instant), NO_INSTANT)
    judged = lines.withColumn("reason", reason)
    good = judged.where("reason IS NULL").select("parsed.*").drop(CORRUPT)
    return Log(json_events(good, keep), judged.where("reason IS NOT NULL").select("file", "line", "reason"))


def read_csv_log(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> Log:
    """The events of CSV files, and the records with too many fields or no readable timestamp.

    A record with fewer fields than the header is an event: the others are NULL.
    """
    header = require_columns(spark.read.option("header", True).csv(path), CSV_COLUMNS, "CSV input")
    schema = T.StructType([*header.schema.fields, T.StructField(CORRUPT, T.StringType())])
    # Whether a record has too many fields shows only where all columns are parsed.
    options = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    table = spark.read.schema(schema).options(**options).csv(path)
    table = table.withColumn("_file", F.col("_metadata.file_path"))
    instant = parse_timestamp(F.col("Timestamp"))
    names = header.columns
    # Records with too few fields are marked too; quoted commas part no fields.
    fields = F.size(F.split(F.regexp_replace(CORRUPT, '"[^"]*"', ""), ","))
    reason = F.when(F.col(CORRUPT).isNotNull() & (fields > len(names)), MALFORMED)
    reason = reason.when(_unreadable(F.col("Timestamp"), instant), NO_INSTANT)
    judged = table.withColumn("reason", reason)
    good = judged.where("reason IS NULL").drop(CORRUPT, "reason", "_file")
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{name}`") for name in names])))
    rejects = judged.where("reason IS NOT NULL").select(F.col("_file").alias("file"), line.alias("line"), "reason")
    return Log(csv_events(good, keep), rejects)


def read_csv_events(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    return csv_events(read_csv_table(spark, path), keep)


def read_parquet_events(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical events stored before by `write_parquet`."""
    table = require_columns(spark.read.parquet(path), EVENT_COLUMNS, "event table")
    return table.select(*EVENT_COLUMNS, *keep)


LOG_READERS = {"csv": read_csv_log, "json": read_json_log}
READERS = {"csv": read_csv_events, "json": read_json_events, "parquet": read_parquet_events}


def event_format(path: str, fmt: str | None = None) -> str:
    """`fmt`, or the format that the suffix of `path` names."""
    chosen = fmt or path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    if chosen not in READERS:
        raise ValueError(f"unsupported event format {chosen!r} of {path!r}; use one of {list(READERS)}")
    return chosen


def read_events(
    spark: SparkSession, path: str, fmt: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Canonical events from `path`; the format follows the suffix if not given.

    `keep` names further source columns to carry along, e.g. Amount, Outcome.
    """
    return READERS[event_format(path, fmt)](spark, path, keep)


# --- profile -----------------------------------------------------------------


def event_profile(table: DataFrame, ts: str | None = None) -> DataFrame:
    """One row: row_count, column_count, columns, schema, and untimed_rows if `ts` is given."""
    untimed = [] if ts is None else [F.count_if(F.col(ts).isNull()).alias("untimed_rows")]
    return table.agg(F.count("*").alias("row_count"), *untimed).withColumns(
        {
            "column_count": F.lit(len(table.columns)).cast("bigint"),
            "columns": F.lit(",".join(table.columns)),
            "schema": F.lit(table.schema.simpleString()),
        }
    )


def sample_rows(table: DataFrame, n: int = 5) -> DataFrame:
    """The first `n` rows, for a look at the data."""
    return table.limit(n)
