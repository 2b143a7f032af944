"""Sessions of a growing log, kept in a folder and updated batch by batch.

Each user's last session is open: later events may extend it. The others are
closed. A batch of events is first added up per (user, time chunk as wide as the
gap), as in `session_table`, and met with what its users have stored:

* Mostly the batch lies behind a user's closed sessions. Then only the user's
  open session takes part, and no closed session is read or written.
* Late events reach back. Then the user's closed sessions from the first one
  that the batch may touch take part too, since a late event can extend,
  join or number anew all that follows. They are found by user and by the day
  they end, by which the stored files are laid out.

Stored sessions and new chunks are spans of time; a span that begins no more
than the gap after all earlier spans of its user continues their session. The
sessions that come out are written as they now are. Users without events in the
batch are neither read nor written.

Tables under the store's path: `commits` has a row per batch; `sessions` has what
each batch wrote, by its folder, `is_open` and `end_day`; `voided` has (user_id,
from_seq) of users with late events, whose earlier rows from that ordinal on no
longer count. Of open sessions a user's latest counts. A batch is there when its row in `commits`
is; a job that fails before leaves a folder that nothing reads, and the batch can
be added again. A batch that is there already is not added twice. One job at a
time may write. `compact` writes all sessions anew as one batch, after which
earlier folders are read no more (`unread_folders`).

With `lists=True` the sessions keep their events in order, for `stored_pages`
and `stored_products`. Events without a timestamp have no session.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.events import (
    DEFAULT_GAP_MINUTES,
    EVENT_ORDER,
    PRODUCT_VIEW,
    check_gap,
    minutes_2dp,
    seconds_between,
    session_id,
)
from clicktrail.operators.ordered import HOT_ROWS, KeyMin, KeySum, MaxBefore, Ordered, RunningSum, Skew, per_key_order
from clicktrail.operators.sessions import TOTALS, finish_sessions, session_totals
from clicktrail.schema import EVENT_COLUMNS
from clicktrail.session import ensure_checkpoint_dir

COMMITS = "number long, batch string, folder string, gap_minutes int, lists boolean, restart boolean"
TOTAL_FIELDS = ", ".join(f"{name} long" for name in TOTALS)
STEPS = "steps array<struct<ts:timestamp,event_id:bigint,event_type:string,item_id:string>>"
VOIDED = "user_id string, from_seq long"


class SessionStore:
    """The sessions stored under `path`; a new store if there are none."""

    def __init__(
        self, spark: SparkSession, path: str, gap_minutes: int = DEFAULT_GAP_MINUTES, lists: bool = False,
        hot_rows: int | Skew | None = HOT_ROWS,
    ):
        self.spark, self.path, self.gap_seconds = spark, path.rstrip("/"), check_gap(gap_minutes)
        self.gap_minutes, self.lists, self.hot_rows = gap_minutes, lists, hot_rows
        self.fields = ["user_id", "session_seq", "start_ts", "end_ts", "prev_end_ts", *TOTALS, *(["steps"] if lists else [])]
        for commit in self._commits():
            if (commit["gap_minutes"], commit["lists"]) != (gap_minutes, lists):
                raise ValueError(f"{path} has gap_minutes={commit['gap_minutes']}, lists={commit['lists']}")

    # --- what is stored -----------------------------------------------------------

    def _commits(self) -> list[Row]:
        """One row per batch so far, in order."""
        try:
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        found = commits.orderBy("number").collect()
        if len({commit["number"] for commit in found}) < len(found):
            raise RuntimeError(f"two jobs wrote to {self.path} at the same time")
        return found

    def batches(self) -> list[str]:
        return [commit["batch"] for commit in self._commits() if commit["batch"] is not None]

    def _live(self) -> list[Row]:
        """The batches that are read: from the last compaction on."""
        commits = self._commits()
        first = max((n for n, commit in enumerate(commits) if commit["restart"]), default=0)
        return commits[first:]

    def unread_folders(self) -> list[str]:
        """Folders of committed batches that a compaction replaced."""
        live = {commit["folder"] for commit in self._live()}
        gone = [commit["folder"] for commit in self._commits() if commit["folder"] not in live]
        return [f"{self.path}/{table}/folder={folder}" for table in ("sessions", "voided") for folder in gone]

    def _read(self, table: str, schema: str, commits: list[Row]) -> DataFrame:
        """A table of all these batches with the batch's number as `_number`."""
        if not commits:
            return self.spark.createDataFrame([], f"{schema}, _number long")
        found = self.spark.read.schema(f"{schema}, folder string").parquet(f"{self.path}/{table}")
        # Folders are partitions, so files of other batches aren't opened.
        found = found.where(F.col("folder").isin([commit["folder"] for commit in commits]))
        return found.withColumn("_number", F.substring_index("folder", "-", 1).cast("long")).drop("folder")

    def _schema(self) -> str:
        steps = f", {STEPS}" if self.lists else ""
        return (
            "user_id string, session_seq long, start_ts timestamp, end_ts timestamp, prev_end_ts timestamp, "
            f"{TOTAL_FIELDS}{steps}, is_open boolean, end_day date"
        )

    def _open(self, commits: list[Row]) -> DataFrame:
        """Each user's last session."""
        rows = self._read("sessions", self._schema(), commits).where("is_open")
        latest = F.max_by(F.struct(*self.fields), F.col("_number")).alias("s")
        return rows.groupBy(F.col("user_id").alias("_user")).agg(latest).select("s.*")

    def _closed(self, commits: list[Row], since: Column | None = None) -> DataFrame:
        """The closed sessions that count; of those that ended before the day `since` none need be there."""
        rows = self._read("sessions", self._schema(), commits).where("NOT is_open")
        if since is not None:
            rows = rows.where(F.col("end_day") >= since)
        voided = self._read("voided", VOIDED, commits).groupBy(F.col("user_id").alias("_user")).agg(
            # At most one entry per batch.
            F.collect_list(F.struct("_number", "from_seq")).alias("_cuts")
        )
        cut = F.exists("_cuts", lambda c: (c["_number"] > F.col("_number")) & (c["from_seq"] <= F.col("session_seq")))
        kept = rows.join(voided, rows["user_id"].eqNullSafe(voided["_user"]), "left")
        return kept.where(~F.coalesce(cut, F.lit(False))).select(*self.fields)

    def stored(self) -> DataFrame:
        """All sessions: user_id, session_seq, start_ts, end_ts, totals, and steps if lists are kept."""
        commits = self._live()
        return self._closed(commits).unionByName(self._open(commits))

    def sessions(self) -> DataFrame:
        """The same columns as `session_table`."""
        return finish_sessions(self.stored())

    def open_sessions(self) -> DataFrame:
        """Each user's last session, which events may still extend."""
        return finish_sessions(self._open(self._live()))

    # --- a batch ------------------------------------------------------------------

    def add(self, events: DataFrame, batch: str) -> bool:
        """Add a batch of events; False if a batch of this name is there."""
        commits = self._commits()
        if batch in [commit["batch"] for commit in commits]:
            return False
        live = self._live()
        number = 1 + max((commit["number"] for commit in commits), default=0)
        folder = f"{number}-{uuid.uuid4().hex}"
        ensure_checkpoint_dir(self.spark)
        chunks = self._chunks(events).checkpoint()
        touched, late = self._touched(chunks, live)
        self._write(folder, self._merged(touched, chunks), late)
        self._commit(number, batch, folder, False)
        return True

    def compact(self) -> None:
        """Write all sessions anew, so that reading takes them from one folder."""
        live = self._live()
        number = 1 + max((commit["number"] for commit in self._commits()), default=0)
        folder = f"{number}-{uuid.uuid4().hex}"
        rows = self._closed(live).withColumn("is_open", F.lit(False))
        rows = rows.unionByName(self._open(live).withColumn("is_open", F.lit(True)))
        self._write(folder, rows, self.spark.createDataFrame([], VOIDED))
        self._commit(number, None, folder, True)

    def _commit(self, number: int, batch: str | None, folder: str, restart: bool) -> None:
        row = (number, batch, folder, self.gap_minutes, self.lists, restart)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _write(self, folder: str, sessions: DataFrame, voided: DataFrame) -> None:
        laid_out = sessions.withColumn("end_day", F.to_date("end_ts"))
        laid_out.write.partitionBy("is_open", "end_day").parquet(f"{self.path}/sessions/folder={folder}")
        voided.write.parquet(f"{self.path}/voided/folder={folder}")

    def _chunks(self, events: DataFrame) -> DataFrame:
        """The batch added up per user and time chunk; two events of a chunk are never more than the gap apart."""
        second = F.unix_timestamp("ts")
        chunk = second - F.pmod(second, F.lit(max(self.gap_seconds, 1)))
        steps = [F.collect_list(F.struct(*EVENT_ORDER)).alias("steps")] if self.lists else []
        return (
            events.select(*EVENT_COLUMNS)
            .where(F.col("ts").isNotNull())
            .groupBy("user_id", chunk.alias("chunk"))
            .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), *session_totals(), *steps)
            .drop("chunk")
        )

    def _near(self, end: Column, start: Column) -> Column:
        return seconds_between(end, start) <= self.gap_seconds

    def _touched(self, chunks: DataFrame, commits: list[Row]) -> tuple[DataFrame, DataFrame]:
        """The stored sessions that the batch may change, and what it voids."""
        first = chunks.groupBy(F.col("user_id").alias("_user")).agg(F.min("start_ts").alias("_first"))
        opened = self._open(commits)
        opened = opened.join(first, opened["user_id"].eqNullSafe(first["_user"])).checkpoint()
        late = opened.where(self._near(F.col("prev_end_ts"), F.col("_first")))
        # The one number that goes through the driver: how far back the batch reaches.
        # Two days more, as the stored days may be those of another time zone.
        reach = F.timestamp_seconds(F.unix_timestamp(F.min("_first")) - self.gap_seconds)
        earliest = late.agg(F.date_sub(F.to_date(reach), 2)).first()[0]
        if earliest is None:
            return opened.select(*self.fields), self.spark.createDataFrame([], VOIDED)
        closed = self._closed(commits, F.lit(earliest))
        who = late.select(F.col("_user").alias("_late"), "_first")
        again = closed.join(who, closed["user_id"].eqNullSafe(who["_late"]) & self._near(closed["end_ts"], who["_first"]))
        again = again.select(*self.fields).checkpoint()
        voided = again.groupBy("user_id").agg(F.min("session_seq").alias("from_seq"))
        return opened.select(*self.fields).unionByName(again), voided

    def _merged(self, touched: DataFrame, chunks: DataFrame) -> DataFrame:
        """The sessions of the batch's users from the first touched one on, and whether each is the user's last."""
        spans = touched.unionByName(chunks, allowMissingColumns=True)

        def build(rows: Ordered) -> DataFrame:
            rows = rows.add(
                reach=MaxBefore(F.col("end_ts")), base=KeyMin(F.col("session_seq")), early=KeyMin(F.col("prev_end_ts"))
            )
            rows = rows.with_column("begins", F.when(self._near(F.col("reach"), F.col("start_ts")), 0).otherwise(1))
            found = rows.add(number=RunningSum(F.col("begins")), last=KeySum(F.col("begins"))).frame
            before = F.max(F.when(F.col("begins") == 1, F.col("reach")))
            # Of the first of these sessions the one before is known from the store.
            earlier = F.when(F.col("base") > 1, F.col("early"))
            steps = [F.array_sort(F.flatten(F.collect_list("steps"))).alias("steps")] if self.lists else []
            return (
                found.groupBy("user_id", "number", "last", "base", "early")
                .agg(
                    F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), before.alias("reach"),
                    *[F.sum(name).alias(name) for name in TOTALS], *steps,
                )
                .withColumn("prev_end_ts", F.coalesce("reach", earlier))
                .withColumn("session_seq", F.coalesce("base", F.lit(1)) - 1 + F.col("number"))
                .select(*self.fields, (F.col("number") == F.col("last")).alias("is_open"))
            )

        return per_key_order(spans, "user_id", ["start_ts", "end_ts"], build, self.hot_rows)


def stored_pages(store: SessionStore) -> DataFrame:
    """The same table as `session_pages`, from a store that keeps lists."""
    return store.stored().select(
        "user_id",
        session_id().alias("session_id"),
        "start_ts",
        "end_ts",
        seconds_between(F.col("start_ts"), F.col("end_ts")).alias("session_duration_seconds"),
        F.col("event_count").alias("page_count"),
        F.transform("steps", lambda step: step["item_id"]).alias("pages_visited"),
    )


def stored_products(store: SessionStore) -> DataFrame:
    """The same table as `session_products`, from a store that keeps lists."""

    def viewed(step: Column) -> Column:
        return (step["event_type"] == PRODUCT_VIEW) & step["item_id"].isNotNull()

    items = F.transform("steps", lambda step: step["item_id"])
    return store.stored().select(
        "user_id",
        session_id().alias("session_id"),
        "start_ts",
        "end_ts",
        minutes_2dp(seconds_between(F.col("start_ts"), F.col("end_ts"))).alias("session_duration_minutes"),
        "event_count",
        F.size(F.array_distinct(F.array_compact(items))).cast("bigint").alias("unique_products_viewed"),
        F.col("cart_adds").alias("items_added_to_cart"),
        F.transform(F.filter("steps", viewed), lambda step: step["item_id"]).alias("products_viewed"),
    )
