"""Ordered per-key window functions that survive keys holding a third of all rows.

A Spark window puts every row of its partition key into one task. That is right
for almost every user or product, and fatal for a bot, for the NULL user or for
a default timestamp. So the keys are counted first, which shuffles only one
partial count per key and input split:

* No key above `hot_rows`: plain windows, one shuffle on the key.
* Some: the rows of the other keys take the plain path. The rows of the hot keys
  are cut into consecutive slices by a range partitioning on (key, order).
* More than `BROADCAST_KEYS`: all rows are sliced so, without a list of the hot
  keys and without moving any row by its key alone.

Windows run inside a slice. What a slice needs to know of the slices before or
after it is summed up in one row per (key, slice), and one pass over these rows
gives each slice what it takes over: of sessions, say, the last instant, the
number of sessions and of events, and the events since the last start. Summaries
are associative, so any cut gives the same result. Only the keys that reach into
a slice from the one before have summaries, at most two a slice; the table of
what they take over is written once and joined back by broadcast.

Exact copies of a row would all fall into one range, so they are counted before
the shuffle and numbered apart; the copy number is the last sort key. No row is
dropped, capped or sampled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from clicktrail.session import ensure_checkpoint_dir

# A key with more rows than this is sliced. At most (rows of the table /
# HOT_ROWS) keys can be hot.
HOT_ROWS = 1_000_000
# Rows per slice are between `hot_rows` / SLICE_SHRINK, where that gives no more
# slices than the session has shuffle partitions, and `hot_rows` * SLICE_GROW
# (1 to 2 GB, which a sort spills), so that 3 * 10^11 hot rows are sorted with
# some 20,000 partitions and not with millions. Beyond the session's shuffle
# partitions no slice is made for fewer than LEAST_SLICE_ROWS rows, however small
# `hot_rows`: n slices are dealt out again by n tasks, which costs n * n entries
# in the shuffle's index files and in the driver's map of them.
SLICE_SHRINK = 16
SLICE_GROW = 16
LEAST_SLICE_ROWS = 1_000_000
# Hot keys up to which their rows are split off: by a list of values in the
# filter, which reaches the scan, or by a broadcast of a few MB.
LITERAL_KEYS = 1_000
BROADCAST_KEYS = 10_000
# Largest table of what slices take over that is broadcast (a few MB; it has at
# most two rows a slice). A larger one is joined by shuffle.
BROADCAST_SLICES = 100_000
# Copies of one row that a single task writes out.
COPIES_PER_BLOCK = 100_000


@dataclass(frozen=True)
class Skew:
    """Limits other than the defaults: rows of a key that fit one task, and hot keys that are listed."""

    rows: int = HOT_ROWS
    listed: int = BROADCAST_KEYS


def rows_limit(hot_rows: int | Skew | None) -> int | None:
    return hot_rows.rows if isinstance(hot_rows, Skew) else hot_rows


COPY = "_copy"
ROW = "_row"
SLICE = "_slice"


@dataclass(frozen=True)
class Step:
    """One window column: its value inside a slice and across slices."""

    value: Column

    def plain(self, rows: WindowSpec) -> Column:
        """The result where the window holds all rows of the key."""
        return self.local(rows)

    def local(self, inside: WindowSpec) -> Column:
        """The result as far as the rows of one slice tell."""
        raise NotImplementedError

    def summary(self, row: Column) -> Column:
        """Aggregate: what other slices need to know of this one."""
        raise NotImplementedError

    def carry(self, summary: Column, slices: WindowSpec) -> Column:
        """What a slice takes over from the summaries of the key's slices."""
        raise NotImplementedError

    def merge(self, local: Column, carried: Column) -> Column:
        raise NotImplementedError


def _up_to_here(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def _whole(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


class Previous(Step):
    """The value on the key's row before this one (`lag`)."""

    def plain(self, rows):
        return F.lag(self.value).over(rows)

    # Inside a slice the value is wrapped, so that a NULL on the neighbouring
    # row is told apart from having no neighbour there.
    def local(self, inside):
        return F.lag(F.struct(self.value.alias("v"))).over(inside)

    def summary(self, row):
        return F.max_by(self.value, row)

    def carry(self, summary, slices):
        return F.lag(summary).over(slices)

    def merge(self, local, carried):
        return F.when(local.isNull(), carried).otherwise(local["v"])


class Next(Previous):
    """The value on the key's row after this one (`lead`)."""

    def plain(self, rows):
        return F.lead(self.value).over(rows)

    def local(self, inside):
        return F.lead(F.struct(self.value.alias("v"))).over(inside)

    def summary(self, row):
        return F.min_by(self.value, row)

    def carry(self, summary, slices):
        return F.lead(summary).over(slices)


class RunningSum(Step):
    """Sum over the key's rows up to and including this one."""

    def local(self, inside):
        return F.sum(self.value).over(_up_to_here(inside))

    def summary(self, row):
        return F.sum(self.value)

    def carry(self, summary, slices):
        return F.sum(summary).over(_before(slices))

    def merge(self, local, carried):
        return local + F.coalesce(carried, F.lit(0))


class RunningMax(Step):
    """Largest value over the key's rows up to and including this one."""

    def local(self, inside):
        return F.max(self.value).over(_up_to_here(inside))

    def summary(self, row):
        return F.max(self.value)

    def carry(self, summary, slices):
        return F.max(summary).over(_before(slices))

    def merge(self, local, carried):
        return F.greatest(local, carried)


class MaxBefore(RunningMax):
    """Largest value over the key's rows before this one."""

    def local(self, inside):
        return F.max(self.value).over(_before(inside))


class KeySum(RunningSum):
    """Sum over all rows of the key."""

    def local(self, inside):
        return F.sum(self.value).over(_whole(inside))

    def carry(self, summary, slices):
        return F.sum(summary).over(_whole(slices))

    def merge(self, local, carried):
        return F.coalesce(carried, local)


class KeyMin(Step):
    """Smallest value over all rows of the key."""

    def local(self, inside):
        return F.min(self.value).over(_whole(inside))

    def summary(self, row):
        return F.min(self.value)

    def carry(self, summary, slices):
        return F.min(summary).over(_whole(slices))

    def merge(self, local, carried):
        return F.least(local, carried)


@dataclass(frozen=True)
class Islands:
    """Consecutive rows of a key put together as numbered islands, such as sessions.

    `step` gives, from the column that holds `value` on the row before (NULL on
    the key's first row), by how much the island's number grows at a row.
    Positions count the rows that `counted` counts since the island began; rows
    for which `keeps` is true begin no new count.
    """

    value: Column
    step: Callable[[Column], Column]
    before: str
    grows: str
    number: str
    counted: Column | None = None
    rank: str | None = None
    position: str | None = None
    keeps: Column | None = None

    def begins(self, grows: Column) -> Column:
        begun = grows > 0
        return begun if self.keeps is None else begun & ~self.keeps

    @property
    def columns(self) -> list[str]:
        return [self.before, self.grows, self.number, *([self.rank] if self.rank else []), *([self.position] if self.position else [])]

    def plain(self, frame: DataFrame, rows: WindowSpec) -> DataFrame:
        frame = frame.withColumn(self.before, F.lag(self.value).over(rows))
        frame = frame.withColumn(self.grows, self.step(F.col(self.before)))
        added = {self.number: F.sum(self.grows).over(_up_to_here(rows))}
        if self.counted is None:
            return frame.withColumns(added)
        rank = self.rank or "_rank"
        frame = frame.withColumns({**added, rank: F.sum(self.counted).over(_up_to_here(rows))})
        if self.position:
            at = F.max(F.when(self.begins(F.col(self.grows)), F.col(rank) - self.counted)).over(_up_to_here(rows))
            frame = frame.withColumn(self.position, F.col(rank) - F.coalesce(at, F.lit(0)))
        return frame if self.rank else frame.drop(rank)

    def local(self, frame: DataFrame, inside: WindowSpec) -> DataFrame:
        """Columns _l_*: as far as the rows of a slice tell, its first row taken for the key's first."""
        frame = frame.withColumn("_l_before", F.lag(F.struct(self.value.alias("v"))).over(inside))
        frame = frame.withColumn("_l_first", F.col("_l_before").isNull())
        frame = frame.withColumn("_l_before", F.col("_l_before")["v"])
        frame = frame.withColumn("_l_grows", self.step(F.col("_l_before")))
        sums = {"_l_number": F.sum("_l_grows").over(_up_to_here(inside))}
        if self.counted is not None:
            sums["_l_one"] = self.counted
            sums["_l_rank"] = F.sum(self.counted).over(_up_to_here(inside))
        frame = frame.withColumns(sums)
        if self.position:
            later = ~F.col("_l_first") & self.begins(F.col("_l_grows"))
            at = F.max(F.when(later, F.col("_l_rank") - F.col("_l_one"))).over(_up_to_here(inside))
            frame = frame.withColumn("_l_begun", at)
        return frame

    def summary(self, columns: list[str]) -> list[Column]:
        first = F.struct(*[F.col(f"`{c}`") for c in columns], F.col("_l_grows"))
        found = [
            F.min_by(first, F.col(ROW)).alias("_s_first"),
            F.max_by(self.value, F.col(ROW)).alias("_s_last"),
            F.sum("_l_grows").alias("_s_growth"),
        ]
        if self.counted is not None:
            found.append(F.sum("_l_one").alias("_s_count"))
        if self.position:
            found.append(F.max("_l_begun").alias("_s_begun"))
        return found

    def carry(self, parts: DataFrame, key: str, slices: WindowSpec) -> DataFrame:
        """(_carry_key, _carry_slice, _c_*): what each slice takes over."""
        known = parts.withColumn("_c_before", F.lag("_s_last").over(slices))
        names = [F.col(key).alias("_carry_key"), F.col(SLICE).alias("_carry_slice")]
        # The first row's columns under their own names, for `step`.
        own = known.select(*names, *[c for c in known.columns if c not in (key, SLICE, "_s_first")], F.col("_s_first.*"))
        over = Window.partitionBy("_carry_key").orderBy("_carry_slice")
        own = own.withColumn("_c_grows", self.step(F.col("_c_before")))
        shift = F.col("_c_grows") - F.col("_l_grows")
        before = F.coalesce(F.sum(F.col("_s_growth") + shift).over(_before(over)), F.lit(0))
        added = {"_c_number": before + shift}
        if self.counted is not None:
            added["_c_rank"] = F.coalesce(F.sum("_s_count").over(_before(over)), F.lit(0))
        if self.position:
            added["_c_begins"] = self.begins(F.col("_c_grows"))
        own = own.withColumns(added)
        kept = ["_c_before", "_c_grows", *added]
        if self.position:
            begins = F.when(F.col("_c_begins"), F.col("_c_rank"))
            own = own.withColumn("_c_latest", F.greatest(F.col("_c_rank") + F.col("_s_begun"), begins))
            own = own.withColumn("_c_begun", F.greatest(F.max("_c_latest").over(_before(over)), begins))
            kept.append("_c_begun")
        return own.select("_carry_key", "_carry_slice", F.lit(True).alias("_c_found"), *kept)

    def merge(self) -> dict[str, Column]:
        taken = F.col("_l_first") & F.col("_c_found").isNotNull()
        found = {
            self.before: F.when(taken, F.col("_c_before")).otherwise(F.col("_l_before")),
            self.grows: F.when(taken, F.col("_c_grows")).otherwise(F.col("_l_grows")),
            self.number: F.col("_l_number") + F.coalesce("_c_number", F.lit(0)),
        }
        if self.counted is not None:
            earlier = F.coalesce("_c_rank", F.lit(0))
            rank = F.col("_l_rank") + earlier
            if self.rank:
                found[self.rank] = rank
            if self.position:
                begun = F.coalesce(F.greatest(F.col("_c_begun"), F.col("_l_begun") + earlier), F.lit(0))
                found[self.position] = rank - begun
        return found


@dataclass(frozen=True)
class Ordered:
    """Rows with a key and an order.

    `slices` bounds the number of slices; it is 0 where every key fits one task.
    Sliced rows are `settled` once they are in reliable storage.
    """

    frame: DataFrame
    key: str
    order: tuple[str, ...]
    slices: int = 0
    settled: bool = False

    @property
    def hot(self) -> bool:
        return self.slices > 0

    def with_column(self, name: str, value: Column) -> Ordered:
        return replace(self, frame=self.frame.withColumn(name, value))

    def add(self, islands: Islands | None = None, **steps: Step) -> Ordered:
        """Add one column per step, and those of `islands`; all share one window sort."""
        partition = [self.key, SLICE] if self.hot else [self.key]
        inside = Window.partitionBy(*partition).orderBy(*self.order)
        frame = self.frame
        if not self.hot:
            if islands is not None:
                frame = islands.plain(frame, inside)
            return replace(self, frame=frame.withColumns({n: s.plain(inside) for n, s in steps.items()}))

        columns = frame.columns
        here = frame.withColumns({f"_local_{n}": s.local(inside) for n, s in steps.items()})
        if islands is not None:
            here = islands.local(here, inside)
        if not self.settled:
            # Range bounds come from sampling: a row's place must not change
            # between the jobs that read it, or when a lost task is run again.
            ensure_checkpoint_dir(here.sparkSession)
            here = here.checkpoint()

        carried = self._carried(here, columns, islands, steps)
        joined = here.join(
            F.broadcast(carried) if 2 * self.slices <= BROADCAST_SLICES else carried,
            here[self.key].eqNullSafe(carried["_carry_key"]) & (here[SLICE] == carried["_carry_slice"]),
            "left",
        )
        merged = {n: s.merge(F.col(f"_local_{n}"), F.col(f"_carry_{n}")) for n, s in steps.items()}
        if islands is not None:
            merged.update(islands.merge())
        added = [value.alias(name) for name, value in merged.items()]
        return replace(self, frame=joined.select(*columns, *added), settled=True)

    def _carried(self, here: DataFrame, columns: list[str], islands: Islands | None, steps: dict[str, Step]) -> DataFrame:
        """One row per (key, slice) of the keys that reach over a slice's start: what the slice takes over."""
        key, row = self.key, F.col(ROW)
        firsts = here.groupBy(SLICE).agg(F.min_by(F.struct(F.col(key).alias("k")), row).alias("f"))
        firsts = firsts.select(F.col("f.k").alias("_first_key")).distinct()
        border = here.join(F.broadcast(firsts), here[key].eqNullSafe(firsts["_first_key"]), "left_semi")
        summed = [s.summary(row).alias(f"_sum_{n}") for n, s in steps.items()]
        parts = border.groupBy(key, SLICE).agg(*summed, *(islands.summary(columns) if islands is not None else []))
        across = Window.partitionBy(key).orderBy(SLICE)
        values = [s.carry(F.col(f"_sum_{n}"), across).alias(f"_carry_{n}") for n, s in steps.items()]
        names = [F.col(key).alias("_carry_key"), F.col(SLICE).alias("_carry_slice")]
        carried = parts.select(*names, *values)
        if islands is not None:
            of_islands = islands.carry(parts, key, across)
            if not steps:
                carried = of_islands
            else:
                both = of_islands.withColumnsRenamed({"_carry_key": "_k", "_carry_slice": "_s"})
                match = carried["_carry_key"].eqNullSafe(both["_k"]) & (carried["_carry_slice"] == both["_s"])
                carried = carried.join(both, match).drop("_k", "_s")
        return carried.checkpoint()


@dataclass(frozen=True)
class HotKeys:
    """The keys with more rows than allowed, their number and all their rows.

    `values` has the keys if there are few, `keys` if they may be broadcast.
    """

    keys: DataFrame | None
    count: int
    rows: int
    values: list | None = None


def find_hot_keys(df: DataFrame, key: str, hot_rows: int | Skew = HOT_ROWS) -> HotKeys | None:
    """Count rows per key and return the hot keys, None if there are none.

    BROADCAST_KEYS + 1 keys at most reach the driver, whatever the number of
    tasks; if there are that many, the hot keys aren't listed. (One task puts them
    into one row. Taking the largest would send the driver as many from each task;
    taking any would try few partitions first, then more, in several jobs.)
    """
    most = hot_rows.listed if isinstance(hot_rows, Skew) else BROADCAST_KEYS
    counts = (
        df.groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count("*").alias("_hot_rows"))
        .filter(F.col("_hot_rows") > rows_limit(hot_rows))
    )
    found = counts.limit(most + 1).agg(F.collect_list(F.struct("_hot_key", "_hot_rows")).alias("found")).first()["found"]
    if not found:
        return None
    if len(found) > most:
        number, total = counts.agg(F.count("*"), F.sum("_hot_rows")).first()
        return HotKeys(None, number, total)
    keys = df.sparkSession.createDataFrame(found, counts.schema).select("_hot_key")
    few = len(found) <= LITERAL_KEYS and isinstance(df.schema[key].dataType, (T.StringType, T.IntegralType))
    values = [row["_hot_key"] for row in found] if few else None
    return HotKeys(F.broadcast(keys), len(found), sum(r["_hot_rows"] for r in found), values)


def hot_limit(df: DataFrame, key: str, hot_rows: int | Skew | None = HOT_ROWS) -> int | Skew | None:
    """`hot_rows` if any key exceeds it, else None.

    For callers of several operators on the same events: pass the answer as
    their `hot_rows`, and they skip the count where no key is hot.
    """
    if hot_rows is None or find_hot_keys(df, key, hot_rows) is None:
        return None
    return hot_rows


def _comparable(value: Column, kind: T.DataType) -> Column:
    """`value` in a form that can be grouped and sorted: maps become sorted lists of entries."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _comparable(e["key"], kind.keyType).alias("key"), _comparable(e["value"], kind.valueType).alias("value")
            ),
        )
        return F.sort_array(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _comparable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _sort_keys(rows: DataFrame, names: list[str]) -> list[Column]:
    """The columns called `names`, those that hold maps in a comparable form."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return [
        _comparable(F.col(n), kinds[n]) if "map<" in kinds[n].simpleString() else F.col(n) for n in names
    ]


def _number_copies(rows: DataFrame, tasks: int) -> DataFrame:
    """Every row once, identical rows told apart by `_copy` = 0, 1, 2, ...

    Identical rows are counted before the shuffle, then written out again in
    blocks that are spread over the tasks. Rows with maps are grouped by the
    comparable form of the maps, and any of the equal maps stands for them.
    """
    columns = rows.columns
    zero, block = F.lit(0).cast("bigint"), F.lit(COPIES_PER_BLOCK)
    last_block = F.floor((F.col("_copies") - 1) / block)
    keys = [key.alias(f"_key_{n}") for n, key in enumerate(_sort_keys(rows, columns))]
    blocks = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_copies"), *[F.any_value(F.col(c)).alias(c) for c in columns])
        .select(*columns, "_copies", F.explode(F.sequence(zero, last_block)).alias("_block"))
    )
    blocks = blocks.repartition(tasks, *_sort_keys(blocks, columns), "_block")
    first = F.col("_block") * block
    last = F.least(first + block, F.col("_copies")) - 1
    return blocks.select(*columns, F.explode(F.sequence(first, last)).alias(COPY))


def _slice_count(spark: SparkSession, rows: int, hot_rows: int) -> int:
    """At least two, so that a single hot key is split."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fine = math.ceil(rows * SLICE_SHRINK / hot_rows)
    coarse = math.ceil(rows / max(hot_rows * SLICE_GROW, LEAST_SLICE_ROWS))
    return max(2, coarse, min(fine, partitions))


def _slice(rows: DataFrame, key: str, order: tuple[str, ...], sliced_rows: int, hot_rows: int) -> Ordered:
    """Cut the keys' rows into consecutive slices of about equal size.

    A slice is a partition of a global sort by key and order, and `_row` the
    place in that sort, which from here on replaces the order columns.
    """
    tasks = _slice_count(rows.sparkSession, sliced_rows, hot_rows)
    # Rows that tie in the order are told apart by their other columns, then
    # by the copy number, so that no range is wider than its share.
    others = [c for c in rows.columns if c != key and c not in order]
    numbered = _number_copies(rows, tasks)
    by = _sort_keys(numbered, [key, *order, *others, COPY])
    placed = (
        numbered.repartitionByRange(tasks, *by)
        .sortWithinPartitions(*by)
        .select(*rows.columns, F.monotonically_increasing_id().alias(ROW))
    )
    # The id's upper bits are the partition number.
    sliced = placed.withColumn(SLICE, F.shiftright(ROW, 33).cast("int"))
    return Ordered(sliced, key, (ROW,), slices=tasks)


def _split(df: DataFrame, key: str, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and those of the hot keys."""
    if hot.values is None:
        match = df[key].eqNullSafe(hot.keys["_hot_key"])
        return df.join(hot.keys, match, "left_anti"), df.join(hot.keys, match, "left_semi")
    listed = F.coalesce(F.col(key).isin([value for value in hot.values if value is not None]), F.lit(False))
    is_hot = listed | F.col(key).isNull() if None in hot.values else listed
    return df.filter(~is_hot), df.filter(is_hot)


def per_key_order(
    df: DataFrame,
    key: str,
    order: list[str],
    build: Callable[[Ordered], DataFrame],
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """Apply `build` to the rows of `df`, ordered within each key.

    `hot_rows=None` skips the count, for a caller who knows that every key
    fits one task.
    """
    order_by = tuple(order)
    hot = None if hot_rows is None else find_hot_keys(df, key, hot_rows)
    if hot is None:
        return build(Ordered(df, key, order_by))
    if hot.keys is None:
        return build(_slice(df, key, order_by, df.count(), rows_limit(hot_rows)))
    cold_rows, hot_rows_only = _split(df, key, hot)
    cold = build(Ordered(cold_rows, key, order_by))
    return cold.unionByName(build(_slice(hot_rows_only, key, order_by, hot.rows, rows_limit(hot_rows))))
