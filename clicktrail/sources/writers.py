"""Write results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clicktrail.functions.events import EVENT_ORDER


def write_parquet(df: DataFrame, path: str) -> None:
    """One Parquet dataset, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def write_event_table(events: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Events as the table `name` under `path`, by user in `buckets` and sorted within; the table.

    What needs a user's events together, such as `sessionize`, then takes no
    shuffle. Each task writes its own file of a bucket, so no user's events pass
    through one task here; a bucket should fit a task when read, some 200 MB.
    Results that don't go by user read the files in splits of any size, and so
    do those parts that `per_key_order` cuts out for hot users.
    """
    writer = events.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "user_id").sortBy("user_id", *EVENT_ORDER).saveAsTable(name)
    return events.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header in the order of `df`, replacing what is there.

    One file per partition, to be read in the order of their names. With
    `single_file` the tasks write their files as before, and these are joined to
    one as bytes, one after the other; no task gets the rows of others.
    """
    if not single_file:
        df.write.mode("overwrite").option("header", True).csv(path)
        return
    parts = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}"
    df.write.option("header", False).csv(parts)
    header = df.sparkSession.createDataFrame([tuple(df.columns)], [f"c{n}" for n in range(len(df.columns))])
    header.coalesce(1).write.mode("overwrite").option("header", False).csv(path)
    _join_files(df.sparkSession, parts, path)


def _join_files(spark: SparkSession, parts: str, path: str) -> None:
    """Put the files of the folder `parts` behind the one in the folder `path`, in the order of their names."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()

    def files(folder: str) -> list:
        found = sorted(status.getPath().toString() for status in system.listStatus(hadoop.fs.Path(folder)))
        return [hadoop.fs.Path(name) for name in found if name.rsplit("/", 1)[-1].startswith("part-")]

    system = hadoop.fs.Path(path).getFileSystem(conf)
    (first,) = files(path)
    joined = hadoop.fs.Path(f"{path}/_joined")
    out = system.create(joined, True)
    try:
        for file in [first, *files(parts)]:
            source = system.open(file)
            try:
                hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()
    system.delete(first, False)
    system.rename(joined, first)
    system.delete(hadoop.fs.Path(parts), True)
