"""Output tables and messages.

The stream's tables and the history change in versions, see ``versions``: all tables of
a micro-batch in one commit, the months of a load in one.
"""

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.text import to_message
from trendlens.operators.clean import times_as_text
from trendlens.operators.dedup import upsert_keep_last
from trendlens.streaming import versions

BATCH = "batch_id"
#: Which run of a stream wrote a batch: batch ids begin at 0 again with every checkpoint.
RUN = "run_id"
REALTIME = "realtime_data"
CATEGORY_STATS = "category_stats"
PREDICTIONS = "predictions"
TOTALS = "batch_totals"
TOP_VIDEOS = "top_videos"
#: Name of the column with a batch's time.
STAMPS = {REALTIME: "processing_timestamp", CATEGORY_STATS: "timestamp", PREDICTIONS: "timestamp", TOTALS: "timestamp", TOP_VIDEOS: "timestamp"}
#: Tables of which a batch replaces all rows; it adds to the others.
REPLACED = (PREDICTIONS,)
HISTORY = "history"
#: Messages in one file of a file stream.
MESSAGES_PER_FILE = 250_000
# What a reset empties; the category history stays.
RESET = (REALTIME, PREDICTIONS)


def _rebalanced(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows of one folder together, in as many even files as their size asks for.

    Else every task would write a file into every folder. Unlike a repartition by the
    column, this splits a folder that holds most of the rows over several tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols])


def write_clean(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    if partition_by:
        df = _rebalanced(df, partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_text(df: DataFrame, path: str) -> None:
    """The clean table as CSV with times as text; a folder of files, one per task."""
    times_as_text(df).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def write_batch(df: DataFrame, path: str, batch_id: int, run: str = "run") -> None:
    """Stores a batch of a run; the same batch written again replaces itself alone."""
    (
        df.withColumn(RUN, F.lit(run))
        .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN, BATCH)
        .parquet(path)
    )


def latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the newest batch: the current snapshot of a replaced table.

    Newest by the time its rows carry, if they do, as another run may have begun since;
    then by run and batch id. It comes from a scalar subquery over these columns.
    """
    order = [c for c in ("timestamp", RUN, BATCH) if c in df.columns]
    newest = df.select(F.max(F.struct(*order)))
    if RUN not in df.columns:
        return df.filter(F.col(BATCH) == newest.select(F.col(newest.columns[0])[BATCH]).scalar())
    which = newest.select(F.struct(*[F.col(newest.columns[0])[c].alias(c) for c in (RUN, BATCH)])).scalar()
    return df.filter((F.col(RUN) == which[RUN]) & (F.col(BATCH) == which[BATCH]))


def committed(spark: SparkSession, root: str, run: str) -> int:
    """The last batch of a run that is in the tables, or -1."""
    return versions.current(spark, root)["notes"].get(run, -1)


def commit_batch(
    spark: SparkSession, outputs: Mapping[str, DataFrame | Callable[[DataFrame], DataFrame]], root: str, run: str, batch_id: int, now: datetime
) -> bool:
    """Adds a batch to its tables in one version; False if it was there already.

    A function among ``outputs`` makes its rows from those of the first table, as written.
    A run's batches commit in the order of their ids, as a stream runs them. Rows lie in
    a folder for each day, whose time the manifest tells, so reads of the newest rows
    open few folders.
    """
    stamp = f"{now:%Y-%m-%d %H:%M:%S.%f}"
    written, source = {}, None
    for table, rows in outputs.items():
        if callable(rows):
            rows = rows(source)
        stamped = rows.withColumns({STAMPS[table]: F.lit(stamp).cast("timestamp_ntz"), RUN: F.lit(run), BATCH: F.lit(batch_id).cast("bigint")})
        schema, parts = versions.write(stamped, root, table, fixed=[("day", stamp[:10])])
        written[table] = schema, [p | {"newest": stamp, "oldest": stamp} for p in parts]
        if source is None:
            fresh = {"tables": {table: {"schema": schema, "parts": parts}}}
            source = versions.frame(spark, root, table, fresh).select(*rows.columns)
    added = False

    def edit(state: dict) -> dict | None:
        nonlocal added
        added = state["notes"].get(run, -1) < batch_id
        if not added:
            return None
        for table, (schema, parts) in written.items():
            versions.add(state, table, schema, parts, (lambda p: True) if table in REPLACED else None)
        state["notes"][run] = batch_id
        return state

    versions.change(spark, root, edit)
    return added


def write_history(df: DataFrame, path: str, partition: str = "snapshot_month") -> None:
    """A history of its own, by snapshot month; it replaces what was there."""
    schema, parts = versions.write(df, path, HISTORY, by=[partition])
    versions.change(df.sparkSession, path, lambda state: versions.add(state, HISTORY, schema, parts, lambda p: True))


def read_history(spark: SparkSession, path: str, table: str = HISTORY) -> DataFrame:
    """The history, or a table that loads derive from it."""
    return versions.frame(spark, path, table)


def merge_history(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Iterable[str] = ("video_id", "trending_date"),
    partition: str = "snapshot_month",
    latest=(),
    derived: Mapping[str, Callable[[DataFrame, str], DataFrame]] | None = None,
    attempts: int = 10,
) -> int:
    """Upserts new observations into a history partitioned by snapshot month; its version.

    Only the folders of months that occur in ``new`` are read and written anew, rows
    without a month being a month of their own. ``partition`` must follow from the
    keys. ``derived`` makes further tables from the merged rows of these months, which
    keep the column ``partition``; they change in the same version. Give the same ones
    with every load.

    Rows of one month and first key are stored side by side, as most states group by these.

    Readers see the old version until the new manifest is there, also if the job
    is lost before. If another load committed meanwhile, the merge runs again on its
    version where that changed a month of this load.
    """
    keys, derived = list(keys), dict(derived or {})
    # as many values as months in the load, not rows
    months = {r[0] for r in new.select(F.col(partition).cast("string")).distinct().collect()}

    def folders(state: dict, table: str) -> list[dict]:
        held = state["tables"].get(table, {"parts": []})
        return [p for p in held["parts"] if p["values"][partition] in months]

    for _ in range(attempts):
        state = versions.current(spark, path)
        touched = folders(state, HISTORY)
        old = versions.frame(spark, path, HISTORY, state, touched) if HISTORY in state["tables"] else new.limit(0)
        merged = upsert_keep_last(old, new.select(*old.columns), keys, latest, False, [partition, keys[0]]).select(*old.columns)
        written = {HISTORY: versions.write(merged, path, HISTORY, by=[partition])}
        fresh = {"tables": {HISTORY: dict(zip(("schema", "parts"), written[HISTORY], strict=True))}}
        for table, derive in derived.items():
            rows = versions.frame(spark, path, HISTORY, fresh)
            written[table] = versions.write(derive(rows, partition), path, table, by=[partition])
        gone = {p["folder"] for p in touched}
        lost = False

        def edit(state: dict, gone=gone, written=written) -> dict | None:
            nonlocal lost
            lost = gone != {p["folder"] for p in folders(state, HISTORY)}
            if lost:
                return None
            for table, (schema, parts) in written.items():
                versions.add(state, table, schema, parts, lambda p: p["values"][partition] in months)
            return state

        state = versions.change(spark, path, edit)
        if not lost:
            return state["version"]
    raise versions.Taken(f"other loads changed the months of this one {attempts} times")


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON message per row, in the column the Kafka sink reads."""
    return df.select(to_message().alias("value"))


def publish_topic(df: DataFrame, servers: str, topic: str, retries: int = 3) -> None:
    """Messages to Kafka, acknowledged by all replicas. Needs the Kafka connector."""
    (
        as_messages(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.retries", retries)
        .save()
    )


def publish_files(df: DataFrame, path: str, most: int = MESSAGES_PER_FILE) -> None:
    """The same messages as text files, the source of a file stream.

    They are compressed, as field names and texts repeat; one task has to read such a file,
    so it holds ``most`` messages at most.
    """
    as_messages(df).write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def reset_outputs(spark: SparkSession, root: str, names: Iterable[str] = RESET) -> None:
    """Empties output tables, keeping their schema."""

    def edit(state: dict) -> dict:
        for name in set(names) & set(state["tables"]):
            state["tables"][name]["parts"] = []
        return state

    versions.change(spark, root, edit)
