"""The daily analytics job: snapshot, last status and pickup for one date."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stayflow.functions.scalars import split_csv_ints
from stayflow.operators.pickup import pickup_metric
from stayflow.operators.snapshot import build_daily_snapshot, observation_dates
from stayflow.operators.status import last_status
from stayflow.schemas import DAILY_SNAPSHOT, LAST_STATUS, PICKUP_METRIC
from stayflow.sources import manifest
from stayflow.sources.tables import path_exists, read_daily_snapshot, write_dated

SNAPSHOT = "reservation_daily_snapshot"
STATUS = "reservation_last_status_daily"
PICKUP = "pickup_metric"
REJECTED = "reservation_snapshot_rejects"
SCHEMAS = {SNAPSHOT: DAILY_SNAPSHOT, STATUS: LAST_STATUS, PICKUP: PICKUP_METRIC, REJECTED: StructType([*DAILY_SNAPSHOT.fields, StructField("reject_reason", StringType())])}


def replace_date(spark: SparkSession, df: DataFrame, path: str, day: date) -> None:
    """Make the rows of ``df`` the partition of ``day``, also if there are none."""
    staging = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex[:8]}"
    part = f"snapshot_date={day.isoformat()}"
    write_dated(df.where(F.col("snapshot_date") == F.lit(day)), staging)
    _move(spark, [(f"{staging}/{part}", f"{path.rstrip('/')}/{part}")])
    _remove(spark, staging)


def refresh_daily_snapshot(core: DataFrame, raw: DataFrame, day: date, path: str, horizon_days: int = 730) -> None:
    """Rebuild one date of the snapshot table."""
    built = build_daily_snapshot(core, raw, day, horizon_days)
    replace_date(core.sparkSession, built.where("reject_reason is null").drop("reject_reason"), path, day)


def refresh_last_status(spark: SparkSession, day: date, snapshot_path: str, path: str) -> None:
    replace_date(spark, last_status(read_daily_snapshot(spark, snapshot_path, [day])), path, day)


def history(spark: SparkSession, path: str, day: date, days: Sequence[int]) -> DataFrame:
    """The observation dates a pickup needs; empty where the table does not exist yet."""
    dates = sorted({day - timedelta(days=n) for n in days})
    if not path_exists(spark, path):
        return spark.createDataFrame([], DAILY_SNAPSHOT)
    return read_daily_snapshot(spark, path, dates).select(*DAILY_SNAPSHOT.fieldNames())


def refresh_pickups(spark: SparkSession, day: date, days: Sequence[int], snapshot_path: str, path: str) -> None:
    rows = history(spark, snapshot_path, day, [0, *days])
    replace_date(spark, pickup_metric(rows, day, days), path, day)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this job has made, replaced partitions included."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _move(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Swap staged partitions in; on any failure put the old ones back."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()

    def at(path: str):
        return jvm.org.apache.hadoop.fs.Path(path)

    def fs(path: str):
        return at(path).getFileSystem(conf)

    def rename(source: str, target: str) -> None:
        fs(target).mkdirs(at(target).getParent())
        if not fs(source).rename(at(source), at(target)):
            raise OSError(f"could not move {source} to {target}")

    undo: list[tuple[str, str]] = []
    try:
        for staged, target in moves:
            if fs(target).exists(at(target)):
                # Beside the staged data, so an aborted swap leaves both to look at.
                aside = f"{staged}-replaced"
                rename(target, aside)
                undo.append((aside, target))
            if fs(staged).exists(at(staged)):
                rename(staged, target)
                undo.append((target, staged))
    except Exception:
        for source, target in reversed(undo):
            rename(source, target)
        raise


def _manifest(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def read_daily(spark: SparkSession, root: str, name: str, dates: Sequence[date] | None = None) -> DataFrame:
    """A table of the daily job as last published, or only some of its dates: no other folder is opened.

    All tables of a date come from one run, whatever becomes of a later one.
    """
    live = (manifest.read_version(spark, _manifest(root))[1] or {}).get(name, {})
    wanted = sorted(live) if dates is None else sorted({d.isoformat() for d in dates} & live.keys())
    if not wanted:
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(*[f"{root.rstrip('/')}/{live[d]}" for d in wanted])


def _undo(spark: SparkSession, root: str) -> None:
    """Remove the folders of runs that no version kept refers to: those that never published, and those replaced long ago."""
    kept = [manifest.read_json(spark, f"{_manifest(root)}/{v:012d}.json") for v in manifest.versions(spark, _manifest(root))]
    used = {folder.split("/")[1] for version in kept for dates in version.values() for folder in dates.values()}
    for run in manifest.names(spark, f"{root}/runs"):
        if run not in used:
            manifest.remove(spark, f"{root}/runs/{run}")


def backfill(
    spark: SparkSession,
    core: DataFrame,
    raw: DataFrame,
    root: str,
    dates: Sequence[date],
    days: Sequence[int] | str = (1, 3, 7, 15),
    horizon_days: int = 730,
) -> None:
    """Build all tables for some dates in one pass, then publish them together.

    Core and raw are scanned once, however many dates there are; the tables are
    those of one run per date, oldest first: a pickup compares with what this
    pass has built, elsewhere with what was published before.

    A run writes to a folder of its own; a manifest that lists the folders of
    every table and date is written last, and it alone is what ``read_daily``
    goes by. So a run that dies at any point changes nothing, and the next one
    removes what it left. Running a date again replaces it, also by nothing.
    One run at a time.
    """
    dates = observation_dates(dates)
    if not dates:
        return
    horizons = split_csv_ints(days if isinstance(days, str) else list(days))
    root = root.rstrip("/")
    _undo(spark, root)
    last, live = manifest.read_version(spark, _manifest(root))
    number = 0 if last is None else last + 1
    run = f"runs/{number:08d}-{dates[-1].isoformat()}"

    def write(df: DataFrame, name: str, *by: str) -> None:
        # The date stays in the files: its folder is read on its own.
        df.withColumn("day", F.col("snapshot_date")).write.partitionBy(*by, "day").parquet(f"{root}/{run}/{name}")

    # One pass writes good and rejected rows side by side.
    built = build_daily_snapshot(core, raw, dates, horizon_days)
    write(built.withColumn("rejected", F.col("reject_reason").isNotNull()), "built", "rejected")
    good = f"{run}/built/rejected=false"
    new_rows = spark.createDataFrame([], DAILY_SNAPSHOT)
    if manifest.exists(spark, f"{root}/{good}"):
        new_rows = spark.read.schema(DAILY_SNAPSHOT).option("recursiveFileLookup", "true").parquet(f"{root}/{good}")
    write(last_status(new_rows), "status")
    needed = {d - timedelta(days=n) for d in dates for n in horizons} - set(dates)
    past = read_daily(spark, root, SNAPSHOT, sorted(needed))
    write(pickup_metric(past.unionByName(new_rows), dates, horizons), "pickup")
    folders = {SNAPSHOT: good, REJECTED: f"{run}/built/rejected=true", STATUS: f"{run}/status", PICKUP: f"{run}/pickup"}
    new = {name: {**(live or {}).get(name, {})} for name in folders}
    for name, folder in folders.items():
        filled = manifest.names(spark, f"{root}/{folder}")
        for day in (d.isoformat() for d in dates):
            if f"day={day}" in filled:
                new[name][day] = f"{folder}/day={day}"
            else:
                new[name].pop(day, None)
    manifest.write_version(spark, _manifest(root), number, new)


def run_daily(
    spark: SparkSession, core: DataFrame, raw: DataFrame, root: str, day: date | None = None, **options
) -> date:
    """``backfill`` of one date (today in UTC if not given)."""
    day = day or datetime.now(timezone.utc).date()
    backfill(spark, core, raw, root, [day], **options)
    return day
