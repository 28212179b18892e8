"""Whole runs: find what is unread, transform it, write it, record progress.

Every run handles all its hours in one Spark plan with ``date_hour`` as a column.
The transformed rows are written once to a staging table in the shared scratch
folder; sinks, counts and alerts all read that table.  So every output sees the
same rows, nothing is computed twice, and a lost executor costs a task, not the
lineage back to the raw text.
"""

from __future__ import annotations

import uuid
from functools import partial
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import day_of
from ..functions.text import PACKET_SEPARATOR, RECORD_SEPARATOR
from ..operators.backlog import (
    FEWEST_HOURS_AFTER_WATERMARK, FEWEST_PENDING_HOURS, HASH_LEDGER_HORIZON_HOURS,
    HOUR_LEDGER_HORIZON_HOURS, LagAlert, backfill_hours, flag_unread, following_day, horizon,
    hours_after, lag_rows, next_day_hours, pending_hours, settled_before, unseen, with_unread_hours,
)
from ..operators.counts import ALERT_SCHEMA, alert_rows, hit_alerts, hour_counts, observe_routes
from ..operators.identity import (
    forward_entries, numeric_entries, resolve_by_distinct_keys, resolve_ids, reverse_entries,
    unresolved_keys,
)
from ..operators.project import envelope_json, interpret
from ..operators.route import PUBLISHED, QUARANTINE, UNRESOLVED, allow_users, early_allowlist, route
from ..profiles import GameProfile
from ..session import discard, prepare, scratch_path, scratch_scope
from ..sinks.publish import drop_other_runs, write_by_run, write_rows
from ..sources.identity import identity_buckets, merge_identity, read_identity
from ..sources.ledger import (
    append_hashes, bootstrap_hashes, read_hash_ledger, read_hour_ledger, read_watermark, replace_hour_cells,
    write_watermark,
)
from ..sources.listing import list_files, list_hours, raw_directory
from ..sources.runs import (
    FINISHED_SCHEMA, begin_runs, counting_rows, is_finished, read_runs, record_finished, taken_runs,
)
from ..sources.packets import packet_fields, parse_packets, read_lines, read_listed, read_records


Resolver = Callable[..., DataFrame]
# Called with the published rows and the name of the run.
Sink = Callable[[DataFrame, str], None]

# Called with the name of a run and its live counts.
Progress = Callable[[str, dict], None]

# Files a ledger run takes up in one go; a longer backlog takes several.  The list of one goes
# to every task, a few megabytes at this number.
SLICE_FILES = 50_000


class UnresolvedIds(RuntimeError):
    """Rows without an id, in a game whose policy is to stop on them."""


@dataclass(frozen=True)
class Layout:
    """Where one game's inputs, outputs and progress records live.

    ``partitioned`` says that raw hours are ``date=/hour=`` directories.
    """

    raw: str
    base: str
    partitioned: bool = False

    def raw_hours(self, hours: list[str]) -> list[str]:
        root = self.raw.rstrip("/")
        return [f"{root}/{raw_directory(hour, self.partitioned)}" for hour in hours]

    def listing(
        self, spark: SparkSession, parts: list[str], before: datetime | None = None
    ) -> DataFrame:
        return list_files(spark, self.raw, parts, self.partitioned, before)

    def __getattr__(self, name: str) -> str:
        if name in (
            "published", "unresolved", "quarantine", "counts", "alerts", "watermark",
            "hash_ledger", "hour_ledger", "planned", "stopped", "begun", "finished", "forward",
            "reverse", "numeric",
        ):
            return f"{self.base.rstrip('/')}/{name}"
        raise AttributeError(name)


def transform(
    parsed: DataFrame,
    profile: GameProfile,
    types: Mapping[str, str],
    identity: DataFrame,
    resolve: Resolver = resolve_ids,
    unique: bool = False,
) -> DataFrame:
    """Parsed packets to routed rows with their envelopes.

    ``resolve`` is ``resolve_ids``, one lazy plan, or ``resolve_by_distinct_keys``,
    which reads the packets twice but need not shuffle them.  ``unique`` says that
    ``identity`` has one row per key, as ``read_identity`` gives it.
    """
    return _routed(resolve(interpret(parsed, profile, types), identity, unique=unique), profile)


def lookup_side(
    spark: SparkSession, layout: Layout, resolve: Resolver = resolve_ids
) -> tuple[DataFrame, Resolver]:
    """The forward table as ``resolve`` takes it best: in its buckets for distinct players."""
    buckets = None
    if resolve is resolve_by_distinct_keys:
        buckets = identity_buckets(spark, layout.forward)
        resolve = partial(resolve, buckets=buckets)
    return read_identity(spark, layout.forward, bucketed=buckets is not None), resolve


def _routed(resolved: DataFrame, profile: GameProfile) -> DataFrame:
    return route(resolved).withColumns(
        {"game_id": F.lit(profile.game_id), "envelope": envelope_json(profile.game_id)}
    )


def stage(rows: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Write the rows once to the shared scratch folder and read them back."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def now_text() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def run_stamp() -> str:
    """A name for a run: the time, and something no other run has."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"


def _current_hour(now: str) -> str:
    return datetime.strptime(now, "%Y-%m-%d %H:%M:%S").strftime("%Y/%m/%d/%H")


def _write_alerts(layout: Layout, run: str, *alerts: DataFrame) -> None:
    rows = alerts[0]
    for more in alerts[1:]:
        rows = rows.unionByName(more)
    write_rows(rows, layout.alerts, run)


def _guarded(spark: SparkSession, layout: Layout, run: str, work: Callable):
    """Leave an alert row behind when a run fails, then let the failure out.

    Scratch tables of the run are dropped at its end.
    """
    prepare(spark)
    try:
        with scratch_scope(spark):
            return work()
    except LagAlert:
        raise
    except Exception as error:
        write_failure(spark, layout, run, "run", str(error))
        raise


def write_failure(spark: SparkSession, layout: Layout, run: str, stage: str, message: str) -> None:
    """Leave the alert row of a run or query that failed."""
    failed = spark.createDataFrame([(stage, "", "failed", 1, [message])], ALERT_SCHEMA)
    write_rows(failed, layout.alerts, f"{run}-failed")


def _sinks(
    layout: Layout, publish: Sink | Sequence[Sink] | None, gather: bool = True
) -> list[Sink]:
    """The given sinks, or the text by run alone."""
    if publish is None:
        return [text_sink(layout, gather)]
    return list(publish) if isinstance(publish, Sequence) else [publish]


def text_sink(layout: Layout, gather: bool = True) -> Sink:
    """Envelope text below ``published``; see ``write_by_run`` for ``gather``."""
    return lambda rows, run: write_by_run(rows, layout.published, run, gather)


def finish_run(
    routed: DataFrame,
    layout: Layout,
    profile: GameProfile,
    run: str,
    publish: Sink | Sequence[Sink] | None = None,
    gather: bool = True,
    progress: Progress | None = None,
) -> DataFrame:
    """Stage, check, publish, set aside, count.  Returns the counts per hour.

    ``progress`` is called with the name of the run and its rows by route, and the players
    among them that have no id, as soon as they are staged.  They are counted as rows pass,
    without a job of their own; a repeated task may count again, so records use the staged rows.

    The staging table holds each text once: the envelope is spliced around it on reading.
    It is dropped at the end, also when a step fails.

    In a game whose policy is to stop on unresolved rows these are parked below
    ``stopped`` and nothing is published.  ``register`` takes them up; the run, repeated
    under its name, then publishes all its rows and clears them.
    """
    spark = routed.sparkSession
    path = scratch_path(spark, "routed")
    rows = routed.drop("envelope")
    try:
        seen = None
        if progress is not None:
            rows, seen = observe_routes(rows, f"routes-{uuid.uuid4().hex}")
        rows.write.partitionBy("route").parquet(path)
        if seen is not None:
            progress(run, seen.get)
        staged = spark.read.schema(rows.schema).parquet(path)
        staged = staged.withColumn("envelope", envelope_json(F.col("game_id")))
        unresolved = staged.where(F.col("route") == UNRESOLVED)
        write_rows(hour_counts(staged), layout.counts, run)
        _write_alerts(
            layout, run, alert_rows(staged, "ingest"), hit_alerts(unresolved, "ingest")
        )
        parked = unresolved.drop("route", "envelope", "goc_id")
        if profile.on_unresolved == "fail":
            write_rows(parked, layout.stopped, run)
            if not unresolved.isEmpty():
                raise UnresolvedIds(f"rows without an id, see {layout.alerts}/run={run}")
        for sink in _sinks(layout, publish, gather):
            sink(staged.where(F.col("route") == PUBLISHED), run)
        write_rows(parked, layout.unresolved, run)
        write_rows(
            staged.where(F.col("route") == QUARANTINE).select(
                "date_hour", "event_name", "ts", "reason", "packet"
            ),
            layout.quarantine,
            run,
        )
    finally:
        discard(spark, path)
    return spark.read.parquet(f"{layout.counts}/run={run}")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # nothing there, or folders of runs that wrote no file
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class Framing:
    """How packets lie in the files: by lines, or by records where ``record`` is set.

    ``partitions`` deals the lines out anew, for files no two tasks can share.  ``early``
    keeps the allowlisted types before anything else is parsed, where a line is a packet;
    text that is not JSON is then dropped instead of set aside.
    """

    separator: str | None = PACKET_SEPARATOR
    record: str | None = None
    partitions: int | None = None
    early: bool = False

    def __post_init__(self) -> None:
        if self.early and self.separator is not None:
            raise ValueError("early needs one packet per line or record")

    def parse(
        self,
        spark: SparkSession,
        paths: list[str],
        profile: GameProfile,
        types: Mapping[str, str],
    ) -> DataFrame:
        lines = (
            read_lines(spark, paths, self.partitions) if self.record is None
            else read_records(spark, paths, self.record, self.partitions)
        )
        return self.packets(lines, profile, types)

    def parse_listed(
        self,
        spark: SparkSession,
        layout: Layout,
        files: DataFrame,
        hours: list[str],
        profile: GameProfile,
        types: Mapping[str, str],
    ) -> DataFrame:
        lines = read_listed(
            spark, layout.raw, files, hours, layout.partitioned, self.record, self.partitions
        )
        return self.packets(lines, profile, types)

    def packets(
        self, lines: DataFrame, profile: GameProfile, types: Mapping[str, str]
    ) -> DataFrame:
        if self.early:
            lines = early_allowlist(lines, profile.event_names).drop("event_type")
        return parse_packets(lines, packet_fields(profile, types), self.separator)


LINES = Framing()
RECORDS = Framing(separator=None, record=RECORD_SEPARATOR)


# -- runs by watermark -------------------------------------------------------


def watermark_run(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    now: str | None = None,
    publish: Sink | Sequence[Sink] | None = None,
    framing: Framing = LINES,
    resolve: Resolver = resolve_ids,
    gather: bool = True,
    progress: Progress | None = None,
) -> DataFrame:
    """Read the whole hours behind the watermark, then advance it.

    Hours are published whole and take the place of what earlier runs published for them.  A
    run that stopped before its output counted is repeated; one that stopped after that
    just moves the watermark.
    """
    now = now or now_text()
    mark = read_watermark(spark, layout.watermark)
    run = f"after-{mark.replace('/', '')}"

    def advance() -> DataFrame:
        own = read_runs(spark, layout.finished, FINISHED_SCHEMA).where(F.col("run") == run)
        hours = sorted(r.date_hour for r in own.where("date_hour IS NOT NULL AND took IS NULL").collect())
        drop_other_runs(spark, layout.published, run, hours)
        write_watermark(spark, hours[-1], layout.watermark)
        return spark.read.parquet(f"{layout.counts}/run={run}")

    def work() -> DataFrame:
        if is_finished(spark, layout.finished, run):
            return advance()
        days = [mark[:10], following_day(mark[:10])]
        listed = list_hours(layout.listing(spark, days))
        # two days hold at most 48 hours: listed once, then planned from memory
        hours = spark.createDataFrame(listed.collect(), "date_hour string")
        waiting = hours_after(next_day_hours(hours, mark), mark)
        due = pending_hours(hours, mark, _current_hour(now))
        lag = lag_rows(waiting, FEWEST_HOURS_AFTER_WATERMARK, "plan").unionByName(
            lag_rows(due, FEWEST_PENDING_HOURS, "plan")
        )
        if not lag.isEmpty():
            write_rows(lag, layout.alerts, f"{run}-lag")
            raise LagAlert(f"too few hours wait behind {mark}")
        pending = sorted(r.date_hour for r in due.collect())
        begin_runs(spark, layout.begun, layout.finished, [run], "watermark")
        parsed = framing.parse(spark, layout.raw_hours(pending), profile, types)
        _finish(spark, parsed, layout, profile, types, run, publish, resolve, gather, progress)
        record_finished(spark, layout.finished, run, "watermark", pending)
        return advance()

    return _guarded(spark, layout, run, work)


def _finish(
    spark, parsed, layout, profile, types, run, publish, resolve, gather, progress=None
) -> DataFrame:
    identity, resolve = lookup_side(spark, layout, resolve)
    routed = transform(parsed, profile, types, identity, resolve, unique=True)
    return finish_run(routed, layout, profile, run, publish, gather, progress)


def backfill_run(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    first_day: str,
    last_day: str,
    watermark: str | None = None,
    users: DataFrame | None = None,
    publish: Sink | Sequence[Sink] | None = None,
    framing: Framing = LINES,
    resolve: Resolver = resolve_ids,
    run: str | None = None,
    gather: bool = True,
    progress: Progress | None = None,
) -> DataFrame:
    """Read days again, for all users or for those in a list.

    For all users the hours are whole: they take the place of what earlier runs published
    for them.  A list-bound correction covers parts of hours, so it is added as a run of its
    own and leaves the hours' earlier output alone.  ``users`` has a column named as the
    profile's ``lookup_field``, or else ``user_id``.  ``run`` must be a new name, or that of a
    backfill that did not finish.
    """
    run = run or run_stamp()

    def work() -> DataFrame:
        begin_runs(spark, layout.begun, layout.finished, [run], "backfill")
        wanted = backfill_hours(spark, first_day, last_day, watermark)
        hours = [r.date_hour for r in wanted.collect()]
        listing = layout.listing(spark, hours)
        present = sorted(r.date_hour for r in list_hours(listing).collect())
        paths = layout.raw_hours(present)
        if not paths:
            raise LagAlert(f"no hour of {first_day} to {last_day} has files")
        parsed = framing.parse(spark, paths, profile, types)
        if users is not None:
            key = profile.lookup_field
            parsed = allow_users(parsed, users, key, key if key in users.columns else "user_id")
        counts = _finish(spark, parsed, layout, profile, types, run, publish, resolve, gather, progress)
        whole = present if users is None else []
        record_finished(spark, layout.finished, run, "backfill", whole)
        drop_other_runs(spark, layout.published, run, whole)
        return counts

    return _guarded(spark, layout, run, work)


# -- runs by ledger ------------------------------------------------------------
#
# The files of a run are written down before the run starts (``planned``), with a
# note of the run's name, and the ledger is written after its output.  If the noted
# run is not all in the ledger it is repeated first, under its own name and with
# its own files, which replaces whatever it had already written.


def seed_hash_ledger(
    spark: SparkSession,
    layout: Layout,
    watermark: str | None = None,
    horizon_hours: int = HASH_LEDGER_HORIZON_HOURS,
    mode: str = "overwrite",
) -> None:
    """Enter the files of the hours up to the watermark as read, before a first run."""
    mark = watermark or read_watermark(spark, layout.watermark)
    bootstrap_hashes(
        layout.listing(spark, horizon(mark, horizon_hours)), layout.hash_ledger, mode
    )


def hash_ledger_run(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    now: str | None = None,
    horizon_hours: int = HASH_LEDGER_HORIZON_HOURS,
    until: str | None = None,
    publish: Sink | Sequence[Sink] | None = None,
    framing: Framing = LINES,
    resolve: Resolver = resolve_ids,
    run: str | None = None,
    settle_minutes: int | None = None,
    slice_files: int = SLICE_FILES,
    gather: bool = True,
    progress: Progress | None = None,
) -> list[str]:
    """Read the files of the last hours whose path hash is not in the ledger.

    The hours end with ``until`` ("yyyy/MM/dd/HH"), by default with the present one.
    Files must arrive by rename, or ``settle_minutes`` must say how long one that is still
    being copied may go unchanged; else its rest would never be read.
    """
    now = now or now_text()
    until = until or _current_hour(now)
    planned = f"{layout.planned}/by_hash"

    def ledger(days: list[str]) -> DataFrame:
        return read_hash_ledger(spark, layout.hash_ledger, days)

    def plan() -> DataFrame:
        hours = horizon(until, horizon_hours)
        before = None if settle_minutes is None else settled_before(now, settle_minutes)
        listing = layout.listing(spark, hours, before)
        files = unseen(listing, ledger(sorted({h[:10] for h in hours})))
        return files.withColumn("processed", F.lit(False))

    def left(files: DataFrame) -> DataFrame:
        return unseen(files, ledger(_days_of(files)))

    def record(files: DataFrame) -> None:
        append_hashes(left(files), layout.hash_ledger)

    return _ledger_run(
        spark, layout, profile, types, planned, plan, left, record, publish, framing, resolve, run,
        slice_files, gather, progress,
    )


def _days_of(files: DataFrame) -> list[str]:
    """Days of a run's files: at most those of its horizon."""
    return [r.day for r in files.select(day_of("date_hour").alias("day")).distinct().collect()]


def hour_ledger_run(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    types: Mapping[str, str],
    now: str | None = None,
    horizon_hours: int = HOUR_LEDGER_HORIZON_HOURS,
    until: str | None = None,
    publish: Sink | Sequence[Sink] | None = None,
    framing: Framing = LINES,
    resolve: Resolver = resolve_ids,
    run: str | None = None,
    slice_files: int = SLICE_FILES,
    gather: bool = True,
    progress: Progress | None = None,
) -> list[str]:
    """Read the settled files of the last hours that their hour's cell lacks.

    The hours end with ``until`` ("yyyy/MM/dd/HH"), by default with the present one.
    """
    now = now or now_text()
    until = until or _current_hour(now)
    planned = f"{layout.planned}/by_hour"

    def plan() -> DataFrame:
        hours = horizon(until, horizon_hours)
        listing = layout.listing(spark, hours, settled_before(now))
        cells = read_hour_ledger(
            spark, layout.hour_ledger, sorted({h[:10] for h in hours})
        )
        return with_unread_hours(flag_unread(listing, cells))

    def left(files: DataFrame) -> DataFrame:
        cells = read_hour_ledger(spark, layout.hour_ledger, _days_of(files))
        return flag_unread(files.drop("processed"), cells).where("NOT processed")

    def record(files: DataFrame) -> None:
        replace_hour_cells(files, layout.hour_ledger)

    return _ledger_run(
        spark, layout, profile, types, planned, plan, left, record, publish, framing, resolve, run,
        slice_files, gather, progress,
    )


def _ledger_run(
    spark, layout, profile, types, planned, plan, left, record, publish, framing, resolve, run,
    slice_files, gather, progress,
) -> list[str]:
    finished = []

    def complete(name: str) -> None:
        files = _planned(spark, planned, name)
        unread = files.where("NOT processed")
        hours = sorted(r.date_hour for r in unread.select("date_hour").distinct().collect())
        if hours:
            if not is_finished(spark, layout.finished, name):
                parsed = framing.parse_listed(spark, layout, unread, hours, profile, types)
                _finish(spark, parsed, layout, profile, types, name, publish, resolve, gather, progress)
                record_finished(spark, layout.finished, name, "ledger")
            record(files)
            finished.append(name)

    note = f"{planned}_current"

    def begin(name: str) -> list[str]:
        """Write down the slices of a new run, and their names."""
        begin_runs(spark, layout.begun, layout.finished, [name], "ledger")
        files = stage(plan(), "planned")
        slices = _slices(files, slice_files)
        names = [name if i == 0 else f"{name}-{i + 1}" for i in range(len(slices))]
        begin_runs(spark, layout.begun, layout.finished, names, "ledger")
        for part, piece in zip(names, slices):
            write_rows(piece.of(files), planned, part)
        write_watermark(spark, ",".join(names), note)
        return names

    name = run or run_stamp()
    for old in _guarded(spark, layout, name, lambda: _unfinished(spark, planned, note, left)):
        _guarded(spark, layout, old, lambda old=old: complete(old))
    if name not in finished:
        for part in _guarded(spark, layout, name, lambda: begin(name)):
            _guarded(spark, layout, part, lambda part=part: complete(part))
    return finished


def _planned(spark: SparkSession, planned: str, name: str) -> DataFrame:
    """The files of a run as it wrote them down."""
    return spark.read.parquet(planned).where(F.col("run").cast("string") == name).drop("run")


@dataclass(frozen=True)
class _Slice:
    """Whole hours, or one of the pieces of an hour that has too many unread files.

    Pieces are read one after another: those before count as read, those after are left out.
    So a cell that is replaced holds what has been read by then.
    """

    hours: list[str]
    piece: int = 0
    pieces: int = 1

    def of(self, files: DataFrame) -> DataFrame:
        rows = files.where(F.col("date_hour").isin(self.hours))
        if self.pieces == 1:
            return rows
        place = F.pmod(F.xxhash64("path"), F.lit(self.pieces))
        return rows.where(F.col("processed") | (place <= self.piece)).withColumn(
            "processed", F.col("processed") | (place < self.piece)
        )


def _slices(files: DataFrame, slice_files: int) -> list[_Slice]:
    """The unread files in order of hours, about as many to a slice as it may hold."""
    counts = (
        files.groupBy("date_hour").agg(F.count_if(~F.col("processed")).alias("n")).orderBy("date_hour")
    )
    slices: list[_Slice] = []
    held = 0
    for row in counts.collect():  # a row per hour of the horizon
        if row.n > slice_files:
            pieces = -(-row.n // slice_files)
            slices += [_Slice([row.date_hour], i, pieces) for i in range(pieces)]
            held = slice_files
        elif not slices or held + row.n > slice_files:
            slices.append(_Slice([row.date_hour]))
            held = row.n
        else:
            slices[-1].hours.append(row.date_hour)
            held += row.n
    return slices


def _unfinished(spark: SparkSession, planned: str, note: str, left) -> list[str]:
    """The noted runs of which the ledger lacks files."""
    try:
        names = read_watermark(spark, note).split(",")
    except (AnalysisException, ValueError) as error:
        if isinstance(error, ValueError) or error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    found = []
    for name in filter(None, names):
        files = _planned(spark, planned, name)
        if not left(files.where("NOT processed")).isEmpty():
            found.append(name)
    return found


# -- registration and replay -----------------------------------------------------


def _parked(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Parked rows that count and that no finished replay has taken up."""
    parked = _read_or_none(spark, layout.unresolved)
    if parked is None:
        return None
    parked = counting_rows(spark, layout.finished, parked.withColumn("run", F.col("run").cast("string")))
    return parked.join(taken_runs(spark, layout.finished), "run", "left_anti")


def published_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """value, run, date_hour: the published text that counts, each row of it once.

    Safe to read at any time: a run's rows are seen when it is finished, and those of the
    runs whose hours it replaces are not seen from then on.
    """
    try:
        text = spark.read.schema("value string, run string, date string, hour string").text(layout.published)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, run string, date_hour string")
    rows = text.select(
        "value", "run", F.concat_ws("/", F.translate("date", "-", "/"), "hour").alias("date_hour")
    )
    return counting_rows(spark, layout.finished, rows, text=True)


def parked_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows that wait for an id: those to be replayed and those of runs that stopped."""
    columns = ["run", "player_key", "user_id", "numeric_user_id", "date_hour"]
    rows = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    stopped = _read_or_none(spark, layout.stopped)
    if stopped is not None:
        rows = rows.unionByName(stopped.withColumn("run", F.col("run").cast("string")).select(columns))
    waiting = _parked(spark, layout)
    return rows if waiting is None else rows.unionByName(waiting.select(columns))


def register(
    spark: SparkSession, layout: Layout, assigned: DataFrame, seq: int, runs: list[str] | None = None
) -> None:
    """Enter newly assigned ids into the three identity tables.

    ``assigned`` has ``player_id`` and ``goc_id``, as an id service returned them
    for the worklist.  Entering the same ids again changes nothing.
    """

    def work() -> None:
        parked = parked_rows(spark, layout)
        if runs is not None:
            parked = parked.where(F.col("run").isin(runs))
        worklist = stage(unresolved_keys(parked), "worklist")
        for kind, entries, path in (
            ("forward", forward_entries, layout.forward),
            ("reverse", reverse_entries, layout.reverse),
            ("numeric", numeric_entries, layout.numeric),
        ):
            merge_identity(entries(worklist, assigned, seq), path, kind)

    _guarded(spark, layout, f"register-{seq}", work)


def replay(
    spark: SparkSession,
    layout: Layout,
    profile: GameProfile,
    run: str,
    publish: Sink | Sequence[Sink] | None = None,
    gather: bool = True,
) -> DataFrame:
    """Publish parked rows whose players have an id by now; park the rest again.

    Repeat a replay that stopped half-way under the same ``run``; another needs a new name.
    """

    def work() -> DataFrame:
        begin_runs(spark, layout.begun, layout.finished, [run], "replay")
        parked = _parked(spark, layout)
        if parked is None:
            raise LagAlert("nothing was parked yet")
        parked = stage(parked, "parked")
        identity = read_identity(spark, layout.forward)
        routed = _routed(resolve_ids(parked.drop("run"), identity, unique=True), profile)
        taken = stage(parked.select("run").distinct(), "taken")
        counts = finish_run(routed, layout, profile, run, publish, gather)
        record_finished(spark, layout.finished, run, "replay", took=taken)
        return counts

    return _guarded(spark, layout, run, work)
