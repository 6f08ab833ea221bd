"""The streaming jobs, one query per table, and the batch jobs beside them.

Raw, fact and aggregate tables are kept by separate queries that follow each
other's change logs.  Each query handles its micro-batch with the same
functions the batch plans use.  An aggregate adds the signed deltas of its facts
to a keyed state of its own (``operators.deltas``) and reads no fact again; that is exact
for distinct counts, corrections and deletes, however late they come, and
needs no watermark and no state expiry.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shoplake import schemas
from shoplake.operators import change_rows, changelog, deltas, files, gate, lateness
from shoplake.operators.lake import Lake, empty
from shoplake.operators.lateness import Watermark
from shoplake.operators.measures import Stats
from shoplake.operators.sinks import (
    NO_DAY,
    append_log,
    current_version,
    fold_partitioned,
    log_changes,
    log_transitions,
    multi_sink,
    overwrite_days,
    overwrite_snapshot,
    read_parts,
    upsert_partitioned,
    with_bucket,
)
from shoplake.plans import dim, dws, ods
from shoplake.plans.warehouse import REFRESHED, RULES, Warehouse
from shoplake.session import tune
from shoplake.sources import cdc_stream, change_stream, json_log_stream

KEYED_DIMS = ("coupon_info", "sku_info", "spu_info", "user_info")
KEYED_FACTS = tuple(t for t in ods.KEYS if t in schemas.BUSINESS_TABLES)
APPENDED = ("order_status_log", *schemas.LOG_TABLES)

# A micro-batch and its name: the stream's id and the batch number, which another checkpoint cannot repeat.
Handler = Callable[[DataFrame, str], None]


class Jobs:
    """Starts jobs on a lake.

    ``trigger`` is passed to every stream: ``{"processingTime": "10 seconds"}``
    keeps running, ``{"availableNow": True}`` works off what is there and stops.
    """

    _shapes: dict[str, list[tuple[str, str]]] = {}

    def __init__(self, lake: Lake, trigger: dict | None = None, max_files: int | None = None) -> None:
        self.lake, self.spark = lake, lake.spark
        self.trigger = trigger or {"processingTime": "10 seconds"}
        self.max_files = max_files

    # --- batch ---------------------------------------------------------------

    def load_snapshot(self, table: str, rows: DataFrame, position: tuple[int, ...] | None = None) -> None:
        """Replace a raw base table with a whole snapshot.

        With ``position``, the place in the source's log (file, place and perhaps row) at which the snapshot was taken, the
        table goes over to its log: the rows are logged as changes made there, rows that are stored but missing from the
        snapshot are deleted there, and :meth:`ingest_changes` leaves out what the log says up to there.
        """
        name, new = f"ods.{table}", ods.load(table, rows)
        if position is None:
            overwrite_snapshot(new, self.lake.path(name))
            return
        place = (*position, 0)[:3]
        at, keys = changelog.position(*place), ods.KEYS[table]
        files.make(self.spark, f"{self.lake.path(name)}/_mark/{'-'.join(map(str, place))}")
        state = new.withColumn("_op", F.lit("U"))
        had = self.lake.stored(name)
        if had is not None:
            same = reduce(lambda a, b: a & b, [had[k].eqNullSafe(new[k]) for k in keys])
            state = state.unionByName(had.join(new, same, "left_anti").withColumn("_op", F.lit("D")))
        state = state.withColumn("_ts", F.lit(0).cast("bigint")).withColumn("_seq", at)
        self._fold(name, state, f"snapshot.{'-'.join(map(str, place))}", keys)

    def _mark(self, name: str) -> Column:
        """The position of the newest snapshot that has one; one before all others if there is none."""
        marks = [tuple(map(int, n.split("-"))) for n in files.subdirectories(self.spark, f"{self.lake.path(name)}/_mark")]
        return changelog.position(*max(marks, default=(-1, -1, -1)))

    def build(self, name: str) -> None:
        """Compute a table from the stored tables below it and replace it (dimensions)."""
        build, inputs = RULES[name]
        overwrite_snapshot(build(*[self._input(i) for i in inputs]), self.lake.path(name))

    def build_dims(self) -> None:
        for table in ("base_brand", "base_dic", "base_region", "base_category", *KEYED_DIMS):
            self.build(f"dim.{table}")

    def refresh(self, tables: Sequence[str] = REFRESHED, days: Sequence[str | None] | None = None) -> None:
        """Recompute the scheduled aggregates: in full, or only for the given days.

        Every one of them has the day in its key, so the days whose facts have
        changed can be recomputed alone; only their partitions are read and replaced.  None is the day of facts without one.
        """
        for table in tables:
            build, inputs = RULES[f"dws.{table}"]
            facts = [self._input(i) for i in inputs]
            if days is not None:
                facts = [f.where(_in_days(days)) for f in facts]
            overwrite_days(build(*facts), self.lake.path(f"dws.{table}"), whole=days is None)

    def refresh_changed(self, tables: Sequence[str] = REFRESHED) -> dict[str, list[str]]:
        """Recompute the days of the scheduled aggregates whose facts have changed since the last time; returns them.

        Streams note the days they touch in a ledger.  What is in it before the facts are read is taken off afterwards, so a day
        that changes meanwhile, or a run that dies, is taken up by the next one.  A day left without rows is deleted.
        """
        done = {}
        for table in tables:
            ledger, path = self.lake.path(f"ledger.{table}"), self.lake.path(f"dws.{table}")
            noted = {d: files.subdirectories(self.spark, f"{ledger}/{d}") for d in files.subdirectories(self.spark, ledger)}
            days = sorted(d for d, batches in noted.items() if batches)
            if days:
                asked = [None if d == NO_DAY else d for d in days]
                self.refresh([table], asked)
                facts = [self._input(i).where(_in_days(asked)).select("dt") for i in RULES[f"dws.{table}"][1]]
                there = {r.dt or NO_DAY for r in reduce(DataFrame.union, facts).distinct().collect()}  # at most the changed days
                for day in set(days) - there:
                    files.remove(self.spark, f"{path}/dt={day}")
            for day, batches in noted.items():
                for batch in batches:
                    files.remove(self.spark, f"{ledger}/{day}/{batch}")
            done[table] = days
        return done

    def warehouse(self, **days) -> Warehouse:
        """Views and reports over the stored tables."""
        return Warehouse(lambda name: self.lake.stored(name) if not name.startswith("raw.") else None, **days)

    def _input(self, name: str) -> DataFrame:
        """A stored table; an empty one where nothing is stored yet.

        A dimension that was not built is computed from the raw tables there are.
        """
        found = self.lake.stored(name)
        if found is not None:
            return found
        if name.startswith("dim."):
            build, inputs = RULES[name]
            tables = [self._input(i) for i in inputs]
            if any(self.lake.stored(i) is not None for i in inputs):
                return build(*tables)
        return self.spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in self._shape(name)))

    # --- raw -----------------------------------------------------------------

    def ingest_changes(self, table: str, source: str | dict, **start) -> StreamingQuery:
        """Row changes of a source table into the raw table."""
        records = cdc_stream(self.spark, table, source, max_files=self.max_files, **start)
        name = f"ods.{table}"
        if current_version(self.spark, self.lake.path(name)):
            raise ValueError(f"{name} is a snapshot without a position in the log: load it with one")
        if table == "order_status_log":
            inserted = records.where(F.col("op").isin("r", "c")).select("after.*")
            return self._start(name, inserted, lambda rows, n: self._append(name, ods.load(table, rows), n, "id"))
        keys = ods.KEYS[table]
        time = ods.event_time(table)

        def fold(rows: DataFrame, n: str) -> None:
            # Only a place can tell that a record is older than the snapshot.
            later = rows.where(F.col("seq.pos").isNull() | (F.col("seq") > self._mark(name)))
            self._fold(name, change_rows(later, keys, time), n, keys)

        return self._start(name, records, fold)

    def ingest_log(
        self,
        table: str,
        source: str | dict,
        watermark: Watermark | None = None,
        event_key: Sequence[str] | None = None,
        bad_rows: float | None = None,
    ) -> StreamingQuery:
        """JSON log records into the raw log table.

        * By default every record that can be read is kept, however late, and others are dropped without notice.
        * ``watermark`` notes late rows beside the table (:meth:`late`) and may keep them out of it.
        * ``event_key`` names the columns that tell events apart.  An event that comes again within the watermark's delay is
          left out by the stream's state, which also drops rows later than that, so choose it long; rows without a time are
          compared within their batch only.  A stream that lost its checkpoint leaves out what the table has.
        * ``bad_rows`` is the share of bad records a batch may have.  They go to a quarantine (:meth:`quarantined`), more of
          them stop the stream.
        """
        name, time = f"ods.{table}", ods.event_time(table)
        rows = json_log_stream(self.spark, table, source, self.max_files, checked=bad_rows is not None)
        if watermark or event_key:
            delay = (watermark or Watermark()).delay
            # The engine's marks need a time with a zone; the column itself stays as it is.
            rows = rows.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
        if event_key:
            rows = rows.dropDuplicatesWithinWatermark(list(event_key))

        def take(batch: DataFrame, n: str) -> None:
            batch = batch.drop("_time")
            if bad_rows is not None:
                batch = gate.gated(batch, "_bad", self.lake.path(f"quarantine.{table}"), n, bad_rows).drop("_text")
            if watermark:
                late = lateness.before(self.spark, self.lake.path(f"late.{table}"), n)
                batch = lateness.judged(batch, time, late)
                lateness.side_output(batch, time, late, watermark)
                batch = (batch.where("not _late") if watermark.drop else batch).drop("_late")
            self._append(name, ods.load(table, batch), n, event_key=event_key)

        def once(batch: DataFrame, n: str) -> None:
            batch.persist()
            try:
                take(batch, n)
            finally:
                batch.unpersist()

        return self._start(name, rows, once)

    def late(self, table: str) -> tuple[DataFrame | None, DataFrame]:
        """Late rows of a log that is read with a watermark, and mark, rows and late rows of each of its batches."""
        path = self.lake.path(f"late.{table}")
        return self._aside(path), lateness.counts(self.spark, path)

    def quarantined(self, table: str) -> DataFrame | None:
        """Bad rows of a log or an aggregate, with ``_bad``, the reasons; None if none was ever set aside."""
        return self._aside(self.lake.path(f"quarantine.{table}"))

    def _aside(self, path: str) -> DataFrame | None:
        return self.spark.read.orc(path).drop("batch") if files.subdirectories(self.spark, path) else None

    # --- dimensions ----------------------------------------------------------

    def keep_dim(self, table: str) -> StreamingQuery:
        """Follow the raw tables of a dimension and keep it.

        A changed row reaches the rows that name it, a category also those below it; these are built again from the raw
        tables and replaced in a new version of the dimension, so a reader sees the old or the new one.
        """
        name, links = f"dim.{table}", dim.LINKS.get(table, {})
        logs = [self._follow_changes(f"ods.{t}").select(F.lit(t).alias("of"), "id") for t in (table, *links)]

        def update(rows: DataFrame, n: str) -> None:
            rows = rows.dropna().distinct().persist()
            try:
                if not rows.isEmpty():
                    self._rebuild(name, table, self._reached(table, rows))
            finally:
                rows.unpersist()

        return self._start(name, reduce(DataFrame.union, logs), update)

    def _reached(self, table: str, changed: DataFrame) -> DataFrame:
        """Ids of the dimension's rows that changed raw rows (of, id) have a say in."""
        own, tree = self._input(f"ods.{table}"), self._input("ods.base_category")

        def ids(of: str) -> DataFrame:
            hit = changed.where(F.col("of") == of).select("id")
            return dim.below(tree, hit) if of == "base_category" else hit

        out = ids(table)
        for source, column in dim.LINKS.get(table, {}).items():
            hit = ids(source).withColumnRenamed("id", "_hit")
            out = out.union(own.join(hit, F.col(column) == F.col("_hit"), "left_semi").select("id"))
        return out.distinct()

    def _rebuild(self, name: str, table: str, ids: DataFrame) -> None:
        build, inputs = RULES[name]
        own, old = self._input(f"ods.{table}"), self.lake.stored(name)
        rows = own if old is None else own.join(ids, "id", "left_semi")
        if table == "base_category":
            new = build(rows, own)
        else:
            # Categories come from the raw table, which is never behind its log; the dimension may be.
            tree = RULES["dim.base_category"][0]
            others = [tree(self._input("ods.base_category")) if i == "dim.base_category" else self._input(i) for i in inputs[1:]]
            new = build(rows, *others)
        if old is not None:
            new = old.join(ids, "id", "left_anti").unionByName(new)
        overwrite_snapshot(new, self.lake.path(name))

    # --- facts ---------------------------------------------------------------

    def enrich(self, table: str) -> StreamingQuery:
        """Follow a raw table and keep its fact table.

        Dimensions are read again for every micro-batch; facts already written
        keep the values they got.
        """
        name, source = f"dwd.{table}", f"ods.{table}"
        build, (_, *dims) = RULES[name]

        def enriched(rows: DataFrame) -> DataFrame:
            return build(rows, *[self._input(d) for d in dims])

        if table in APPENDED:
            key = "id" if table == "order_status_log" else "mid"
            return self._start(
                name, self._follow_appends(source), lambda rows, n: self._append(name, enriched(rows), n, key)
            )
        keys = ods.KEYS[table]
        # The fact table knows what its rows were, so the source's old images need no lookups.
        states = self._follow_changes(source).where(F.col("_op") != "B")
        return self._start(name, states, lambda rows, n: self._fold(name, enriched(rows), n, keys))

    # --- aggregates ----------------------------------------------------------

    def aggregate(self, table: str) -> StreamingQuery:
        """Follow the fact tables of an aggregate and keep the groups they touch up to date."""
        name, stats = f"dws.{table}", dws.STATS[table]
        changed = []
        for fact in stats.sources:
            if fact in APPENDED:
                rows, sign = self._follow_appends(f"dwd.{fact}"), F.lit(1)
            else:
                rows, sign = self._follow_changes(f"dwd.{fact}"), F.when(F.col("_op") == "U", 1).otherwise(-1)
            changed.append(deltas.signed(rows, stats, fact, sign))

        def add(rows: DataFrame, n: str) -> None:
            rows.persist()
            try:
                self._add(name, stats, rows, n)
            finally:
                rows.unpersist()

        return self._start(name, reduce(DataFrame.unionByName, changed), add)

    def _add(self, name: str, stats: Stats, rows: DataFrame, n: str) -> None:
        """Add a batch of signed rows to an aggregate's state, then replace the groups it touched."""
        stream, _, number = n.rpartition(".")
        state, batch, parts_by = self.lake.path(f"state.{name}"), int(number), ["dt", "bucket"]
        self._own(state, stream)
        cells = deltas.cell_deltas(rows, stats)
        if stats.distinct:
            # By value, so that a hot group is spread over all buckets.
            keys = [*stats.keys, "of", "value"]
            values = with_bucket(deltas.value_deltas(rows, stats), keys, self.lake.buckets)
            seen = self._fold_state(values, f"{state}/values", [*keys, "bucket"], ["n"], parts_by, n, batch)
            if seen is not None:
                cells = cells.unionAll(deltas.as_cells(deltas.steps(seen, stats, batch), cells, stats))
        cells = with_bucket(cells, stats.keys[0], self.lake.buckets)
        keys, counters = [*stats.keys, *stats.attrs, "bucket"], ["n", *stats.types, *stats.distinct]
        known = self._fold_state(cells, f"{state}/cells", keys, counters, parts_by, n, batch)
        if known is None:
            return
        groups = deltas.groups(known.repartition(*stats.keys), stats, batch)
        groups = groups.withColumn("_ts", F.lit(0).cast("bigint")).withColumn("_seq", changelog.position(0, 0)).persist()
        try:
            good = gate.gated(groups, "_bad", self.lake.path(f"quarantine.{name.partition('.')[2]}"), n)
            good = with_bucket(good, stats.keys[0], self.lake.buckets)

            def replaced(current: DataFrame | None, new: DataFrame) -> DataFrame:
                # There is one new row for each group, and it wins whatever is stored, so nothing has to be ranked.
                if current is None:
                    return new
                return current.join(new.select(*stats.keys), list(stats.keys), "left_anti").select(*new.columns).unionAll(new)

            fold_partitioned(good, self.lake.path(name), parts_by, n, replaced, good.schema)
        finally:
            groups.unpersist()

    def _fold_state(
        self, rows: DataFrame, path: str, keys: list[str], counters: list[str], parts_by: list[str], n: str, batch: int
    ) -> DataFrame | None:
        """Add deltas to a state table; its rows in the partitions they touched, None if there were none."""
        kept = rows.select(*[c for c in keys if c not in parts_by], *counters, F.lit(0).cast("bigint").alias("_before"),
                           F.lit(0).cast("bigint").alias("_batch"), *parts_by)

        def merge(current: DataFrame | None, batch_rows: DataFrame) -> DataFrame:
            repeated = current is not None and not current.where(F.col("_batch") == batch).isEmpty()
            return deltas.folded(current, batch_rows, keys, counters, batch, repeated)

        parts = fold_partitioned(rows, path, parts_by, n, merge, kept.schema)
        return read_parts(self.spark, path, kept.schema, parts, parts_by) if parts else None

    def _own(self, state: str, stream: str) -> None:
        """State that another stream began, whose progress is lost, is dropped: this one sees every change from the first on."""
        others = [w for w in files.subdirectories(self.spark, f"{state}/_writers") if w != stream]
        if others:
            files.remove(self.spark, state)
        files.make(self.spark, f"{state}/_writers/{stream}")

    # --- all -----------------------------------------------------------------

    def run_once(
        self,
        changes: Mapping[str, str | dict],
        logs: Mapping[str, str | dict],
        aggregates: Sequence[str] = tuple(dws.STATS),
    ) -> None:
        """Work off everything that has arrived, layer by layer.

        ``changes`` and ``logs`` map source tables to their sources.  Dimensions that a changed table reaches are kept
        too.  The tables of
        one layer are independent and run side by side; a layer starts when the one
        below has finished, so no job reads a table another one is rewriting.
        """
        once = Jobs(self.lake, {"availableNow": True}, self.max_files)
        raw = [once.ingest_changes(t, s) for t, s in changes.items()] + [once.ingest_log(t, s) for t, s in logs.items()]
        await_all(raw)
        await_all([once.keep_dim(t) for t in schemas.BASE_TABLES if {t, *dim.LINKS.get(t, {})} & set(changes)])
        facts = [t for t in (*changes, *logs) if t in (*KEYED_FACTS, *APPENDED)]
        await_all([once.enrich(t) for t in facts])
        sources = {f"dwd.{t}" for t in facts}
        await_all([once.aggregate(t) for t in aggregates if sources & set(RULES[f"dws.{t}"][1])])

    # --- shared --------------------------------------------------------------

    def _start(self, name: str, rows: DataFrame, handle: Handler) -> StreamingQuery:
        checkpoint = self.lake.checkpoint(name)

        def each(batch: DataFrame, batch_id: int) -> None:
            tune(batch.sparkSession)  # streams switch adaptive execution off
            stream = json.loads(files.text(self.spark, f"{checkpoint}/metadata"))["id"]
            handle(batch, f"{stream}.{batch_id}")

        writer = rows.writeStream.foreachBatch(each).queryName(name.replace(".", "_"))
        return writer.option("checkpointLocation", checkpoint).trigger(**self.trigger).start()

    def _fold(self, name: str, changes: DataFrame, batch_id: str, keys: Sequence[str]) -> None:
        """Upsert a batch and log it; followers of a raw table never run ahead of it."""

        def note(rows: DataFrame, n: str) -> None:
            if name.startswith("dwd."):
                self._note_days(name, rows, n)

        def upsert(rows: DataFrame, n: str) -> None:
            partition = "dt" if "dt" in rows.columns else None
            upsert_partitioned(
                rows, self.lake.path(name), keys=keys, batch_id=n, partition=partition, buckets=self.lake.buckets
            )

        def log(rows: DataFrame, n: str) -> None:
            log_changes(rows, self.lake.changes(name), n)

        def log_steps(rows: DataFrame, n: str) -> None:
            log_transitions(
                rows, self.lake.path(name), self.lake.changes(name), keys=keys, batch_id=n, buckets=self.lake.buckets
            )

        # Aggregates add what a fact table's rows were and are; that must be known before they are replaced.
        multi_sink(changes, batch_id, [note, log_steps, upsert] if name.startswith("dwd.") else [upsert, log])

    def _append(
        self, name: str, rows: DataFrame, batch_id: str, cluster: str = "mid", event_key: Sequence[str] | None = None
    ) -> None:
        stream = batch_id.rpartition(".")[0]
        self._note_days(name, rows, batch_id)
        append_log(rows, self.lake.path(name), batch_id, cluster, stream, event_key)

    def _note_days(self, name: str, rows: DataFrame, batch_id: str) -> None:
        """Note for every scheduled aggregate which days of its facts a batch touches, before it does."""
        readers = [t for t in REFRESHED if name in RULES[f"dws.{t}"][1]]
        if not readers:
            return
        for (day,) in rows.select("dt").distinct().collect():  # days of one batch
            for table in readers:
                files.make(self.spark, f"{self.lake.path(f'ledger.{table}')}/{day or NO_DAY}/{batch_id}")

    def _follow_changes(self, name: str) -> DataFrame:
        columns = [(c, t) for c, t in self._shape(name)] + [("_op", "string"), ("_ts", "bigint"), ("_seq", changelog.POSITION)]
        return change_stream(self.spark, self.lake.changes(name), columns, self.max_files)

    def _follow_appends(self, name: str) -> DataFrame:
        return change_stream(self.spark, self.lake.path(name), self._shape(name), self.max_files)

    def _shape(self, name: str) -> list[tuple[str, str]]:
        """Column names and types of a raw, dimension or fact table."""
        if name not in self._shapes:
            build, inputs = RULES[name]
            if name.startswith("ods."):
                rows = [empty(self.spark, name.removeprefix("ods."))]
            else:
                ddl = [", ".join(f"`{c}` {t}" for c, t in self._shape(i)) for i in inputs]
                rows = [self.spark.createDataFrame([], columns) for columns in ddl]
            self._shapes[name] = build(*rows).dtypes
        return self._shapes[name]


def _in_days(days: Sequence[str | None]) -> Column:
    return F.col("dt").isin([d for d in days if d is not None]) | (F.col("dt").isNull() if None in days else F.lit(False))


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for several streams; stop all when one fails."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
