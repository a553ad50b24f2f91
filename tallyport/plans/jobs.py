"""The four commands: load a file, migrate a dump, export tables, list a dump's tables.

A load numbers its rows by chunk and line. Chunks are byte ranges (row groups of Parquet), the same on every cluster, and
batches are runs of lines of a chunk that go in or fail as one. One pass reads, casts and stages the rows and counts what
happened to them; a version of the table's log then names the rows that go in. With `resume` a job file keeps what the
source was; which batches went in is said by the same versions that name their rows, so the two never disagree. A second
run of the job opens only chunks that are not done.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.contract import ColumnContract, TableContract
from tallyport.functions import copytext, identifiers, infer
from tallyport.functions.casts import failed, recast
from tallyport.functions.render import cell_text
from tallyport.functions.types import parse_type, spark_type, sql_type
from tallyport.operators import accounting, export, shape, sink, verify
from tallyport.operators.sink import OnConflict
from tallyport.operators.verify import VerifyMode
from tallyport.plans import ddl
from tallyport.plans.store import Store, Version
from tallyport.session import cut, discard
from tallyport.sources import delimited, dumpscan, dumpsource, files
from tallyport.sources import parquet as parquet_source
from tallyport.sources.files import Place

BATCH_SIZE = 2000


@dataclass(frozen=True)
class LoadOptions:
    uri: str
    table: str
    schema: str = "public"
    format: str | None = None
    on_conflict: OnConflict = OnConflict.DO_NOTHING
    batch_size: int = BATCH_SIZE
    chunk_bytes: int = files.CHUNK_BYTES
    dialect: delimited.Dialect | None = None
    rename: dict[str, str] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    create: bool = False
    resume: str | None = None
    verify: VerifyMode = VerifyMode.OFF

    def validated(self) -> LoadOptions:
        """The options with their format, if they go together."""
        kind = self.format or files.detect_format(self.uri)
        if kind not in files.FORMATS:
            raise ValueError(f"unknown format {kind!r}")
        if self.dialect is not None and kind not in ("csv", "tsv"):
            raise ValueError(f"delimiter options do not go with {kind}")
        if kind == "dump" and (self.rename or self.exclude or self.create):
            raise ValueError("a dump's tables can't be renamed, thinned or created by a load")
        if self.resume and self.verify is not VerifyMode.OFF:
            raise ValueError("a resumed load can't be verified: what it adds is not all that it counts")
        if self.exclude and self.create:
            raise ValueError("columns can't be excluded from a table that the load creates")
        if self.batch_size < 1 or self.chunk_bytes < 1:
            raise ValueError("batches and chunks have a size of 1 at least")
        shape.validate_exclude_rename(list(self.exclude), self.rename)
        identifiers.validate_identifier(self.table, "table name")
        identifiers.validate_identifier(self.schema, "schema name")
        return replace(self, format=kind)


@dataclass(frozen=True)
class LoadResult:
    table: str
    source_rows: int | None
    loaded: int
    failed: int
    parse_errors: int
    verdict: str | None = None
    estimated: int | None = None
    seconds: float = 0.0
    warnings: tuple[str, ...] = ()
    #: Where the error records are, if there are any.
    errors: str | None = None
    bad_keys: tuple[str, ...] = ()
    #: Bytes of text that were read.
    bytes: int = 0

    @property
    def passed(self) -> bool:
        return self.verdict is None or self.verdict in verify.GOOD

    @property
    def too_few(self) -> bool:
        """Whether less than three quarters of the estimated rows were seen."""
        return accounting.too_few(self.loaded + self.failed, self.estimated)


@dataclass(frozen=True)
class _Source:
    """Rows (chunk_id, line_no, fault, raw, row): `row` has the columns under names by place (f0, f1, ...), so that no name of
    the source's is in the way of another; `fault` says why a record is none. `chunks` is None where there is but one."""

    rows: DataFrame
    columns: list[str]
    count: int | None
    estimated: int | None
    kinds: list[T.DataType] | None = None
    chunks: int | None = None
    #: Whether every line is a row of the source, so that the rows read are its exact number.
    lines_are_rows: bool = False
    #: Where records begin in chunks that begin inside quotes.
    begins: dict[int, int | None] | None = None

    @property
    def is_text(self) -> bool:
        return self.kinds is None

    def cell(self, column: str) -> Column:
        return F.col(f"row.f{self.columns.index(column)}")

    def named(self, columns: list[str], *extra: str) -> DataFrame:
        return self.rows.where("fault IS NULL").select(*(self.cell(c).alias(c) for c in columns), *extra)


_EXTRA = ("chunk_id", "line_no", "fault", "raw")


def _packed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (chunk_id, line_no, good, raw, columns) with the columns in `row`, by place."""
    cells = [F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(columns)]
    return rows.select("chunk_id", "line_no", F.when(~F.col("good"), F.lit(delimited.WIDTH)).alias("fault"), "raw", F.struct(*cells).alias("row"))


def _source(spark: SparkSession, options: LoadOptions, block: dumpscan.Block | None, begins: dict[int, int | None] | None = None) -> _Source:
    place = Place.of(options.uri)
    if options.format == "parquet":
        rows, schema, chunks, count = parquet_source.chunked(spark, options.uri, options.chunk_bytes)
        rows = rows.select("chunk_id", "line_no", F.lit(None).cast("string").alias("fault"), F.lit(None).cast("string").alias("raw"), "row")
        return _Source(rows, schema.names, count, count, [f.dataType for f in schema.fields], chunks)
    if options.format == "dump":
        block = block or dumpscan.find_block(dumpsource.index(spark, options.uri), options.schema, options.table)
        with place.open() as file:
            estimated = files.rows_in(file, block.data_start, block.data_end)
        lines = dumpsource.raw_lines(spark, options.uri, block.data_start, block.data_end, options.chunk_bytes)
        empty = block.data_start == block.data_end
        columns = list(block.columns)
        rows = copytext.packed(lines, len(columns)).withColumn("fault", F.when(~F.col("good"), F.lit(delimited.WIDTH))).select(*_EXTRA, "row")
        return _Source(rows, columns, 0 if empty else None, estimated, None, files.chunk_count(block.data_start, block.data_end, options.chunk_bytes), True)
    dialect = options.dialect or (delimited.TSV if options.format == "tsv" else delimited.CSV)
    if dialect.multiline:
        # One file with records over several lines is read in one piece, in order.
        columns = delimited.column_names(spark, place.for_spark, dialect)
        rows = delimited.scan(spark, place.for_spark, dialect, columns).withColumn("chunk_id", F.lit(0)).withColumn("line_no", F.monotonically_increasing_id() + 1)
        rows = rows.withColumn("good", F.col(delimited.BAD).isNull()).withColumnRenamed(delimited.BAD, "raw")
        return _Source(_packed(rows, columns), columns, None, None)
    head, rows, begins = delimited.records(spark, options.uri, dialect, options.chunk_bytes, begins)
    with place.open() as file:
        estimated = files.rows_in(file, head.start, head.end)
    return _Source(rows, head.columns, None, estimated, None, files.chunk_count(head.start, head.end, options.chunk_bytes), begins=begins)


def _target(store: Store, options: LoadOptions, source: _Source) -> TableContract:
    if not options.create:
        return store.contract(options.schema, options.table)
    if source.is_text:
        # The first chunk only: the filter reaches the source, no other chunk is opened. It stays with what was read, so the
        # sample is a reading of its own.
        sample = _source(store.spark, options, None, source.begins).rows.where("fault IS NULL AND chunk_id = 0").select(F.col("chunk_id").alias("run"), F.col("line_no").alias("at"), "row")
        found = infer.infer_runs(sample, source.columns, [source.cell(c) for c in source.columns])
        made = tuple(ColumnContract(options.rename.get(c.name, c.name), c.type.value, c.nullable) for c in found)
    else:
        made = tuple(ColumnContract(options.rename.get(c, c), sql_type(kind)) for c, kind in zip(source.columns, source.kinds, strict=True))
    store.create(TableContract(options.schema, options.table, made))
    return store.contract(options.schema, options.table)


class Job:
    """What a resumable load keeps: a file with its number and its plan, made once. The batches that went in, and the chunks
    that are done, are tables beside it, a run's each; they count once a version of the target's log names them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.file = spark, Place.of(path)
        self.runs = Place.of(path + ".runs")
        text = self.file.read_text()
        self.kept: dict | None = json.loads(text) if text is not None else None

    @property
    def id(self) -> str:
        return self.kept["id"]

    def options(self, options: LoadOptions) -> LoadOptions:
        """The options of the first run where a later one may leave them out: exclusions, and the sizes that number rows."""
        if self.kept is None:
            return options
        plan = self.kept["plan"]
        if options.exclude and sorted(options.exclude) != sorted(plan["exclude"]):
            raise ValueError(f"can't resume: the job excludes {', '.join(plan['exclude']) or 'nothing'}")
        return replace(options, exclude=tuple(plan["exclude"]), batch_size=plan["batch_size"], chunk_bytes=plan["chunk_bytes"])

    def begins(self, options: LoadOptions) -> dict[int, int | None] | None:
        """Where chunks' records begin, as the first run found it, if the source is the one it read."""
        if self.kept is None or self.kept["begins"] is None or any(self.kept["plan"][k] != v for k, v in (("uri", options.uri), ("size", Place.of(options.uri).size()))):
            return None
        return {int(k): v for k, v in self.kept["begins"].items()}

    def begin(self, plan: dict, begins: dict[int, int | None] | None) -> None:
        """Write the plan, or refuse a source, target or way of reading that is another one than the first run's."""
        if self.kept is None:
            self.file.create(json.dumps({"id": uuid.uuid4().hex, "plan": plan, "begins": begins, "excluded_positions": shape.excluded_positions(plan["columns"], plan["exclude"])}))
            self.kept = json.loads(self.file.read_text())
        for name, value in self.kept["plan"].items():
            if plan[name] != value:
                raise ValueError(f"can't resume: {name} was {value!r} and is {plan[name]!r}")
        positions = shape.excluded_positions(plan["columns"], plan["exclude"])
        if positions != self.kept["excluded_positions"]:
            raise ValueError("can't resume: the job file's excluded positions are not those of its columns")

    def _read(self, version: Version, what: str, schema: str) -> DataFrame | None:
        runs = version.jobs.get(self.id, [])
        return self.spark.read.schema(schema).parquet(*((self.runs / run / what).for_spark for run in runs)) if runs else None

    def batches(self, version: Version) -> DataFrame | None:
        """(chunk_id, batch_id) of the batches that are in that version."""
        return self._read(version, "batches", "chunk_id int, batch_id int")

    def open_chunks(self, version: Version, chunks: int) -> list[int] | None:
        """The chunks that are not done, as many as the source would have partitions; None if all are open."""
        done = self._read(version, "done", "chunk_id int")
        if done is None:
            return None
        return [r.id for r in self.spark.range(chunks).join(done, F.col("id") == F.col("chunk_id"), "left_anti").select("id").collect()]

    def add(self, numbered: DataFrame, batches: DataFrame) -> str:
        """Write what a run loaded: its batches, and the chunks of which nothing is left over."""
        run = f"run-{uuid.uuid4().hex}"
        batches.where("outcome = 'loaded'").select("chunk_id", "batch_id").write.parquet((self.runs / run / "batches").for_spark)
        left = numbered.where("fault IS NOT NULL").select("chunk_id").union(batches.where("outcome <> 'loaded'").select("chunk_id")).distinct()
        batches.select("chunk_id").distinct().join(left, "chunk_id", "left_anti").write.parquet((self.runs / run / "done").for_spark)
        return run


def _plan(options: LoadOptions, source: _Source) -> dict:
    dialect = asdict(options.dialect) if options.dialect else None
    return {
        "uri": options.uri, "schema": options.schema, "table": options.table, "format": options.format, "size": Place.of(options.uri).size(), "columns": source.columns,
        "exclude": sorted(options.exclude), "rename": options.rename, "dialect": dialect, "batch_size": options.batch_size, "chunk_bytes": options.chunk_bytes,
    }


def _bound(options: LoadOptions, source: _Source, contract: TableContract) -> dict[str, str]:
    """Target column to source column. Dumps bind by name, and so do tables that the load creates and loads that rename;
    other files bind by position, whatever a header says."""
    if options.exclude:
        shape.validate_excluded(source.columns, list(options.exclude))
    if unknown := [c for c in options.rename if c not in source.columns]:
        raise ValueError(f"renamed columns are not in the source: {', '.join(unknown)}")
    kept = [c for c in source.columns if c not in options.exclude]
    empty = source.rows.sparkSession.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in kept]))
    if options.format == "dump":
        return {c: c for c in shape.align(empty, contract.names).columns}
    if options.create or options.rename or options.format == "parquet":
        named = {options.rename.get(c, c): c for c in kept}
        target = [c for c in contract.names if c not in options.exclude]
        if set(named) == set(target):
            return {c: named[c] for c in target}
        if options.format != "parquet" or options.rename:
            raise ValueError(f"the source's columns {', '.join(named)} are not the table's {', '.join(target)}")
    target = [c for c in contract.names if c not in options.exclude]
    return dict(zip(shape.bind(empty, target).columns, kept, strict=True))


def typed(rows: DataFrame, contract: TableContract) -> DataFrame:
    """All-text rows (chunk_id, line_no, good, raw, columns) bound by name: (chunk_id, line_no, fault, raw, why, row)."""
    return _typed(_Source(_packed(rows, contract.names), contract.names, None, None), contract, {c: c for c in contract.names})


def _typed(source: _Source, contract: TableContract, bound: dict[str, str]) -> DataFrame:
    """(chunk_id, line_no, fault, raw, why, row): the target's values by place among the bound columns, and the columns that a
    row does not fit."""
    kinds = dict(zip(source.columns, source.kinds or [], strict=False))
    values: list[Column] = []
    for place, (name, origin) in enumerate(bound.items()):
        value, wanted = source.cell(origin), spark_type(*parse_type(contract.types[name]))
        if source.is_text:
            cast = recast(value, contract.types[name])
        elif kinds[origin] == wanted:
            cast = value
        else:
            # Another type: through the text that is compared and exported, unless both are numbers.
            number = all(k.typeName() in _NUMBERS or k.typeName().startswith("decimal") for k in (kinds[origin], wanted))
            cast = value.try_cast(wanted) if number else recast(cell_text(value, kinds[origin]), contract.types[name])
        values.append(F.struct(value.isNotNull().alias("given"), cast.alias("v")).alias(f"c{place}"))
    # A generator, so that a value is cast once and not again for each test of it.
    once = source.rows.select(*_EXTRA, F.explode(F.array(F.struct(*values))).alias("_x"))
    whys = []
    types, cells = {c.name: c for c in contract.columns}, []
    for place, name in enumerate(bound):
        column, cell = types[name], F.col(f"_x.c{place}")
        cells.append(cell["v"].alias(f"c{place}"))
        unfit = failed(F.when(cell["given"], F.lit("")), cell["v"])
        whys.append(F.when(unfit, F.lit(f"{column.name} does not fit {column.type_name}")))
        if not column.nullable and not column.identity:
            whys.append(F.when(~cell["given"], F.lit(f"{column.name} is NULL")))
    why = F.concat_ws("; ", *whys) if whys else F.lit("")
    return once.select(*_EXTRA, why.alias("why"), F.struct(*cells).alias("row"))


_NUMBERS = ("byte", "short", "integer", "long", "float", "double")


@dataclass
class _Counters:
    """What the staging pass has counted: rows, records with a fault, rows that do not fit, bytes of text."""

    rows: int
    unread: int
    unfit: int
    bytes: int


def _staged(rows: DataFrame) -> tuple[DataFrame, _Counters]:
    """The rows written once, and what was counted while they were."""
    seen = Observation()
    watched = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fault").isNotNull()).alias("unread"),
        F.count_if(F.col("fault").isNull() & (F.col("why") != "")).alias("unfit"), F.coalesce(F.sum(F.octet_length("raw")), F.lit(0)).alias("bytes"),
    )
    out = cut(watched, "load-rows")
    found = seen.get
    return out, _Counters(*(int(found[n]) for n in ("rows", "unread", "unfit", "bytes")))


def load(spark: SparkSession, store: Store, options: LoadOptions, block: dumpscan.Block | None = None) -> LoadResult:
    """One source into one table. Records that do not parse are counted; a row that does not fit fails its batch, and so does
    a key that is there already where conflicts are errors."""
    began = time.monotonic()
    options = options.validated()
    job = Job(spark, options.resume) if options.resume else None
    if job:
        options = job.options(options)
    source = _source(spark, options, block, job.begins(options) if job else None)
    if job:
        job.begin(_plan(options, source), source.begins)
    contract = _target(store, options, source)
    warnings = sink.validate_keys(options.on_conflict, contract.keys, list(options.exclude))
    bound = _bound(options, source, contract)
    base = store.version(options.schema, options.table)
    resumed = bool(job and base.jobs.get(job.id))
    reading = source
    if resumed and source.chunks is not None and (left := job.open_chunks(base, source.chunks)) is not None:
        # Reaches the source: chunks that are done are not opened.
        reading = replace(source, rows=source.rows.where(F.col("chunk_id").isin(left)))
    rows = _typed(reading, contract, bound).withColumn("batch_id", sink.batch_id(F.col("line_no"), options.batch_size))
    if resumed:
        rows = rows.join(job.batches(base), ["chunk_id", "batch_id"], "left_anti")
    staged, seen = _staged(rows)
    _check_rows(options, source, seen, resumed)
    count = seen.rows if source.lines_are_rows and source.count is None and not resumed else source.count
    checked = options.verify is not VerifyMode.OFF and not options.create and options.format in ("dump", "parquet")
    kinds = {f.name: f.dataType for f in contract.struct().fields}
    place = {c: f"t{i}" for i, c in enumerate(contract.names)}
    made: list = []

    def change(version: Version) -> Version | None:
        """The load on top of a version. Where another writer was first it is made again on top of what they left."""
        numbered = staged
        if job and version.number != base.number and (done := job.batches(version)) is not None:
            numbered = staged.join(done, ["chunk_id", "batch_id"], "left_anti")
        # Columns are called by place, so that no name of the table's is in the way of another.
        before = store.read(options.schema, options.table, version).toDF(*place.values())
        batches = _settled(numbered, before, [[place[c] for c in k] for k in contract.all_keys if all(c in bound for c in k)], options, seen, {place[c]: f"row.c{i}" for i, c in enumerate(bound)})
        made[:] = [numbered, before, batches]
        good = numbered.where("fault IS NULL")
        if batches.failed:
            good = good.join(batches.frame.where("outcome = 'loaded'"), ["chunk_id", "batch_id"], "left_semi")
        # Columns that are left out take their default.
        at = {name: i for i, name in enumerate(bound)}
        cells = [(F.col(f"row.c{at[c]}") if c in at else F.expr(contract.defaults.get(c, "NULL"))).cast(kinds[c]).alias(place[c]) for c in contract.names]
        new = good.select(*cells, F.struct("chunk_id", "line_no").alias("_order"))
        write = lambda df: store.write(options.schema, options.table, df.select(*place.values()).toDF(*contract.names))
        out = version
        if options.on_conflict is OnConflict.DO_UPDATE:
            out = replace(version, parts=(write(sink.do_update(before, new, [place[c] for c in contract.keys], F.col("_order"))),))
        elif batches.loaded:
            fresh = new
            if options.on_conflict is OnConflict.DO_NOTHING:
                # A number in order of chunk and line, as several keys need it.
                order = F.col("_order") if len(contract.all_keys) < 2 else F.col("_order.chunk_id").cast("long") * (1 << 40) + F.col("_order.line_no")
                fresh = sink.do_nothing(before, new, [[place[c] for c in k] for k in contract.all_keys], order)
            out = version.with_part(write(fresh))
        if job:
            out = out.with_run(job.id, job.add(numbered, batches.frame))
        return None if out is version else out

    store.commit(options.schema, options.table, change)
    numbered, before, batches = made
    failed_rows = batches.failed + seen.unread
    errors = None
    if failed_rows:
        errors = (store.root / ".errors" / f"{options.schema}.{options.table}-{uuid.uuid4().hex}").for_spark
        job_errors(numbered, batches.frame, options).write.parquet(errors)
    # A resumed run sees a part of the source, of which there is no estimate.
    estimated = None if resumed else source.estimated
    if accounting.too_few(batches.loaded + failed_rows, estimated, accounting.WARN_PART):
        warnings.append(f"{batches.loaded + failed_rows} rows seen, less than half of about {estimated}")
    result = LoadResult(options.table, count, batches.loaded, failed_rows, seen.unread, None, estimated, 0.0, tuple(warnings), errors, (), seen.bytes)
    if checked:
        result = _verify(spark, store, options, contract, source, result, before.count())
    discard(batches.frame, staged)
    return replace(result, seconds=round(time.monotonic() - began, 3))


def _check_rows(options: LoadOptions, source: _Source, seen: _Counters, resumed: bool) -> None:
    """No row may get lost between the source's own count and the rows that were read."""
    if resumed:
        return
    if source.count is not None and seen.rows != source.count:
        raise ValueError(f"{options.uri} has {source.count} rows, but {seen.rows} were read")
    if source.lines_are_rows and source.count is None and not seen.rows:
        raise ValueError(f"{options.table} has data in the dump, but no row of it was read")


@dataclass(frozen=True)
class _Batches:
    """(chunk_id, batch_id, n, outcome) of each batch that has a row that parsed; and the rows by outcome."""

    frame: DataFrame
    loaded: int
    failed: int

    @classmethod
    def counted(cls, frame: DataFrame) -> _Batches:
        """Settled once: written, then counted."""
        frame = cut(frame, "load-batches")
        counts = {r.outcome: r.n for r in frame.groupBy("outcome").agg(F.sum("n").alias("n")).collect()}
        loaded = counts.pop("loaded", 0)
        return cls(frame, loaded, sum(counts.values()))


def _settled(numbered: DataFrame, before: DataFrame, keys: list[list[str]], options: LoadOptions, seen: _Counters, cells: dict[str, str]) -> _Batches:
    """What becomes of each batch. `keys` name columns of `before`, `cells` says where the rows have them."""
    parsed = numbered.where("fault IS NULL")
    totals = accounting.batch_totals(parsed.select("chunk_id", "batch_id", (F.col("why") != "").alias("bad"))).select("chunk_id", "batch_id", "n", "failed")
    frame = totals.select("chunk_id", "batch_id", "n", F.when(F.col("failed"), "unfit").otherwise("loaded").alias("outcome"))
    if options.on_conflict is not OnConflict.ERROR or not keys:
        return _Batches.counted(frame)
    sound = parsed.join(totals.where("NOT failed"), ["chunk_id", "batch_id"], "left_semi") if seen.unfit else parsed
    columns = dict.fromkeys(c for k in keys for c in k)
    sound = sound.select(*(F.col(cells[c]).alias(c) for c in columns), (F.col("chunk_id").cast("long") * (1 << 32) + F.col("batch_id")).alias("_batch"))
    clash = sink.error_batches(before, sound, keys, "_batch").where("failed").select(F.floor(F.col("_batch") / (1 << 32)).cast("int").alias("chunk_id"), (F.col("_batch") % (1 << 32)).cast("int").alias("batch_id"), F.lit(True).alias("_clash"))
    outcome = F.when(F.col("_clash"), "conflict").otherwise(F.col("outcome")).alias("outcome")
    return _Batches.counted(frame.join(clash, ["chunk_id", "batch_id"], "left").select("chunk_id", "batch_id", "n", outcome))


def job_errors(numbered: DataFrame, batches: DataFrame, options: LoadOptions) -> DataFrame:
    """Error records of a load: lines that do not parse, lines that do not fit (these fail their batch), and batches whose
    keys were there already."""
    unread = numbered.where("fault IS NOT NULL")
    kind = F.when((F.col("raw") == "") if options.format == "dump" else F.lit(True), "parse_error").otherwise("field_count_mismatch")
    lines = unread.select(kind.alias("kind"), "chunk_id", "line_no", F.concat("fault", F.lit(": "), F.left("raw", F.lit(200))).alias("detail"))
    unfit = accounting.errors(numbered.where("fault IS NULL AND why <> ''"), "batch_error", F.col("why"), F.col("line_no"))
    clash = accounting.errors(batches.where("outcome = 'conflict'"), "batch_error", F.concat(F.lit("batch "), F.col("batch_id"), F.lit(" has keys that are there already")))
    return lines.unionByName(unfit).unionByName(clash)


def _verify(spark: SparkSession, store: Store, options: LoadOptions, contract: TableContract, source: _Source, result: LoadResult, pre: int) -> LoadResult:
    target = store.read(options.schema, options.table)
    numbers: dict[str, object] = {"source": result.source_rows, "loaded": result.loaded, "failed": result.failed, "pre": pre, "post": target.count(), "on_conflict": options.on_conflict.value}
    keys: tuple[str, ...] = ()
    if options.verify is VerifyMode.FULL:
        if options.format != "dump" or verify.skip_reason(list(contract.keys), source.columns, contract.names):
            numbers["skipped"] = True
        else:
            # The source is read again, so that what was staged is not trusted either.
            again = source.named(source.columns, "chunk_id", "line_no")
            verify.check_keys(again, contract.keys[0])
            found = verify.summary(verify.compare(again, target, contract.keys[0], contract.types, ("chunk_id", "line_no"))).first()
            if result.source_rows and not found.rows and result.parse_errors < result.source_rows:
                raise ValueError(f"{options.table} has rows in the source, but none was read again")
            numbers |= {"missing": found.missing, "mismatched": found.mismatched}
            keys = tuple([*found.missing_keys, *found.mismatch_keys][: verify.MOST_KEYS])
    return replace(result, verdict=verify.verdict_of(spark, options.table, **numbers).first().verdict, bad_keys=keys)


@dataclass(frozen=True)
class MigrateReport:
    findings: tuple[ddl.Finding, ...]
    tables: tuple[LoadResult, ...]
    created: tuple[str, ...]
    halted: str | None = None

    @property
    def passed(self) -> bool:
        return self.halted is None and all(t.passed for t in self.tables)


def migrate(spark: SparkSession, store: Store, uri: str, verify_mode: VerifyMode = VerifyMode.COUNT, dry_run: bool = False) -> MigrateReport:
    """Every table of a dump: statements first, then each table's rows, stopping at the first that fails."""
    blocks = dumpsource.index(spark, uri)
    with files.parse_uri(uri).open() as file:
        for b in blocks:
            for name in (b.schema, b.table, *b.columns):
                identifiers.validate_identifier(name)
        found = ddl.normalize(dumpscan.statements_text(file, blocks))
    if dry_run or found.unfixable:
        return MigrateReport(tuple(found.findings), (), tuple(export.table_ddl(replace(c, checks=())) for c in found.tables.values()), "statements can't be fixed" if found.unfixable else None)
    created = tuple(ddl.apply(list(found.tables.values()), store.create)[0])
    results: list[LoadResult] = []
    for b in blocks:
        options = LoadOptions(uri, b.table, b.schema, "dump", OnConflict.ERROR, verify=verify_mode)
        results.append(load(spark, store, options, b))
        if not results[-1].passed or results[-1].failed:
            return MigrateReport(tuple(found.findings), tuple(results), created, f"{b.schema}.{b.table}: {results[-1].verdict or 'rows failed'}")
    return MigrateReport(tuple(found.findings), tuple(results), created)


def export_tables(store: Store, path: str, schemas: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> int:
    """Tables as one dump file, for one machine; rows come one partition at a time, in order. No table at all is an error."""
    chosen = store.tables(schemas, names)
    if not chosen:
        raise LookupError("no table matches")
    with open(path, "w", encoding="utf-8", newline="") as out:
        for schema, table in chosen:
            before, lines, after = export.document_parts(store.contract(schema, table), store.read(schema, table))
            out.write(before)
            for row in lines.toLocalIterator(prefetchPartitions=True):
                out.write(row.line + "\n")
            out.write(after)
    return len(chosen)


def export_parts(store: Store, folder: str, schemas: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> list[str]:
    """Tables as text parts that, put together in this order, are the dump: for each table what goes before its rows, the
    rows (written by the executors, in key order), what goes after them."""
    chosen = store.tables(schemas, names)
    if not chosen:
        raise LookupError("no table matches")
    out: list[str] = []
    for number, (schema, table) in enumerate(chosen):
        before, lines, after = export.document_parts(store.contract(schema, table), store.read(schema, table))
        home = Place.of(folder) / f"{number:05}-{schema}.{table}"
        (home / "0-before.sql").write_text(before)
        lines.write.option("lineSep", "\n").text((home / "1-rows").for_spark)
        (home / "2-after.sql").write_text(after)
        rows = home / "1-rows"
        out += [(home / "0-before.sql").source.path, *rows.files(), (home / "2-after.sql").source.path]
    return out


def list_tables(spark: SparkSession, uri: str) -> DataFrame:
    """(schema, table, columns) of a dump; all names are checked before any is shown."""
    found = dumpsource.index(spark, uri)
    for b in found:
        identifiers.check_listable(b.schema, b.table, list(b.columns))
    return spark.createDataFrame([(b.schema, b.table, list(b.columns)) for b in found], "schema string, table string, columns array<string>")


def as_json(result: LoadResult) -> str:
    """One line for a terminal: keys that could deceive it are escaped."""
    shown = asdict(result) | {"bad_keys": identifiers.shown_keys(list(result.bad_keys)), "passed": result.passed, "too_few": result.too_few}
    return json.dumps(shown | {"rows_a_second": round(accounting.rate(result.loaded, result.seconds), 1)})
