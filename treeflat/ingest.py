"""One run: files -> records -> changed records -> tables, dead letters and registries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from treeflat.functions.text import parse_iso
from treeflat.operators import classify, deadletter, nodes, shred, upkeep, validate
from treeflat.plans.contracts import Contracts
from treeflat.plans.mapping import Mapping
from treeflat.session import BROADCAST_BYTES, BROADCAST_ROWS, exact_names, staged
from treeflat.sinks import tables as sinks
from treeflat.sinks.store import Store
from treeflat.sources import files, records as source

RECORD_REGISTRY, FILE_REGISTRY, FILE_PROFILES, REPLAYS = "record_registry", "file_registry", "file_profiles", "replays"
#: One row per letter that was replayed: its record's hash as it lay there, the hash after the last repair, how often.
REPLAY_SCHEMA = "letter string, repaired string, attempts int, replayed_at timestamp"
PROFILE_SCHEMA = "file_path string, length bigint, modified timestamp, file_md5 string, charset string, closing string"
#: A file changed less than this before it was read may change again within the same time stamp: its profile is not kept.
SETTLED = "INTERVAL 2 SECONDS"


@dataclass
class Job:
    """What a run needs to know besides its input."""

    mapping: Mapping
    contracts: Contracts
    store: Store
    record_tag: str = "REC"
    id_tag: str = "UID"
    file_number: int = -1
    file_numbers: DataFrame | None = None
    dead_letters: str | None = None
    container: str | None = None  # take only records with exactly these ancestors
    writers: int = 4
    encoding: str | None = None  # of files that declare another, or none, than they are in

    def __post_init__(self):
        self.contracts = self.contracts.augmented(self.mapping.root_table)

    @property
    def tables(self) -> list[str]:
        """Mapped tables that have a contract; rows of the others are not kept (see the lint)."""
        return [t for t in self.mapping.tables() if t in self.contracts]


@dataclass
class Report:
    skipped: bool = False
    version: int | None = None
    counts: dict[str, int] = field(default_factory=dict)
    dead_letters: int = 0
    rows: dict[str, int] = field(default_factory=dict)  # written to each table
    refused: dict[str, int] = field(default_factory=dict)  # by each table's contract, where there are any


def now_utc() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def ingest(
    spark: SparkSession, paths, job: Job, run_ts: str | None = None, recursive: bool = False, glob: str = "*.xml", force: bool = False,
    batch: tuple[str, int] | None = None,
) -> Report:
    """Process the files not yet seen with this content, record by record.

    ``batch`` is a stream's name and the number of its batch: published with the tables, and nothing is done for a number that was.

    ``force`` reads all files again: records in the dead letters are in no registry, so after a repair of mapping,
    contract or parser they are new, and all others are unchanged.
    """
    if batch is not None and job.store.last_batch(batch[0]) >= batch[1]:
        return Report(skipped=True)
    stamp = run_ts or now_utc()
    prints, profiled = profile(spark, paths, job, recursive, glob, force)
    if profiled is None:  # kept profiles are published with the file registry
        return Report(skipped=True)
    known = job.store.read(FILE_REGISTRY, files.FILE_REGISTRY_SCHEMA)
    todo = prints if force else prints.join(upkeep.missing_files(prints, known).select("file_path"), "file_path", "left_semi")
    if job.encoding:
        todo = todo.withColumn("charset", F.lit(job.encoding))
    fragments, refused = source.read_profiled(spark, todo, job.record_tag, job.id_tag)
    if fragments is None and refused.isEmpty():
        change = job.store.begin()  # other time stamps, the same contents
        keep_profiles(change, profiled)
        change.publish()
        return Report(skipped=True)
    if fragments is None:
        nothing = spark.createDataFrame([], "value string, source_file string, file_size long, block long")
        fragments = source.cut_fragments(nothing, job.record_tag, job.id_tag)
    return ingest_fragments(fragments, job, stamp, prints, profiled, refused, batch)


def profile(spark: SparkSession, paths, job: Job, recursive: bool, glob: str, force: bool) -> tuple[DataFrame, DataFrame | None]:
    """The files' profiles (see :func:`treeflat.sources.files.profiled`), and of these the ones that were made now.

    A file whose path, length and time are those of a kept profile is not read.
    """
    found = files.listed(spark, paths, glob, recursive)
    kept = job.store.read(FILE_PROFILES, PROFILE_SCHEMA)
    on = ["file_path", "length", "modified"]
    columns = [f.split()[0] for f in PROFILE_SCHEMA.split(", ")]
    same = None
    if not force and FILE_PROFILES in job.store.tables():
        # The scan needs the list of paths on the driver, as any file scan does.
        fresh = [files.as_pattern(r[0]) for r in found.join(kept, on, "left_anti").select("file_path").orderBy("file_path").collect()]
        same = kept.join(found, on, "left_semi").select(*columns)
        if not fresh:
            return same, None
        paths, recursive = fresh, False
    made = staged(files.profiled(spark, paths, glob, recursive, job.record_tag).select(*columns, F.current_timestamp().alias("read_at")), "profiles")
    prints = made.select(*columns)
    return (prints if same is None else prints.unionByName(same)), made


def keep_files(job: Job, change, prints: DataFrame, keys: DataFrame, stamp: Column) -> None:
    """File registry rows of the files this run has read; the per-file counts come from the light keys."""
    counted = keys.groupBy(F.col("source_file").alias("file_path")).agg(F.count(F.lit(1)).alias("record_count"))
    known = job.store.read(FILE_REGISTRY, files.FILE_REGISTRY_SCHEMA)
    rows = upkeep.missing_files(prints, known).join(counted, "file_path", "left").select(
        "file_path", "file_md5", stamp.alias("processed_at"), F.coalesce("record_count", F.lit(0)).alias("record_count")
    )
    change.upsert(FILE_REGISTRY, rows, rows.select("file_path"), "file_path")


def keep_profiles(change, made: DataFrame) -> None:
    settled = made.where(F.col("modified") < F.col("read_at") - F.expr(SETTLED)).drop("read_at")
    change.upsert(FILE_PROFILES, settled, made.select("file_path"), "file_path")


def ingest_fragments(
    fragments: DataFrame, job: Job, run_ts: str, prints: DataFrame | None = None, profiled: DataFrame | None = None,
    refused_files: DataFrame | None = None, batch: tuple[str, int] | None = None, also: Callable | None = None,
) -> Report:
    """One run over fragments (see :func:`treeflat.sources.records.read_fragments`).

    ``also`` may add to the run's change; what it adds is published with the tables.
    """
    with exact_names(fragments.sparkSession):
        report = _run(fragments, job, run_ts, prints, profiled, refused_files, batch, also)
        job.store.fold()
        return report


def _run(
    fragments: DataFrame, job: Job, run_ts: str, prints: DataFrame | None, profiled: DataFrame | None, refused_files: DataFrame | None,
    batch: tuple[str, int] | None, also: Callable | None,
) -> Report:
    m = job.mapping
    stamp = F.lit(run_ts).cast("timestamp")

    # Pass 1 reads the input for ids, hashes and failures; the registry join moves no record text.
    scan = staged(source.light_scan(fragments, job.record_tag), "scan")
    whole = source.mended(fragments, job.record_tag, job.id_tag, scan)
    if whole is not fragments:
        fragments, scan = whole, staged(source.light_scan(whole, job.record_tag), "scan")
    tails = staged(source.truncated_tails(scan, job.record_tag), "tails")
    cut_off = bool(tails.take(1))
    keys = scan.where("uid is not null").select("uid", "record_hash", "source_file", "pos")
    if cut_off:
        keys = keys.join(tails.select("source_file", "pos"), ["source_file", "pos"], "left_anti")
    if job.container:
        gate = staged(source.inside(fragments, job.container, job.record_tag), "gate")
        keys, scan = (df.join(gate, ["source_file", "pos"], "left_semi") for df in (keys, scan))
    registry = job.store.read(RECORD_REGISTRY, classify.REGISTRY_SCHEMA)
    classified = classify.classify(source.latest_record(keys), registry, unique=True)
    # counted as they are written, here and below: nothing is read for a figure
    routes = Observation("routes")
    routed = staged(classified.observe(routes, *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in classify.STATUSES]), "routed")
    counts = {s: n for s, n in observed(routes, *classify.STATUSES).items() if n}
    wanted = classify.to_process(routed)

    # Pass 2 reads the text of the records to process.
    picked = pick(source.split_records(fragments), keys, wanted, everything=not cut_off and not job.container)
    if job.file_numbers is not None:
        picked = files.with_file_number(picked, job.file_numbers)
    parsed = stage_parsed(picked, job)
    walked = stage_walked(parsed, job)

    refused_ids = refused_roots(parsed, walked, job, stamp)
    change = job.store.begin()
    ids = wanted.select("uid")
    replaced = change.replaced(ids)

    def write(table: str):
        rows = kept_rows(parsed, walked, job, table, stamp, refused_ids)
        contract = job.contracts[table]
        if not change.writes(table, replaced):
            return None
        seen = Observation(f"rows of {table}")
        error = F.count("error").alias("refused")
        checked = validate.checked(rows, contract).observe(seen, F.count(F.lit(1)).alias("rows"), error)
        change.upsert(table, validate.project(validate.accepted(checked), contract), ids, "id", replaced)
        got = observed(seen, "rows", "refused")
        report.rows[table] = got["rows"] - got["refused"]
        if not got["refused"]:
            return None
        report.refused[table] = got["refused"]
        return validate.refused_rows(rows, contract, table)

    report = Report(counts=counts)
    # Records in the dead letters are not registered, so a forced run after a repair sees them again.
    done = wanted.join(parsed.where("not unusable").select("uid"), "uid", "left_semi")
    if walked is not None:
        done = done.join(walked.where("error is not null").select("uid"), "uid", "left_anti")
    if refused_ids is not None:
        done = done.join(refused_ids.select(F.col("id").alias("uid")), "uid", "left_anti")
    registries = [lambda: change.upsert(RECORD_REGISTRY, classify.registry_rows(done, run_ts), ids, "uid", replaced)]
    if prints is not None:
        registries.append(lambda: keep_files(job, change, prints, keys, stamp))
    if profiled is not None:
        registries.append(lambda: keep_profiles(change, profiled))

    # Tables and registries are written side by side and become visible together.
    with ThreadPoolExecutor(max(1, job.writers)) as pool:
        written = [pool.submit(write, t) for t in job.tables]
        noted = [pool.submit(r) for r in registries]
        refused = [r for r in (w.result() for w in written) if r is not None]
        for n in noted:
            n.result()

    lost = source.split_failures(fragments, job.record_tag, job.id_tag, tails if cut_off else None, scan)
    letters = [lost.withColumn("pipeline_step", F.lit("SplitXMLRecords")), *unreadable(parsed, walked, job), *refused]
    if refused_files is not None:
        unread = refused_files.select(F.lit(None).cast("string").alias("record_id"), F.to_json(F.struct("source_file")).alias("row"), "error", F.lit("LookupError").alias("error_type"))
        letters.append(unread.withColumn("pipeline_step", F.lit("ReadFiles")))
    dead = staged(deadletter.enriched(deadletter.unified(letters), run_ts), "letters")
    n_dead = dead.count()
    if n_dead and job.dead_letters:
        deadletter.write_by_day(dead, job.dead_letters)

    if also is not None:
        also(change)
    report.version, report.dead_letters = change.publish(*(batch or ())), n_dead
    return report


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """What was observed while rows were written; zeros where Catalyst knew that there were none and left the observation out."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":  # of an empty row of figures
            raise
        return dict.fromkeys(names, 0)


def replay(
    spark: SparkSession, job: Job, repair: Callable[[Column], Column] | None = None, run_ts: str | None = None, force: bool = False
) -> Report:
    """Process the records among the dead letters again, after a repair of mapping, contract or of the texts.

    The letters are the only source.  ``repair`` makes a record's text from that of its letter.  A letter is tried only
    if its repaired text never was: a replay that is repeated does nothing.  ``force`` tries all, as after a repair of mapping or contract.  Attempts are counted and published with the tables.  Left out are letters whose record has a newer version
    in the registry, and records cut off by the end of their file unless they are repaired.  Letters of single rows hold no record.
    """
    stamp = run_ts or now_utc()
    if job.dead_letters is None:
        raise ValueError("the job has no dead letters")
    letters = deadletter.replayable(deadletter.read_letters(spark, job.dead_letters), with_origin=True)
    text = F.col("xml") if repair is None else repair(F.col("xml"))
    tries = letters.select(F.sha2("xml", 256).alias("letter"), "xml", text.alias("text"), "error", "timestamp")
    tries = tries.where((F.col("error") != source.CUT_OFF) | (F.col("text") != F.col("xml"))).withColumn("repaired", F.sha2("text", 256))
    # a record that failed more than once has many letters: one try
    tries = tries.groupBy("letter", "repaired").agg(F.max("timestamp").alias("timestamp"), F.any_value("text").alias("text"))
    if not force:
        tries = tries.join(job.store.read(REPLAYS, REPLAY_SCHEMA).select("repaired"), "repaired", "left_anti")
    tries = tries.withColumn("uid", source.record_id(F.col("text"), job.record_tag, job.id_tag))
    newer = job.store.read(RECORD_REGISTRY, classify.REGISTRY_SCHEMA).groupBy("uid").agg(F.max("ingested_at").alias("ingested_at"))
    # a letter's time has the precision of its text
    later = tries.join(newer, "uid", "left").where(F.col("ingested_at").isNull() | (F.col("ingested_at") <= parse_iso(F.col("timestamp"))))
    tries = staged(later.select("letter", "repaired", "text", tries["timestamp"]), "replay")
    if tries.isEmpty():
        return Report(skipped=True)
    closing = f"</{job.record_tag}>"
    lines = tries.select(
        F.regexp_replace("text", rf"{closing}\s*$", "").alias("value"), F.concat_ws(":", F.lit("letter"), "timestamp", "letter").alias("source_file"),
        F.lit(2**62).alias("file_size"), F.lit(0).cast("long").alias("block"),  # no file that could be cut off
    )
    before = job.store.read(REPLAYS, REPLAY_SCHEMA).groupBy("letter").agg(F.max("attempts").alias("before"))
    done = tries.join(before, "letter", "left").groupBy("letter").agg(
        F.max("repaired").alias("repaired"), F.max(F.coalesce("before", F.lit(0)) + 1).cast("int").alias("attempts")
    ).withColumn("replayed_at", F.lit(stamp).cast("timestamp"))
    fragments = source.cut_fragments(lines, job.record_tag, job.id_tag)
    return ingest_fragments(fragments, job, stamp, also=lambda change: change.upsert(REPLAYS, done, done.select("letter"), "letter"))


def pick(found: DataFrame, keys: DataFrame, wanted: DataFrame, everything: bool = True) -> DataFrame:
    """The full records behind ``wanted`` (uid, record_hash, source_file), each once.

    Nothing to leave out (and ``everything`` in ``found`` is a whole record): no join.  Few wanted: a broadcast of their keys, whose size is
    measured.  Otherwise a shuffle join.  Equal copies share id, hash and file, so the match
    does not depend on scan order; they are reduced to one by a partial aggregate.
    """
    on = ["uid", "record_hash", "source_file"]
    size = wanted.agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.octet_length("uid") + F.octet_length("source_file") + 64).cast("long")).alias("b")
    ).first()
    total = keys.count()
    if everything and size["n"] == total:
        return found
    side = wanted.select(*on)
    if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES:
        side = F.broadcast(side)
    matched = found.join(side, on, "left_semi")
    # Copies exist only if the matching keys outnumber the wanted records.
    copies = keys.join(side, on, "left_semi").count() > size["n"]
    return source.latest_record(matched) if copies else matched


def stage_parsed(picked: DataFrame, job: Job) -> DataFrame:
    """Parse once, write once: an array column per table plus the text the node walk needs."""
    arrays = shred.staged_arrays(picked, job.mapping, job.tables, job.file_number)
    again = F.col("routes").isNotNull() | F.col("unusable")
    return staged(arrays.withColumn("xml", F.when(again, F.col("xml"))), "parsed")


def stage_walked(parsed: DataFrame, job: Job) -> DataFrame | None:
    """One node walk for all tables, over the routed records only; None if there are none."""
    routed = parsed.where("routes is not null and not unusable")
    if not routed.take(1):
        return None
    return staged(nodes.walk_tables(routed, job.mapping, job.tables), "walked")


def table_rows(parsed: DataFrame, walked: DataFrame | None, job: Job, table: str) -> DataFrame:
    """Rows of one table from the staged records: its own column, and the walked nodes."""
    m, at = job.mapping, job.tables.index(table)
    parts = []
    if not m.needs_document_order(table):
        parts.append(shred.rows_of(parsed, m, table, at))
    if walked is not None:
        mine = walked.where(shred.routed_to_nodes(at))
        parts.append(nodes.assemble(mine, m, table, job.tables, job.file_number))
    if not parts:
        schema = ", ".join(["id string"] + [f"`{n}` {k}" for n, k in shred.row_fields(m, table)])
        return parsed.sparkSession.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def refused_roots(parsed: DataFrame, walked: DataFrame | None, job: Job, stamp) -> DataFrame | None:
    """Ids of records whose root row its contract refuses; None if there are none."""
    root = job.mapping.root_table
    if root not in job.tables or not validate.may_refuse(job.contracts[root], job.mapping, root):
        return None
    rows = table_rows(parsed, walked, job, root).withColumn("ingestion_ts", stamp)
    ids = staged(validate.failed(validate.checked(rows, job.contracts[root])).select("id").distinct(), "refused-roots")
    return ids if ids.take(1) else None


def kept_rows(parsed: DataFrame, walked: DataFrame | None, job: Job, table: str, stamp, refused_ids: DataFrame | None) -> DataFrame:
    """Rows of one table; a record whose root row is refused has no rows in the other tables either."""
    rows = table_rows(parsed, walked, job, table).withColumn("ingestion_ts", stamp)
    if refused_ids is None or table == job.mapping.root_table:
        return rows
    return rows.join(refused_ids, "id", "left_anti")


def bulk_load(
    records: DataFrame, job: Job, out: str, run_ts: str, disposition: str = sinks.APPEND
) -> dict[str, str]:
    """Load without change detection: one parse, one write per contract table below ``out``.

    Unreadable records and refused rows go to the job's dead letters, as in :func:`ingest`.
    """
    with exact_names(records.sparkSession):
        return _load(records, job, out, run_ts, disposition)


def _load(records: DataFrame, job: Job, out: str, run_ts: str, disposition: str) -> dict[str, str]:
    parsed = stage_parsed(records, job)
    walked = stage_walked(parsed, job)

    stamp = F.lit(run_ts).cast("timestamp")
    refused_ids = refused_roots(parsed, walked, job, stamp)

    def write(table):
        rows = kept_rows(parsed, walked, job, table, stamp, refused_ids)
        path, contract = f"{out}/{table}", job.contracts[table]
        sinks.write_table(validate.valid_rows(rows, contract), path, disposition)
        refused = validate.refused_rows(rows, contract, table) if validate.may_refuse(contract, job.mapping, table) else None
        return table, path, refused

    with ThreadPoolExecutor(max(1, job.writers)) as pool:
        written = list(pool.map(write, job.tables))
    if job.dead_letters:
        letters = unreadable(parsed, walked, job) + [r for _, _, r in written if r is not None]
        dead = staged(deadletter.enriched(deadletter.unified(letters), run_ts), "letters")
        if dead.take(1):
            deadletter.write_by_day(dead, job.dead_letters)
    return {table: path for table, path, _ in written}


def unreadable(parsed: DataFrame, walked: DataFrame | None, job: Job) -> list[DataFrame]:
    """Dead letters of records that the parser or the node walk could not read."""
    bad = shred.malformed(parsed.where("unusable").select("uid", "xml"), job.mapping)
    letters = [bad.withColumn("pipeline_step", F.lit("ParseXMLRecord"))]
    if walked is not None:
        unread = walked.where("error is not null").select("uid", "error", F.lit("XMLSyntaxError").alias("error_type"))
        letters.append(unread.withColumn("pipeline_step", F.lit("ParseXMLRecord")))
    return letters
