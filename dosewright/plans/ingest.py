"""From landed files to curated, month-partitioned records."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.operators.curate import curate
from dosewright.operators.dedup import drop_exact_duplicates
from dosewright.operators.lookups import not_in
from dosewright.operators.sets import union_by_name
from dosewright.session import stored
from dosewright.sinks import partitions
from dosewright.sinks.digests import DIGEST, with_digest, without_stored_copies
from dosewright.sources import archives, delimited, pages, quoted
from dosewright.sources.manifest import first_months, load_manifest, require_rows
from dosewright.spec import DERIVED_COLUMNS, RAW_COLUMNS, CurationSpec

# Month of the file a record came from, as YYYYMM.
PERIOD = "arquivo_periodo"
FILE = "arquivo_nome"
# Of lines, while they are counted: why they cannot be used, and whether values fit their columns.
PROBLEM, FIT = "arquivo_problema", "arquivo_cabe_"
#: Text of the months that are done and entered together.
GROUP_BYTES = 64 << 30


@dataclass(frozen=True)
class LandedFile:
    """A text file of one manifest month with its layout."""

    path: str
    year: int
    month: int
    layout: delimited.Layout

    @property
    def period(self) -> int:
        return self.year * 100 + self.month


def landed_files(
    spark: SparkSession, manifest: DataFrame, zip_folder: str, csv_folder: str, encoding: str
) -> list[LandedFile]:
    """Unpacks the archives of the manifest and settles how each file is read.

    What comes back to the driver is the manifest itself: a few values per
    month, never record data.
    """
    months = {
        f"{zip_folder.rstrip('/')}/{r.zip_filename}": (r.year, r.month)
        for r in manifest.select("zip_filename", "year", "month").collect()
    }
    unpacked = archives.unpack(spark, sorted(months), csv_folder, encoding)
    described = archives.described_lines(unpacked)
    return [
        LandedFile(
            r.csv_path,
            *months[r.zip_path],
            delimited.Layout.of_first_line(r.first_line, r.separator, r.has_header, encoding),
        )
        for r in described.collect()
    ]


@dataclass(frozen=True)
class Counted:
    """What was seen of one file."""

    lines: int = 0
    bad: int = 0
    open_quotes: int = 0
    shares: dict[str, float | None] = field(default_factory=dict)


def _name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _periods(spark: SparkSession, files: Iterable[LandedFile]) -> DataFrame:
    """Month of each file, to be joined: the plan does not grow with the files."""
    rows = sorted({(_name_of(f.path), f.period) for f in files})
    return spark.createDataFrame(rows, f"{FILE} string, {PERIOD} int")


def scan_landed(spark: SparkSession, files: list[LandedFile]) -> list[tuple[list[LandedFile], DataFrame]]:
    """The lines of the files, one frame per distinct layout, with the month and name of their file.

    Layouts stay apart until curation: a column one of them lacks is absent
    there, which is not the same as null.
    """
    groups: dict[delimited.Layout, list[LandedFile]] = defaultdict(list)
    for file in files:
        groups[file.layout].append(file)
    frames = []
    for layout, members in groups.items():
        lines = delimited.scan(spark, [f.path for f in members], layout)
        named = lines.withColumn(FILE, delimited.file_name(lines)).drop(quoted.FILE_NAME)
        frames.append((members, named.join(_periods(spark, members), FILE, "left")))
    return frames


def parsed(spark: SparkSession, files: list[LandedFile], spec: CurationSpec) -> tuple[DataFrame, dict[str, Counted]]:
    """Curated records of the files, and the counts of each file; one pass over the text.

    The fields of all lines are stored as they were read, for each layout, with what is counted in a
    few narrow columns, which are grouped by file: neither the plan nor the work a
    line grows with the number of files. Curation is left to whoever reads the records, so files that are
    read again are not curated twice. Records have the columns of their layouts, see :func:`full_width`.
    """
    frames, seen = [], {}
    for members, lines in scan_landed(spark, files):
        usable = F.col(delimited.PROBLEM).isNull()
        tests = {} if members[0].layout.header else delimited.alignment_tests(lines)
        marks = {FIT + c: F.when(usable & F.col(c).isNotNull(), fits) for c, fits in tests.items()}
        marked = lines.withColumns({PROBLEM: F.col(delimited.PROBLEM), **marks}).drop(delimited.PROBLEM, delimited.CORRUPT)
        lines = stored(marked, "parsed")
        counted = lines.groupBy(FILE).agg(
            F.count("*").alias("lines"),
            F.count(PROBLEM).alias("bad"),
            F.count_if(F.col(PROBLEM) == "open_quote").alias("open"),
            *(F.avg(F.col(c).cast("double")).alias(c) for c in marks),
        )
        for r in counted.collect():  # one row for each file of the manifest
            shares = {c.removeprefix(FIT): r[c] for c in marks}
            seen[r[FILE]] = Counted(r["lines"], r["bad"], r["open"], shares)
        frames.append(curate(lines.where(F.col(PROBLEM).isNull()).drop(PROBLEM, *marks), spec))
    return union_by_name(*frames), {_name_of(f.path): seen.get(_name_of(f.path), Counted()) for f in files}


def with_line_breaks(
    spark: SparkSession, files: list[LandedFile], records: DataFrame, counted: dict[str, Counted], spec: CurationSpec
) -> tuple[list[LandedFile], DataFrame, dict[str, Counted]]:
    """Reads files with open quotes again, as records that may go over several lines.

    A quote that nothing closes costs its own line, so the second reading always
    counts; see ``sources.quoted``.
    """
    again = [
        replace(f, layout=replace(f.layout, line_breaks=True)) for f in files if counted[_name_of(f.path)].open_quotes
    ]
    if not again:
        return files, records, counted
    joined, recounted = parsed(spark, again, spec)
    if len(again) < len(files):
        joined = union_by_name(records.join(_periods(spark, again).select(FILE), FILE, "left_anti"), joined)
    by_path = {f.path: f for f in again}
    return [by_path.get(f.path, f) for f in files], joined, counted | recounted


def full_width(df: DataFrame) -> DataFrame:
    """Adds the source columns a run lacks as nulls, after curation.

    The absent-column rules have been applied by then, and every run writes
    the same columns, so partitions of different runs fit together.
    """
    lacking = {c: F.lit(None).cast("string") for c in RAW_COLUMNS if c not in df.columns}
    for dated in ("data_vacina", "data_deletado_rnds"):
        if dated in lacking:
            lacking[dated] = F.lit(None).cast("date")
    if "numero_idade_paciente" in lacking:
        lacking["numero_idade_paciente"] = F.lit(None).cast("double")
    padded = df.withColumns(lacking) if lacking else df
    last = [c for c in (DIGEST, *partitions.PARTITION) if c in padded.columns]
    extra = [c for c in padded.columns if c not in (*RAW_COLUMNS, *DERIVED_COLUMNS, *last)]
    return padded.select(*RAW_COLUMNS, *extra, *DERIVED_COLUMNS, *last)


def month_groups(files: list[LandedFile], sizes: dict[str, int], group_bytes: int) -> list[list[LandedFile]]:
    """Files of whole months in order, as many to a group as fit its bytes, one month at least."""
    by_period: dict[int, list[LandedFile]] = defaultdict(list)
    for file in files:
        by_period[file.period].append(file)
    groups: list[list[LandedFile]] = []
    room = 0
    for period in sorted(by_period):
        size = sum(sizes.get(f.path, 0) for f in by_period[period])
        if groups and size <= room:
            groups[-1] += by_period[period]
            room -= size
        else:
            groups.append(list(by_period[period]))
            room = group_bytes - size
    return groups


def ingest_manifest(
    spark: SparkSession,
    manifest_path: str,
    data_dir: str,
    months: Iterable[int] | None = None,
    max_months: int | None = None,
    encoding: str = "ISO-8859-1",
    clear_selected_months: bool = False,
    skip_existing_months: bool = True,
    deduplicate: bool = False,
    spec: CurationSpec | None = None,
    check_alignment: bool = True,
    group_bytes: int = GROUP_BYTES,
    against_stored: bool = False,
) -> DataFrame:
    """Curates the months of a manifest into ``data_dir/processed``.

    Archives are expected in ``data_dir/raw/zip``. Finished months are skipped
    unless told otherwise; months written are replaced as a whole, so a
    repeated or interrupted run never doubles records. Months are done in
    groups of about ``group_bytes`` of text and entered as written group by
    group. A group is replaced only after all its files have been
    read and checked. With ``deduplicate`` no month gets a record that an earlier
    month of the run has, with ``against_stored`` none that any stored month has. Lines that cannot be used go to ``data_dir/quarantine``.
    Returns one row per month written:
    ``(year, month, original_records, records, quarantined_records)``.
    """
    spec = spec or CurationSpec()
    raw, processed = f"{data_dir}/raw", f"{data_dir}/processed"
    partitions.require_no_stream(processed)
    partitions.require_no_runs(processed)
    manifest = load_manifest(spark, manifest_path, months)
    manifest = require_rows(first_months(manifest, max_months))
    if skip_existing_months and not clear_selected_months:
        manifest = not_in(manifest, partitions.committed_months(spark, processed), "year", "month")
        if manifest.isEmpty():
            return spark.createDataFrame([], partitions.COUNT_SCHEMA)

    files = landed_files(spark, manifest, f"{raw}/zip", f"{raw}/csv", encoding)
    sizes = archives.text_sizes([f.path for f in files])
    groups = month_groups(files, sizes, group_bytes)
    done: list[tuple[int, int, int, int, int]] = []
    for group in groups:
        against = None if against_stored else [year * 100 + month for year, month, *_ in done]
        done += ingest_files(spark, group, data_dir, deduplicate, spec, check_alignment, against)
    return spark.createDataFrame(done, partitions.COUNT_SCHEMA)


def ingest_files(
    spark: SparkSession,
    files: list[LandedFile],
    data_dir: str,
    deduplicate: bool = False,
    spec: CurationSpec | None = None,
    check_alignment: bool = True,
    against: Sequence[int] | None = (),
) -> list[tuple[int, int, int, int, int]]:
    """Reads, checks, replaces and enters the months of ``files``; their counts as ``COUNT_SCHEMA``.

    With ``deduplicate`` copies are also looked for in the stored months ``against``
    (YYYYMM), in all others if that is None.
    The text is read once. Only files with lines that cannot be used are read
    again, for their quarantine.
    """
    spec = spec or CurationSpec()
    processed = f"{data_dir}/processed"
    records, counted = parsed(spark, files, spec)
    files, records, counted = with_line_breaks(spark, files, records, counted, spec)
    if check_alignment:
        for file in files:
            delimited.require_aligned(counted[_name_of(file.path)].shares, file.path)
    records = records.drop(FILE)
    periods = sorted({f.period for f in files})
    if deduplicate:
        records = _distinct(spark, records, processed, periods, spec, against)
    partitions.mark_open(spark, processed, periods)
    partitions.write_by_period(records, processed, PERIOD, keep_sensitive=spec.keep_sensitive, padded=full_width)
    write_quarantine(spark, [f for f in files if counted[_name_of(f.path)].bad], f"{data_dir}/quarantine")
    after = partitions.period_counts(records, PERIOD)
    before, bad = defaultdict(int), defaultdict(int)
    for f in files:
        before[f.period] += counted[_name_of(f.path)].lines
        bad[f.period] += counted[_name_of(f.path)].bad
    # a month that ends without records, or without unusable lines, keeps none of an earlier run
    partitions.remove_months(processed, [p for p in periods if not after.get(p)])
    partitions.remove_months(f"{data_dir}/quarantine", [p for p in periods if not bad[p]])
    rows = [(p // 100, p % 100, before[p], after.get(p, 0), bad[p]) for p in periods]
    partitions.commit_months(
        spark.createDataFrame(rows, partitions.COUNT_SCHEMA), processed, full_width(records.drop(PERIOD)).schema
    )
    return rows


def _distinct(
    spark: SparkSession,
    records: DataFrame,
    processed: str,
    periods: list[int],
    spec: CurationSpec,
    against: Sequence[int] | None,
) -> DataFrame:
    """Records without copies of each other or of records in other stored months, with their digests.

    Of equal records given, the earliest month keeps its copy; what is stored stays. Stored months
    are read in their digests only, unless digests meet.
    """
    apart = (*spec.sensitive_columns, PERIOD)
    compared = [c for c in records.columns if c not in apart]
    records = drop_exact_duplicates(records, apart, (PERIOD,))
    records = stored(with_digest(records, compared), "distinct")
    held = partitions.stored_digests(spark, processed, compared, periods, against)
    if held is None:
        return records

    def values(months: DataFrame) -> DataFrame:
        found = partitions.committed_rows(spark, processed, months.collect())  # a row a month
        return with_digest(found, [c for c in found.columns if c not in (*apart, *partitions.PARTITION)])

    before = partitions.stored_schema(spark, processed)
    more = [f for f in (before.fields if before else ()) if f.name not in (*records.columns, *apart, *partitions.PARTITION)]
    padded = records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more}) if more else records
    left = without_stored_copies(padded, held, values, [*compared, *(f.name for f in more)])
    return records if left is padded else stored(left.select(*records.columns), "distinct")


def write_quarantine(spark: SparkSession, files: list[LandedFile], root: str) -> None:
    """Writes the unusable lines of the files that have any, by month."""
    if not files:
        return
    lines = union_by_name(
        *(
            df.select(PERIOD, delimited.PROBLEM, delimited.CORRUPT, delimited.first_field(df))
            for _, df in scan_landed(spark, files)
        )
    )
    kept = lines.filter(F.col(delimited.PROBLEM).isNotNull()).select(
        F.col(delimited.PROBLEM).alias("problem"),
        F.col(delimited.CORRUPT).alias("line"),
        delimited.FIRST_FIELD,
        *(v.alias(k) for k, v in partitions.keys_of_period(F.col(PERIOD)).items()),
    )
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partitions.PARTITION
    ).parquet(root)


def ingest_pages(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    years: list[int] | None = None,
    deduplicate: bool = True,
    spec: CurationSpec | None = None,
    undated_dir: str | None = None,
    fields: Sequence[str] | None = None,
) -> dict[str, int]:
    """Adds saved API pages to partitions by event date; counts per kind.

    ``fields`` are the columns taken from the records, by the names they have
    there; without them all names that occur are looked for, which takes a pass
    of its own. Undated records go to
    ``undated_dir``, beside ``processed_dir`` where none is given.
    """
    spec = spec or CurationSpec()
    partitions.require_no_stream(processed_dir)
    records = pages.explode_pages(pages.load_pages(spark, raw_dir, years)).select("record")
    curated = curate(pages.records_table(records, list(fields) if fields else None), spec)
    if deduplicate:
        curated = drop_exact_duplicates(curated)
    return partitions.write_by_event_date(
        full_width(curated),
        processed_dir,
        undated_dir or f"{processed_dir.rstrip('/')}_undated",
        distinct=deduplicate,
        keep_sensitive=spec.keep_sensitive,
    )
