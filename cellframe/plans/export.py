"""Export of whole cell tables into dated partitions of published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import ExportSpec
from ..operators.assemble import REJECTS, assemble
from ..scratch import make_dir
from ..session import COMPILED_METHODS, packed_scans, session_settings, shuffle_into
from ..sinks.files import write_run
from ..sinks.tables import create_table, replace_partition, table_name
from .commits import GRACE, clean_up, retire
from .manifest import SNAPSHOT_PREFIX, freeze, freeze_files, read_manifest, read_snapshot

# Folders of a run that separates good rows from rejected ones.
STATE, GOOD, REJECTED = "state", "good", "rejected"


@dataclass(frozen=True)
class TableReport:
    """What an export wrote: ``rejected`` counts undecodable values by column.

    ``rejects_path`` holds the rows with such values, where they were told apart.
    """

    table: str
    path: str
    rows: int
    rejected_rows: int
    rejected: Mapping[str, int]
    rejects_path: str | None


def export(spark: SparkSession, specs: Sequence[ExportSpec], sources: Mapping[str, DataFrame | str],
           root: str, label: str, **options) -> list[str]:
    """Freeze, assemble, write and publish each spec's table; gives the table names.

    For the options and everything else see ``export_reports``.
    """
    return [report.table for report in export_reports(spark, specs, sources, root, label, **options)]


def export_reports(spark: SparkSession, specs: Sequence[ExportSpec], sources: Mapping[str, DataFrame | str],
                   root: str, label: str, *, partition: str = "dt", table_prefix: str = "",
                   snapshot_prefix: str = SNAPSHOT_PREFIX, on_error: str = "fail",
                   grace: float = GRACE) -> list[TableReport]:
    """Freeze, assemble, write and publish each spec's table; gives a report for each.

    ``sources`` maps a source name to its cells: a frame, which is copied into the
    snapshot, or a directory of immutable files, which is only listed. Every run writes a
    directory of its own; the partition moves there after its files are complete. The rows
    of an earlier run with the same label stay for ``grace`` seconds, for queries that were
    planned before. A run that fails leaves what was published.

    A value that does not decode fails the run, or is NULL with ``on_error='null'``. With
    ``'reject'`` rows that have one are not published: they go to a folder beside the good
    ones, with the values in ``rejects``. Rows are counted while they are written, so
    both folders and all counts take one pass over the cells.
    """
    reports = []
    for spec in specs:
        source = sources[spec.source]
        if isinstance(source, str):
            snapshot = freeze_files(spark, source, root, spec.source, label, prefix=snapshot_prefix, grace=grace)
        else:
            snapshot = freeze(source, root, spec.source, label, spec.families, prefix=snapshot_prefix, grace=grace)
        name = table_name(spec.table, table_prefix)
        tables = f"{root.rstrip('/')}/tables"
        manifest = read_manifest(spark, root).where(F.col("table_name") == spec.source)
        with (session_settings(spark, COMPILED_METHODS), packed_scans(spark, spec.max_partition_bytes),
              shuffle_into(spark, spec.num_files)):
            rows = assemble(read_snapshot(spark, manifest, snapshot, spec.families), spec.columns,
                            on_error=on_error, keep_key=on_error == "reject")
            report = _written(rows, spec, tables, name, partition, label, on_error == "reject")
        create_table(spark, spec, f"{tables}/{name}", partition, table_prefix)
        old = replace_partition(spark, name, partition, label, report.path)
        retire(spark, root, [] if old is None else [old.removesuffix(f"/{STATE}={GOOD}")])
        clean_up(spark, root, grace)
        reports.append(report)
    return reports


def _written(rows: DataFrame, spec: ExportSpec, tables: str, name: str, partition: str, label: str,
             rejecting: bool) -> TableReport:
    """Write a run of assembled rows; the counts are observed on their way to the files."""
    counted = Observation()
    if not rejecting:
        path = write_run(rows.observe(counted, F.count(F.lit(1)).alias("rows")), tables, name, partition, label)
        return TableReport(name, path, counted.get["rows"], 0, {}, None)
    bad = F.size(REJECTS) > 0
    names = F.transform(REJECTS, lambda r: r["column"])
    has = [F.count_if(F.array_contains(names, c.target)).alias(f"_{i}") for i, c in enumerate(spec.columns)]
    seen = rows.observe(counted, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"), *has)
    stated = seen.withColumn(STATE, F.when(bad, REJECTED).otherwise(GOOD)).withColumn(REJECTS, F.when(bad, F.col(REJECTS)))
    run = write_run(stated, tables, name, partition, label, by=STATE)
    make_dir(rows.sparkSession, f"{run}/{STATE}={GOOD}")  # there may be no good row
    counts = counted.get
    return TableReport(name, f"{run}/{STATE}={GOOD}", counts["rows"], counts["rejected"],
                       {c.target: counts[f"_{i}"] for i, c in enumerate(spec.columns) if counts[f"_{i}"]},
                       f"{run}/{STATE}={REJECTED}")
