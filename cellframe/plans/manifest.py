"""Snapshots as rows: naming, choosing, listing and making them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import count_matches, flat_name
from ..model import CELL, MANIFEST, VERSION
from ..operators.select import key_range
from ..scratch import entries, path_exists
from ..sources.cells import read_cells
from .commits import GRACE, clean_up, commit, committed, retire

# Columns of ``read_manifest`` besides ``MANIFEST``: a file's smallest and largest row key, if known.
KEY_RANGE = ("low_key", "high_key")

# Files of one scan where a directory is not read as a whole.
SCAN_FILES = 10_000

# Fixed value: how names of scheduled snapshots begin.
SNAPSHOT_PREFIX = "SNP_TS_"


def snapshot_name(prefix: Column | str, table: Column, label: Column) -> Column:
    """``<prefix><table>_<label>`` with ``:`` in the table name as ``_``."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, flat_name(table), F.lit("_"), label)


def latest_snapshots(manifest: DataFrame, prefix: str = SNAPSHOT_PREFIX) -> DataFrame:
    """Each table's newest snapshot with the given name prefix.

    The whole table name must match, so ``Item`` never finds a snapshot of
    ``ItemBase``. Equal times are settled by the greater name.
    """
    start = F.concat(F.lit(prefix), flat_name(F.col("table_name")), F.lit("_"))
    named = manifest.where(F.startswith("snapshot", start))
    newest = F.struct("creation_time", "snapshot")
    return named.groupBy("table_name").agg(
        F.max_by("snapshot", newest).alias("snapshot"),
        F.max("creation_time").alias("creation_time"))


def latest_snapshot(manifest: DataFrame, table: str, prefix: str = SNAPSHOT_PREFIX) -> DataFrame:
    """The newest snapshot of one table, as at most one row."""
    return latest_snapshots(manifest.where(F.col("table_name") == table), prefix)


def resolved_path(live: Column, archive: Column) -> Column:
    """Where a listed file lies now.

    A link to a link, seen by more than two ``=``, only exists in the archive;
    other files are live unless they have been archived meanwhile.
    """
    return F.when(count_matches(live, "=") > 2, archive).otherwise(F.coalesce(live, archive))


def snapshot_files(manifest: DataFrame, snapshot: str | DataFrame,
                   families: Sequence[str] | None = None) -> DataFrame:
    """``snapshot, family, path`` of the files of one or more snapshots.

    ``snapshot`` is a name, or a frame with a ``snapshot`` column. Files of other
    families and files that resolve to no path are left out.
    """
    if isinstance(snapshot, str):
        files = manifest.where(F.col("snapshot") == snapshot)
    else:
        files = manifest.join(snapshot.select("snapshot"), "snapshot", "left_semi")
    if families is not None:
        files = files.where(F.col("family").isin(list(families)))
    path = resolved_path(F.col("live_path"), F.col("archive_path"))
    return files.select("snapshot", "family", path.alias("path")).where(F.col("path").isNotNull())


def _record(files: DataFrame, root: str, name: str, table: str, run: str) -> list[str]:
    """Write a run's manifest rows and commit it as the snapshot's newest; gives the older runs.

    Rows go to a directory of the run, and the snapshot is what its last commit names, so
    runs of one name at the same time leave one of them, whole. A snapshot without a commit
    does not exist. Rows are gathered into as few files as Spark's target size allows.
    """
    spark = files.sparkSession
    place = f"table_name={_escaped(spark, table)}/snapshot={_escaped(spark, name)}"
    rows = files.hint("rebalance").select(
        F.current_timestamp().alias("creation_time"), "family", "live_path", F.lit(None).cast("string").alias("archive_path"),
        *[(F.col(c) if c in files.columns else F.lit(None).cast("string")).alias(c) for c in KEY_RANGE])
    rows.write.parquet(f"{_manifest_path(root)}/{place}/run={run}")
    log = f"{_commits_path(root)}/{place}"
    commit(spark, log, run)
    return [f"{_manifest_path(root)}/{place}/run={r}" for r in committed(spark, log)[:-1]]


def _escaped(spark: SparkSession, name: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _commits_path(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def _name(table: str, label: str, prefix: str) -> str:
    return f"{prefix}{table.replace(':', '_')}_{label}"


def _listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``family, live_path`` of all files below a directory; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
    family = F.regexp_extract("path", "/family=([^/]+)/", 1)
    return files.select(F.nullif(_unescaped(family), F.lit("")).alias("family"), F.col("path").alias("live_path"))


def _with_key_ranges(spark: SparkSession, files: DataFrame, path: str) -> DataFrame:
    """Each listed file with its smallest and largest row key; only keys are read."""
    if files.isEmpty():
        return files
    keys = read_cells(spark, path).select("row_key", _plain(_unescaped(F.col("_metadata.file_path"))).alias("_path"))
    ranges = keys.groupBy("_path").agg(F.min("row_key").alias("low_key"), F.max("row_key").alias("high_key"))
    return files.join(ranges, _plain("live_path") == F.col("_path"), "left").drop("_path")


def freeze(cells: DataFrame, root: str, table: str, label: str, families: Sequence[str] = (), *,
           prefix: str = SNAPSHOT_PREFIX, grace: float = GRACE, key_files: int | None = None) -> str:
    """Copy a frame into a snapshot, replacing one of the same name; gives its name.

    With ``families`` only those are copied, one directory each, so later reads
    open what they need; families without cells have no files. The copy goes to a new
    directory, and the snapshot is that copy once it is complete and committed. Copies that
    it replaces stay for ``grace`` seconds. Use ``freeze_files`` where the files never change.

    With ``key_files`` the copy is cut into about so many ranges of row keys, in order, and
    the manifest knows each file's range, so that reads of a range of keys open few files.
    """
    spark, name, run = cells.sparkSession, _name(table, label, prefix), uuid.uuid4().hex
    copies = f"{root.rstrip('/')}/data/{name}"
    data = f"{copies}/{run}"
    if families:
        cells = cells.where(F.col("family").isin(list(families)))
    if key_files:
        order = ["family"] * bool(families) + ["row_key", *VERSION]
        cells = cells.repartitionByRange(key_files, "row_key", *VERSION).sortWithinPartitions(*order)
    (cells.write.partitionBy("family") if families else cells.write).parquet(data)
    files = _listing(spark, data)
    if key_files:
        files = _with_key_ranges(spark, files, data)
    none = spark.createDataFrame([(None,) * len(files.columns)], files.schema)
    old = _record(none if files.isEmpty() else files, root, name, table, run)
    retire(spark, root, [*old, *(f"{copies}/{path.rpartition('run=')[2]}" for path in old)])
    clean_up(spark, root, grace)
    return name


def freeze_files(spark: SparkSession, path: str, root: str, table: str, label: str, *,
                 prefix: str = SNAPSHOT_PREFIX, grace: float = GRACE) -> str:
    """Snapshot a directory of immutable files by listing them; copies no data.

    Files added later are not in the snapshot. ``family=…`` in a path gives the
    file's family.
    """
    name = _name(table, label, prefix)
    retire(spark, root, _record(_listing(spark, path), root, name, table, uuid.uuid4().hex))
    clean_up(spark, root, grace)
    return name


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots as last committed, with the files' ranges of row keys where they are known.

    Filters on ``table_name`` and ``snapshot`` open only their files.
    """
    place = T.StructType([MANIFEST["table_name"], MANIFEST["snapshot"]])
    runs = T.StructType([f for f in MANIFEST if f not in place.fields]
                        + [T.StructField(c, T.StringType()) for c in KEY_RANGE]
                        + place.fields + [T.StructField("run", T.StringType())])
    commits = spark.read.schema(T.StructType([T.StructField("run", T.StringType()), *place])).text(_commits_path(root))
    newest = commits.groupBy("table_name", "snapshot").agg(F.max_by("run", F.col("_metadata.file_name")).alias("run"))
    rows = spark.read.schema(runs).parquet(_manifest_path(root))
    return rows.join(newest, ["table_name", "snapshot", "run"], "left_semi").select(*MANIFEST.names, *KEY_RANGE)


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _plain(path: Column | str) -> Column:
    """A path as text that is the same wherever Spark shows it."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def _listed_here(spark: SparkSession, files: list[Row]) -> list[tuple[str, str | None]]:
    """The same as ``_files_now`` for a bounded number of files, by listing their directories."""
    places = {path.rpartition("/")[0] for file in files for path in (file.live, file.archive) if path}
    present = {f"{d}/{name}" for d in places for name in entries(spark, d) if name[0] not in "_."}
    chosen = {path for file in files if (path := file.live if file.live in present else file.archive) in present}
    strays = {path.rpartition("/")[0] for path in present - chosen}
    return sorted({(d, path if d in strays else None) for path in chosen for d in [path.rpartition("/")[0]]},
                  key=lambda r: (r[0], r[1] or ""))


def _files_now(spark: SparkSession, files: DataFrame) -> list[tuple[str, str | None]]:
    """``directory, path`` of the files that ``live, archive`` stand for now.

    A directory that holds no other files is named alone.
    """
    places = files.select(F.explode(F.array("live", "archive")).alias("path")).where("path IS NOT NULL")
    found = [r.d for r in places.select(_directory(F.col("path")).alias("d")).distinct().collect()]
    found = [d for d in found if path_exists(spark, d)]
    if not found:
        return []
    present = spark.read.format("binaryFile").load(found).select(_plain("path").alias("path"))
    live = present.select(F.col("path").alias("live"), F.lit(True).alias("is_live"))
    chosen = files.join(live, "live", "left").select(
        F.when(F.col("is_live"), F.col("live")).otherwise(F.col("archive")).alias("path")).distinct()
    listed = present.join(chosen.withColumn("chosen", F.lit(True)), "path", "left").select(
        "path", "chosen", _directory(F.col("path")).alias("directory"))
    whole = F.count_if(F.col("chosen").isNull()).over(Window.partitionBy("directory")) == 0
    named = listed.withColumn("whole", whole).where("chosen").select("directory", F.when(~F.col("whole"), F.col("path")).alias("path"))
    return sorted((tuple(r) for r in named.distinct().collect()), key=lambda r: (r[0], r[1] or ""))


def read_snapshot(spark: SparkSession, manifest: DataFrame, snapshot: str,
                  families: Sequence[str] | None = None, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """The cells of a snapshot with ``lo <= row_key < hi``, from the files of the wanted families only.

    Files whose range of keys is known and lies outside are not opened. A file that has
    gone from its live path is read from the archive; files that are in neither place are
    left out, and so are families without files. A directory that holds nothing but wanted
    files is read as a whole, only its name comes to the driver; of others the wanted files
    are scanned by name, ``SCAN_FILES`` at a time, as Spark's own list of a table's files
    would name them. Cells are never joined or shuffled.
    """
    named, wanted = manifest.where(F.col("snapshot") == snapshot), F.lit(True)
    if families is not None:
        wanted = wanted & F.coalesce(F.col("family").isin(list(families)), F.lit(False))
    if set(KEY_RANGE) <= set(manifest.columns):
        if lo is not None:
            wanted = wanted & (F.col("high_key").isNull() | (F.col("high_key") >= lo))
        if hi is not None:
            wanted = wanted & (F.col("low_key").isNull() | (F.col("low_key") < hi))
    files = named.select(wanted.alias("wanted"), _plain("live_path").alias("live"), _plain("archive_path").alias("archive"))
    few = files.limit(SCAN_FILES + 1).collect()
    if not few:
        raise ValueError(f"no snapshot {snapshot!r}")
    found = (_listed_here(spark, [f for f in few if f.wanted]) if len(few) <= SCAN_FILES
             else _files_now(spark, files.where("wanted").drop("wanted")))
    cells, scans = spark.createDataFrame([], CELL), {}
    for directory, path in found:
        lists = scans.setdefault(directory.split("/family=")[0], [[]])
        if path is not None and (len(lists) == 1 or len(lists[-1]) == SCAN_FILES):
            lists.append([])
        (lists[0] if path is None else lists[-1]).append(path or directory)
    for base, lists in sorted(scans.items()):
        for paths in filter(None, lists):
            cells = cells.unionByName(key_range(read_cells(spark, paths, base=base).select(*CELL.names), lo, hi))
    return cells
