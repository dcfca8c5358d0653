"""File sources: mention CSVs (A3, C9), wide history CSV (A4), snapshots (A7), guard.

CSV files are read with an explicit all-string schema of positional columns
(``c0 .. c{n-1}``); nothing is inferred. The number of columns is that of the
widest row, found in a first narrow pass, so no cell is cut off. Quotes inside
a quoted field are doubled (``""``). Rows of one file block are read by one
task in file order, so a row's position inside its file is its
``monotonically_increasing_id`` minus the first id of the file's first block.
The rows are stored once with their ids, and all that follows reads the
stored rows: two scans of the files a load, whatever it computes. Blank lines
are skipped, so positions count non-blank lines.

By default (``multiline=True``) a file is one block, because a quoted field
may span lines. ``multiline=False`` lets Spark split large files into
blocks read in parallel: only rows of a file's first block get a position
(the header is always within its first rows); rows of later blocks are data
rows. Use it for big files whose fields never span lines.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from monthend.operators.reshape import history_from_positions
from monthend.session import materialize

# The two header names a mention file must carry, and how
# many leading non-blank rows are searched for them.
RATING_HEADER = "Calificación"
DATE_HEADER = "Fecha"
HEADER_SEARCH_ROWS = 10
SNAPSHOT_NAME = r"results_(\d{4}-\d{2}-\d{2})\.csv"


def require_path(spark: SparkSession, path: str | list[str]) -> None:
    """Fail before any job starts when ``path`` does not exist."""
    jvm = spark.sparkContext._jvm
    for one in [path] if isinstance(path, str) else path:
        p = jvm.org.apache.hadoop.fs.Path(one)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.globStatus(p):
            raise FileNotFoundError(one)


def csv_reader(spark: SparkSession, schema: str, multiline: bool) -> DataFrameReader:
    return (spark.read.schema(schema).option("header", False).option("multiLine", multiline)
            .option("mode", "PERMISSIVE").option("encoding", "UTF-8").option("escape", '"'))


def widest_row(spark: SparkSession, path: str | list[str], multiline: bool = True) -> int:
    """The most cells of any row: one pass that counts the commas outside quotes.

    Against a schema of one column every wider row is a malformed record,
    which Spark hands over whole.
    """
    record = F.coalesce("_record", F.lit(""))
    bare = F.regexp_replace(record, '"[^"]*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    rows = (csv_reader(spark, "c0 string, _record string", multiline)
            .option("columnNameOfCorruptRecord", "_record").csv(path))
    # Spark wants another column beside the record's
    return rows.agg(F.max(cells), F.count("c0")).first()[0] or 1


# Position given to rows outside a file's first block: after any header.
LATER_BLOCK = 1 << 62


def csv_rows(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """(file, mtime, _block, cells) of every row; each row has the cells of the widest."""
    width = widest_row(spark, path, multiline)
    return (csv_reader(spark, ", ".join(f"c{i} string" for i in range(width)), multiline).csv(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_modification_time").alias("mtime"),
                    F.col("_metadata.file_block_start").alias("_block"),
                    F.array(*[F.col(f"c{i}") for i in range(width)]).alias("cells")))


def with_positions(rows: DataFrame) -> DataFrame:
    """Add ``pos``: 0-based position of each non-blank row inside its file.

    Needs a frame straight off a file scan, which is stored once with its row
    ids. Only rows of a file's first block are numbered (one row per file goes
    through the shuffle for the first id); later blocks get LATER_BLOCK.
    """
    raw = materialize(rows.withColumn("_id", F.monotonically_increasing_id()))
    first = (raw.where(F.col("_block") == 0)
             .groupBy("file").agg(F.min("_id").alias("_first")))
    return (raw.join(first, "file", "left")
            .withColumn("pos", F.when(F.col("_block") == 0, F.col("_id") - F.col("_first"))
                        .otherwise(F.lit(LATER_BLOCK)))
            .drop("_id", "_first", "_block"))


def read_positional_csv(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Rows of every CSV under ``path`` as (file, mtime, cells, pos)."""
    require_path(spark, path)
    return with_positions(csv_rows(spark, path, multiline))


def _has(cells: str, text: str):
    return F.array_contains(F.col(cells), text)


def mentions_from_positions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A3 + C9 on positional rows; see :func:`read_mention_files`."""
    # one aggregate per file: its first row, and the first row with both names
    names = F.struct("pos", F.array_position("cells", RATING_HEADER).alias("_ri"),
                     F.array_position("cells", DATE_HEADER).alias("_di"))
    both = (F.col("pos") < HEADER_SEARCH_ROWS) & _has("cells", RATING_HEADER) & _has("cells", DATE_HEADER)
    headers = (raw.where(F.col("pos") < HEADER_SEARCH_ROWS).groupBy("file")
               .agg(F.min(F.when(both, names)).alias("_found"), F.min(names).alias("_first"))
               .select("file", F.coalesce("_found", "_first").alias("_h"))
               .select("file", F.col("_h.pos").alias("_hpos"), "_h._ri", "_h._di"))
    invalid = headers.where((F.col("_ri") == 0) | (F.col("_di") == 0)).select("file")
    valid = headers.where((F.col("_ri") > 0) & (F.col("_di") > 0))
    rows = (raw.join(valid, "file")
            .where(F.col("pos") > F.col("_hpos"))
            .select("file", *[c for c in ("mtime",) if c in raw.columns],
                    F.element_at("cells", F.col("_di").cast("int")).alias("Fecha"),
                    F.element_at("cells", F.col("_ri").cast("int")).alias("Calificacion")))
    return rows, invalid


def read_mention_files(spark: SparkSession, path: str | list[str],
                       multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """A3 + C9: mention rows of every file under ``path``.

    Per file, the header is the first of the first HEADER_SEARCH_ROWS rows
    holding both exact header names, else row 0. Returns ``(rows, invalid)``:
    ``rows`` = (file, mtime, Fecha, Calificacion) for the data rows after the
    header of valid files; ``invalid`` = files whose header lacks a required
    column (nothing is loaded from such a file).
    """
    raw = read_positional_csv(spark, path, multiline)
    rows, invalid = mentions_from_positions(raw)
    return rows, invalid.unionByName(files_without_rows(spark, path, raw))


def files_without_rows(spark: SparkSession, path: str | list[str], raw: DataFrame) -> DataFrame:
    """The files (``file``) under ``path`` that gave no row: empty ones, or those of blank lines only.

    Names come from the listing that every scan makes (a scan itself leaves
    empty files out); no content is read for it.
    """
    names = spark.read.format("binaryFile").load(path).inputFiles()
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", n),) for n in names], "file string")
    return listed.join(raw.select("file").distinct(), "file", "left_anti")


def read_history_files(spark: SparkSession, path: str | list[str], **params) -> tuple[DataFrame, DataFrame]:
    """A4 + I2 for every wide history CSV under ``path``, each with months of its own.

    ``(rows, refused)`` as ``reshape.history_from_positions`` gives them;
    files without a row are refused too.
    """
    raw = read_positional_csv(spark, path)
    rows, refused = history_from_positions(raw, **params)
    none = files_without_rows(spark, path, raw).select(
        "file", *[F.lit(None).cast("string").alias(c) for c in ("label", "text")], F.lit("file without rows").alias("reason"))
    return rows, refused.unionByName(none)


def read_history_file(spark: SparkSession, path: str) -> DataFrame:
    """A4: a wide history CSV as a frame named by its header row, plus ``_row``.

    ``_row`` is the 0-based position of a data row (the row after the header
    is 0). Only the header row is brought to the driver, to name columns.
    """
    raw = read_positional_csv(spark, path)
    heads = raw.where(F.col("pos") == 0).select("cells").limit(2).collect()
    if not heads:
        raise ValueError(f"empty history file: {path}")
    if len(heads) > 1:
        raise ValueError(f"one history file at a time (its header names the columns): {path}")
    head = heads[0]
    names = [c if c is not None else f"_c{i}" for i, c in enumerate(head.cells)]
    while names and names[-1].startswith("_c"):
        names.pop()
    return (raw.where(F.col("pos") > 0)
            .select((F.col("pos") - 1).alias("_row"),
                    *[F.col("cells")[i].alias(n) for i, n in enumerate(names)]))


def list_snapshots(spark: SparkSession, root: str) -> tuple[dict[str, dict], list[str]]:
    """The finalized snapshots below ``root`` (path -> date, length, newest change), and the rejected paths.

    Any path containing ``staging`` is rejected, so current-month progress
    never reaches the fact table, and so is a name without a valid date.
    """
    pattern = f"{root.rstrip('/')}/historical/results_*.csv"
    require_path(spark, pattern)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    taken, rejected = {}, []
    for status in fs.globStatus(path):
        name = status.getPath().toString()
        below_root = name.rsplit("/historical/", 1)[-1]
        date = _snapshot_date(below_root)
        if "staging" in below_root or date is None:
            rejected.append(name)
            continue
        parts = list(fs.listStatus(status.getPath()))
        taken[name] = {"date": date.isoformat(), "length": sum(p.getLen() for p in parts),
                       "changed": max([p.getModificationTime() for p in parts], default=0)}
    return taken, rejected


def read_snapshots(spark: SparkSession, root: str, schema: str = "Date date, Metric string, Value double",
                   only: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """A7 (older design notes): only ``historical/results_YYYY-MM-DD.csv``, or some of those (``only``).

    A header that does not match the schema fails the read. Returns the rows,
    with ``snapshot_date`` from the file name, and the rejected paths.
    """
    listed, rejected = list_snapshots(spark, root)
    taken = [p for p in listed if only is None or p in only]
    if not taken:
        empty = spark.createDataFrame([], schema).withColumn("snapshot_date", F.lit(None).cast("date"))
        return empty, rejected
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(taken)
          .withColumn("snapshot_date", F.to_date(F.regexp_extract(
              F.col("_metadata.file_path"), SNAPSHOT_NAME, 1), "yyyy-MM-dd")))
    return df, rejected


def snapshot_hashes(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """A fingerprint of the lines of each of these snapshots, whatever files they are dealt to."""
    lines = spark.read.text(paths).select(F.regexp_extract(F.col("_metadata.file_path"), f"({SNAPSHOT_NAME})", 1).alias("name"), "value")
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)"))
    found = lines.groupBy("name").agg(F.concat_ws("-", F.count(F.lit(1)), total(1), total(2)).alias("hash")).collect()
    by_name = {r["name"]: r["hash"] for r in found}     # a row a snapshot
    return {p: by_name.get(p.rsplit("/", 1)[-1], "empty") for p in paths}


def _snapshot_date(name: str) -> dt.date | None:
    """The date of a snapshot's file name, or None if it has no valid one."""
    m = re.fullmatch(SNAPSHOT_NAME, name)
    try:
        return dt.date.fromisoformat(m.group(1)) if m else None
    except ValueError:
        return None
