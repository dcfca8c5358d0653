"""Wide -> long reshapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.functions.calendar import last_day_of, two_digit_year
from monthend.functions.numeric import missing_text, text_to_int
from monthend.functions.text import spanish_month_number

# History rows by position -> metric id (total, positive,
# negative, neutral), and the first month column the upload reads.
HISTORY_ROW_IDS = [13, 14, 15, 16]
HISTORY_FIRST_COLUMN = "ene-24"


def wide_to_long(df: DataFrame, ids: list[str], values: dict[str, str],
                 name_col: str = "Metric", value_col: str = "valor") -> DataFrame:
    """One row per (ids, measure); ``values`` maps column -> metric label.

    ``unpivot`` is a per-row expansion (no shuffle); the labels are fixed
    text, so the mapping is a literal map rather than a join.
    """
    long = df.unpivot(ids, list(values), "_measure", value_col)
    label = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])
    return long.select(*ids, F.try_element_at(label, F.col("_measure")).alias(name_col),
                       F.col(value_col).cast("double").alias(value_col))


def history_month_columns(columns: list[str], first: str = HISTORY_FIRST_COLUMN) -> list[str]:
    """From column ``first`` on, the columns whose name contains ``-``.

    Raises on duplicate month columns (T12), which cannot be told apart.
    """
    out, on = [], False
    for c in columns:
        if c == first:
            on = True
        if on and "-" in c:
            out.append(c)
    dup = sorted({c for c in out if out.count(c) > 1})
    if dup:
        raise ValueError(f"duplicate month columns in history file: {dup}")
    return out


def history_to_long(wide: DataFrame, row_col: str = "_row",
                    first: str = HISTORY_FIRST_COLUMN) -> DataFrame:
    """Wide history (rows by position, one column per ``mmm-yy``) -> fact rows.

    Only the first four rows by position are read (C4): total, positive,
    negative, neutral, which become ids 13-16. Blank cells become 0; text is
    read as a number and truncated (J12). Result: (fecha, metrica, valor).
    """
    months = history_month_columns([c for c in wide.columns if c != row_col], first)
    if not months:
        return wide.sparkSession.createDataFrame([], "fecha date, metrica int, valor double")
    pos = F.create_map(*[x for i, m in enumerate(HISTORY_ROW_IDS) for x in (F.lit(i), F.lit(m))])
    cells = _cells(wide, row_col, months)
    parts = F.split(F.col("_label"), "-")
    return cells.select(
        last_day_of(two_digit_year(parts.getItem(1)),
                    spanish_month_number(parts.getItem(0))).alias("fecha"),
        F.try_element_at(pos, F.col("_rank")).cast("int").alias("metrica"),
        F.coalesce(text_to_int(F.col("_text")), F.lit(0)).cast("double").alias("valor"))


def _cells(wide: DataFrame, row_col: str, months: list[str]) -> DataFrame:
    """(_rank, _label, _text) for the first four rows by position.

    An explode, not ``unpivot``: with what follows, the code generated for
    the latter does not compile, and the job falls back to slower plans.
    """
    cell = lambda m: F.struct(F.lit(m).alias("_label"), F.col(f"`{m}`").cast("string").alias("_text"))
    return (wide.where(F.col(row_col) < len(HISTORY_ROW_IDS))
            .select(F.col(row_col).alias("_rank"), F.explode(F.array(*[cell(m) for m in months])).alias("_cell"))
            .select("_rank", "_cell._label", "_cell._text"))


def history_bad_cells(wide: DataFrame, row_col: str = "_row",
                      first: str = HISTORY_FIRST_COLUMN) -> DataFrame:
    """Cells of the read rows that hold text but not a number (e.g. ``1,234``).

    Missing values (``N/A``, ``nan``, blank) are not among them; they load as 0.
    """
    months = history_month_columns([c for c in wide.columns if c != row_col], first)
    if not months:
        return wide.sparkSession.createDataFrame([], "_rank int, _label string, _text string")
    return (_cells(wide, row_col, months)
            .where(~missing_text("_text") & text_to_int("_text").isNull()))


# ---- many history files in one job: the header is data

HISTORY_ROWS = "file string, mtime timestamp, pos long, cells array<string>"


def history_labels(raw: DataFrame, first: str = HISTORY_FIRST_COLUMN) -> DataFrame:
    """C5 + T12 for any number of files: ``file, place, label, copies`` of their month columns.

    ``raw`` has rows ``(file, pos, cells)``; a file's row 0 is its header. Its
    month columns are those from the column ``first`` on whose name contains
    ``-``; ``copies`` tells how often the file names that month. No header
    reaches the driver.
    """
    cells = raw.where(F.col("pos") == 0).select("file", F.posexplode("cells").alias("place", "label"))
    begin = cells.where(F.col("label") == first).groupBy("file").agg(F.min("place").alias("begin"))
    months = cells.join(begin, "file").where((F.col("place") >= F.col("begin")) & F.col("label").contains("-"))
    copies = months.groupBy("file", "label").agg(F.count(F.lit(1)).alias("copies"))
    return months.select("file", "place", "label").join(copies, ["file", "label"])


def history_cells(raw: DataFrame, first: str = HISTORY_FIRST_COLUMN) -> DataFrame:
    """A4 + C4: ``file, mtime, row, label, text, copies`` of the month cells of each file's first four rows.

    Cells are exploded by position and meet their own file's header: a file
    has four rows here, so no file is a large group however many rows it has.
    """
    read = raw.where(F.col("pos").between(1, len(HISTORY_ROW_IDS)))
    cells = read.select("file", "mtime", (F.col("pos") - 1).cast("int").alias("row"), F.posexplode("cells").alias("place", "text"))
    return cells.join(history_labels(raw, first), ["file", "place"]).drop("place")


def history_from_positions(raw: DataFrame, first: str = HISTORY_FIRST_COLUMN) -> tuple[DataFrame, DataFrame]:
    """A4, C4, C5, I2, J12-J15 for any number of history files with months of their own.

    Returns ``(rows, refused)``: ``rows`` = ``file, mtime, fecha, metrica,
    valor`` as ``history_to_long`` gives them for each file alone; ``refused``
    = ``file, label, text, reason`` of the month columns a file names twice
    (T12), of labels that are no month, and of cells that hold text but not a
    number. A file with a refused column or cell gives no rows.
    """
    cells = history_cells(raw, first)
    parts = F.split("label", "-")
    cells = cells.withColumns({
        "fecha": last_day_of(F.lit(2000) + parts.getItem(1).try_cast("int"), spanish_month_number(parts.getItem(0))),
        "number": text_to_int(F.col("text"))})
    reason = (F.when(F.col("copies") > 1, "month column named twice")
              .when(F.col("fecha").isNull(), "column is no month")
              .when(~missing_text("text") & F.col("number").isNull(), "cell is no number"))
    judged = cells.withColumn("reason", reason)
    refused = judged.where(F.col("reason").isNotNull()).select("file", "label", "text", "reason")
    position = F.create_map(*[x for i, m in enumerate(HISTORY_ROW_IDS) for x in (F.lit(i), F.lit(m))])
    rows = judged.join(refused.select("file").distinct(), "file", "left_anti").select(
        "file", "mtime", "fecha", F.try_element_at(position, F.col("row")).cast("int").alias("metrica"),
        F.coalesce("number", F.lit(0)).cast("double").alias("valor"))
    return rows, refused


def history_updates(rows: DataFrame) -> DataFrame:
    """``fecha, metrica, valor, _order`` for the upsert: of several files naming a month the newest wins, then the last name."""
    return rows.select("fecha", "metrica", "valor", F.struct("mtime", "file").alias("_order"))
