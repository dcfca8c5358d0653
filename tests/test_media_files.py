"""Mention files (A3, C9, E4, E5, J1, J4), history file."""

import datetime as dt
import os

import pytest

from monthend.operators import media as M
from monthend.operators import reshape as R
from monthend.plans import media_load as ML
from monthend.sources import files as FS

D = dt.date

MENTIONS = """Reporte mensual,,

Fecha,Calificación,Medio
2025-01-05, Positiva ,A
2025-01-09,NEGATIVA,B
2025-1-12,neutra,C
2025-02-30,mixta,D
,,E
"""

HISTORY = """Concepto,dic-23,ene-24,feb-24,Nota
Total,9,10,24.9,x
Positivas,3,5,,x
Negativas,3,2,4,x
Neutras,3,3,1,x
Suma,0,0,0,x
"""


def write(path, name, text):
    p = path / name
    p.write_text(text, encoding="utf-8")
    return p


def test_mention_file_golden(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    write(d, "enero.csv", MENTIONS)
    rows, invalid = FS.read_mention_files(spark, str(d))
    assert invalid.count() == 0
    c = M.mention_counts(rows).collect()[0]
    assert (c.total, c.positive, c.negative, c.neutral) == (5, 1, 1, 1)
    assert M.report_month(rows).collect()[0].fecha == D(2025, 1, 31)
    metrics = {r.Metric: r.valor for r in M.mention_metrics(rows).collect()}
    assert metrics == {"Total Media Mentions": 5.0, "Positive Media Mentions": 1.0,
                       "Negative Media Mentions": 1.0, "Neutral Media Mentions": 1.0}


def test_many_files_one_job_and_missing_columns(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    write(d, "a.csv", MENTIONS)
    write(d, "b.csv", "Fecha,Calificación\n2024-03-01,positiva\n2024-03-02,Positiva\n")
    write(d, "c.csv", "Fecha,Rating\n2024-03-01,positiva\n")
    rows, invalid = FS.read_mention_files(spark, str(d))
    assert [r.file.rsplit("/", 1)[1] for r in invalid.collect()] == ["c.csv"]
    got = {r.file.rsplit("/", 1)[1]: (r.total, r.positive) for r in M.mention_counts(rows).collect()}
    assert got == {"a.csv": (5, 1), "b.csv": (2, 2)}
    with pytest.raises(ValueError, match="c.csv"):
        ML.media_monthly_load(spark, str(d), spark.createDataFrame([], "fecha date, metrica int, valor double"),
                              ML.media_glossary_rows(spark))


def test_header_beyond_search_window_falls_back_to_row0(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    pre = "".join(f"nota {i},,\n" for i in range(10))
    write(d, "late.csv", pre + "Fecha,Calificación,x\n2024-01-01,positiva,1\n")
    rows, invalid = FS.read_mention_files(spark, str(d))
    assert invalid.count() == 1 and rows.count() == 0


def test_mode_year_and_month_taken_separately(spark):
    df = spark.createDataFrame([("f", x, "positiva") for x in
                                ["2024-12-30", "2024-12-31", "2025-01-01", "2025-01-02"]],
                               "file string, Fecha string, Calificacion string")
    assert M.report_month(df).collect()[0].fecha == D(2024, 1, 31)


def test_unicode_strip_and_strict_dates(spark):
    from monthend.functions.text import clean_label, parse_iso_date
    df = spark.createDataFrame([(" Positiva\t", "2025-1-5"), ("neutra", "2025-01-05 10:00"),
                                ("x", " 2025-01-05"), ("y", "2025-02-30")], "r string, d string")
    got = df.select(clean_label("r").alias("r"), parse_iso_date("d").alias("d")).collect()
    assert [g.r for g in got] == ["positiva", "neutra", "x", "y"]
    assert [g.d for g in got] == [D(2025, 1, 5), None, None, None]


def test_history_file_golden(spark, tmp_path):
    p = write(tmp_path, "hist.csv", HISTORY)
    wide = FS.read_history_file(spark, str(p))
    got = sorted(tuple(r) for r in R.history_to_long(wide).collect())
    assert got == sorted([
        (D(2024, 1, 31), 13, 10.0), (D(2024, 1, 31), 14, 5.0), (D(2024, 1, 31), 15, 2.0), (D(2024, 1, 31), 16, 3.0),
        (D(2024, 2, 29), 13, 24.0), (D(2024, 2, 29), 14, 0.0), (D(2024, 2, 29), 15, 4.0), (D(2024, 2, 29), 16, 1.0)])
    assert R.history_bad_cells(wide).count() == 0


def test_history_duplicate_month_rejected(spark, tmp_path):
    p = write(tmp_path, "dup.csv", "Concepto,ene-24,ene-24\nTotal,1,2\nP,1,1\nN,0,0\nU,0,1\n")
    with pytest.raises(ValueError, match="duplicate"):
        R.history_to_long(FS.read_history_file(spark, str(p)))


def test_history_bad_cells_listed(spark, tmp_path):
    p = write(tmp_path, "bad.csv", "Concepto,ene-24\nTotal,\"1,234\"\nP,1\nN,0\nU,0\n")
    wide = FS.read_history_file(spark, str(p))
    assert [r._text for r in R.history_bad_cells(wide).collect()] == ["1,234"]


def test_history_load_seeds_glossary_and_is_idempotent(spark, tmp_path):
    p = write(tmp_path, "hist.csv", HISTORY)
    g0 = spark.createDataFrame([(13, "Old Name"), (1, "A Views")], "metrica int, nombre string")
    target = spark.createDataFrame([(D(2024, 1, 31), 13, 99.0), (D(2023, 12, 31), 1, 5.0)],
                                   "fecha date, metrica int, valor double")
    fact1, g1 = ML.media_history_load(spark, str(p), target, g0)
    fact2, _ = ML.media_history_load(spark, str(p), fact1, g1)
    assert sorted(tuple(r) for r in fact1.collect()) == sorted(tuple(r) for r in fact2.collect())
    assert {(r.metrica, r.nombre) for r in g1.collect()} == {
        (13, "Old Name"), (1, "A Views"), (14, "Positive Media Mentions"),
        (15, "Negative Media Mentions"), (16, "Neutral Media Mentions")}
    assert fact1.where("metrica = 13 and fecha = date'2024-01-31'").first().valor == 10.0
    assert fact1.count() == 1 + 8


def test_missing_file_guard(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        FS.read_mention_files(spark, str(tmp_path / "nope.csv"))


def test_snapshots_reject_staging(spark, tmp_path):
    from monthend.plans.report import write_snapshot
    df = spark.createDataFrame([(D(2024, 1, 31), "A", 1.0)], "Date date, Metric string, Value double")
    write_snapshot(df, str(tmp_path), "historical", D(2024, 1, 31))
    write_snapshot(df.selectExpr("Date", "Metric", "Value + 1 as Value"), str(tmp_path), "current", D(2024, 2, 10))
    write_snapshot(df, str(tmp_path), "historical", D(2024, 2, 29))
    (tmp_path / "historical" / "results_old.csv").write_text("Date,Metric,Value\n2024-01-31,A,9\n")
    (tmp_path / "historical" / "results_2024-02-30.csv").write_text("Date,Metric,Value\n2024-01-31,A,9\n")
    rows, rejected = FS.read_snapshots(spark, str(tmp_path))
    assert sorted((r.Value, r.snapshot_date) for r in rows.collect()) == [(1.0, D(2024, 1, 31)), (1.0, D(2024, 2, 29))]
    assert sorted(p.rsplit("/", 1)[1] for p in rejected) == ["results_2024-02-30.csv", "results_old.csv"]


def test_snapshot_with_reordered_header_fails(spark, tmp_path):
    (tmp_path / "historical").mkdir()
    (tmp_path / "historical" / "results_2024-01-31.csv").write_text("Metric,Date,Value\nA,2024-01-31,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        FS.read_snapshots(spark, str(tmp_path))[0].collect()


def test_history_reader_takes_one_file(spark, tmp_path):
    write(tmp_path, "a.csv", HISTORY)
    write(tmp_path, "b.csv", HISTORY)
    with pytest.raises(ValueError, match="one history file"):
        FS.read_history_file(spark, str(tmp_path))


def test_large_file_split_into_blocks_gives_same_counts(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    body = "".join(f"2024-01-{i % 28 + 1:02d},{['positiva', 'negativa', 'neutra', 'otra'][i % 4]},m{i}\n"
                   for i in range(4000))
    write(d, "big.csv", "Reporte mensual,,\n\nFecha,Calificación,Medio\n" + body)
    write(d, "small.csv", MENTIONS)
    one, _ = FS.read_mention_files(spark, str(d))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split, invalid = FS.read_mention_files(spark, str(d), multiline=False)
        blocks = FS.csv_rows(spark, str(d), multiline=False).select("_block").distinct().count()
        got_split = sorted(map(tuple, M.mention_counts(split).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert blocks > 5 and invalid.count() == 0
    assert got_split == sorted(map(tuple, M.mention_counts(one).collect()))
    big = [r for r in got_split if r[0].endswith("big.csv")][0]
    assert big[1:] == (4000, 1000, 1000, 1000)


QUOTED = """Titular,Fecha,Calificación
"Dice ""hola"", y sigue",2025-01-05,positiva
"uno, dos",2025-01-06,negativa
simple,2025-01-07,neutra
"""


@pytest.mark.parametrize("multiline", [True, False])
def test_quoted_headlines(spark, tmp_path, multiline):
    write(tmp_path, "q.csv", QUOTED)
    rows, invalid = FS.read_mention_files(spark, str(tmp_path / "q.csv"), multiline=multiline)
    assert invalid.count() == 0
    assert sorted(r.Fecha for r in rows.collect()) == ["2025-01-05", "2025-01-06", "2025-01-07"]
    assert M.mention_counts(rows).first()[1:] == (3, 1, 1, 1)


def test_field_over_several_lines(spark, tmp_path):
    write(tmp_path, "m.csv", 'Titular,Fecha,Calificación\n"uno,\ndos ""tres""\n",2025-01-05,positiva\n')
    rows, _ = FS.read_mention_files(spark, str(tmp_path / "m.csv"))
    assert [(r.Fecha, r.Calificacion) for r in rows.collect()] == [("2025-01-05", "positiva")]


def test_history_of_96_months_and_wide_mentions(spark, tmp_path):
    months = [f"{m}-{y}" for y in range(24, 32) for m in
              ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")]
    body = "".join(f"r{i}," + ",".join(str(i + k) for k in range(96)) + "\n" for i in range(4))
    p = write(tmp_path, "hist.csv", "Concepto," + ",".join(months) + "\n" + body)
    got = R.history_to_long(FS.read_history_file(spark, str(p)))
    assert got.count() == 4 * 96 and got.where("fecha = date'2031-12-31' and metrica = 16").first().valor == 98.0
    wide = write(tmp_path, "wide.csv", ",".join(f"x{i}" for i in range(80)) + ",Fecha,Calificación\n"
                 + "," * 80 + "2025-01-05,positiva\n")
    rows, invalid = FS.read_mention_files(spark, str(wide))
    assert invalid.count() == 0 and [r.Fecha for r in rows.collect()] == ["2025-01-05"]


def test_missing_and_odd_numbers_in_history(spark, tmp_path):
    p = write(tmp_path, "odd.csv", "Concepto,ene-24,feb-24,mar-24\nTotal,N/A,nan,24.9\nP,NULL,,-3.7\nN,NA,1e3,2\nU,Infinity,1e30,x\n")
    wide = FS.read_history_file(spark, str(p))
    assert sorted(r._text for r in R.history_bad_cells(wide).collect()) == ["1e30", "Infinity", "x"]
    got = {(r.fecha.month, r.metrica): r.valor for r in R.history_to_long(wide).collect()}
    assert got[1, 13] == got[2, 13] == got[1, 14] == got[2, 14] == got[1, 15] == got[1, 16] == got[3, 16] == 0.0
    assert (got[3, 13], got[3, 14], got[2, 15]) == (24.0, -3.0, 1000.0)


def test_last_file_of_a_month_wins_whole(spark):
    rows = ([("a", "2024-01-05", "positiva")] * 5 + [("b", "2024-01-06", "negativa")] * 2 + [("a", "x", None)])
    df = spark.createDataFrame(rows, "file string, Fecha string, Calificacion string")
    got = {r.metrica: r.valor for r in ML.mention_updates(df, ML.media_glossary_rows(spark)).collect()}
    assert got == {13: 2.0, 14: 0.0, 15: 2.0, 16: 0.0}
    stamped = df.selectExpr("*", "case file when 'a' then timestamp'2024-03-01' else timestamp'2024-02-01' end as mtime")
    got = {r.metrica: r.valor for r in ML.mention_updates(stamped, ML.media_glossary_rows(spark)).collect()}
    assert got == {13: 6.0, 14: 5.0, 15: 0.0, 16: 0.0}


def test_a_load_scans_its_files_twice(spark, tmp_path):
    """Once for the width, once for the rows, which are stored; everything else reads these."""
    write(tmp_path, "a.csv", MENTIONS)
    rows, _ = FS.read_mention_files(spark, str(tmp_path / "a.csv"))
    plan = ML.mention_updates(rows, ML.media_glossary_rows(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.lower() or "Relation" not in plan


def history(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")


def test_many_history_files_in_one_job(spark, tmp_path):
    """Files with months, widths and positions of their own equal the single-file reader, file by file."""
    texts = {
        "a.csv": "Concepto,dic-23,ene-24,feb-24\nT,9,4,5\nP,9,1.9,N/A\nN,9,-2.5,\nX,9,1,nan\nextra,1,1,1\n",
        "b.csv": "\nene-24,Nota,MAR-24,dic-25\n7,x,8,9\n\n1,x,2,3\n",
        "c.csv": "Concepto,feb-24\nT,4\n",                      # no ene-24: no month columns
        "d d.csv": '"Concepto, todo",ene-24\n"T ""x""",3\n',
    }
    for name, text in texts.items():
        history(tmp_path, name, text)
    rows_, refused = FS.read_history_files(spark, str(tmp_path / "*.csv"))
    assert refused.count() == 0
    got = sorted((r.file.rsplit("/", 1)[1], r.fecha, r.metrica, r.valor) for r in rows_.collect())
    want = []
    for name in texts:
        one = R.history_to_long(FS.read_history_file(spark, str(tmp_path / name)))
        want += [(name.replace(" ", "%20"), *r) for r in map(tuple, one.collect())]
    assert got == sorted(want) and len(got) == 8 + 6 + 1


def test_history_files_that_cannot_be_loaded(spark, tmp_path):
    history(tmp_path, "good.csv", "c,ene-24\nT,1\n")
    history(tmp_path, "twice.csv", "c,ene-24,feb-24,feb-24\nT,1,2,3\n")
    history(tmp_path, "odd.csv", 'c,ene-24,foo-24,mar-x,abr-24\nT,1,2,3,"1,234"\n')
    history(tmp_path, "empty.csv", "")
    history(tmp_path, "blank.csv", "\n\n")
    rows_, refused = FS.read_history_files(spark, str(tmp_path))
    assert {r.file.rsplit("/", 1)[1] for r in rows_.collect()} == {"good.csv"}
    assert sorted((r.file.rsplit("/", 1)[1], r.label, r.text, r.reason) for r in refused.collect() if r.label) == [
        ("odd.csv", "abr-24", "1,234", "cell is no number"), ("odd.csv", "foo-24", "2", "column is no month"),
        ("odd.csv", "mar-x", "3", "column is no month"),
        ("twice.csv", "feb-24", "2", "month column named twice"), ("twice.csv", "feb-24", "3", "month column named twice")]
    assert sorted(r.file.rsplit("/", 1)[1] for r in refused.collect() if not r.label) == ["blank.csv", "empty.csv"]
    target = spark.createDataFrame([(D(2024, 1, 31), 13, 9.0)], "fecha date, metrica int, valor double")
    with pytest.raises(ValueError, match="cannot be loaded"):
        ML.media_history_load(spark, str(tmp_path), target, ML.media_glossary_rows(spark))


def test_newest_history_file_wins(spark, tmp_path):
    history(tmp_path, "z_old.csv", "c,ene-24,feb-24\nT,1,2\n")
    os.utime(tmp_path / "z_old.csv", (1e9, 1e9))
    history(tmp_path, "a_new.csv", "c,ene-24\nT,5\n")
    target = spark.createDataFrame([(D(2024, 2, 29), 13, 9.0)], "fecha date, metrica int, valor double")
    table, glossary = ML.media_history_load(spark, str(tmp_path), target, ML.media_glossary_rows(spark).limit(1))
    assert sorted(map(tuple, table.collect())) == [(D(2024, 1, 31), 13, 5.0), (D(2024, 2, 29), 13, 2.0)]
    assert glossary.count() == 4


def test_empty_mention_files_are_named(spark, tmp_path):
    history(tmp_path, "empty.csv", "")
    history(tmp_path, "blank.csv", "\n \n".replace(" ", ""))
    history(tmp_path, "good.csv", "Fecha,Calificación\n2024-01-02,positiva\n")
    rows_, invalid = FS.read_mention_files(spark, str(tmp_path))
    assert rows_.count() == 1
    assert sorted(r.file.rsplit("/", 1)[1] for r in invalid.collect()) == ["blank.csv", "empty.csv"]
