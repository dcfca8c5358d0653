"""Line dedup: drop lines that many documents share.

Lines are exploded with their position, normalised, hashed (two 64-bit
hashes), and counted by distinct document. Keys at or over the threshold drop
all their lines; the rest of each text is put together again by position.
Only hashes and positions are shuffled by line; a text moves once, to meet
the positions it loses.

Defined cases: a null or empty text is one empty line; lines whose key is
empty are never dropped; rows repeated under one id count as one document and
each row is cleaned; rows with a null id count together as one document; a
text of any length is split whole, its lines held once as an array; an empty
table gives an empty result; other columns pass through untouched, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 16


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, UPPER.lower())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines``, ``n_dropped`` and ``kept`` (the text left over).

    A key of at least ``min_chars`` code points that occurs in at least
    ``min_docs`` distinct documents loses all its lines everywhere.
    """
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("fp", F.xxhash64("text"))
    lines = source.select("id", "fp", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = (lines.select("id", "fp", "pos", line_key(F.col("line")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("id", "fp", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))
    per_doc = keys.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    common = (per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_docs)
              # a common line may hold a third of all rows: its key is spread over salts
              .select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int"))
    dropped = (salted.join(common, ["h1", "h2", "salt"], "left_semi")
               .groupBy("id", "fp").agg(F.collect_set("pos").alias("drop"))
               .withColumnsRenamed({"id": "of", "fp": "print"}))
    whole = source.join(dropped, F.col("id").eqNullSafe(F.col("of")) & (F.col("fp") == F.col("print")), "left")
    split = whole.select("row", "text", "drop", F.split("text", "\n", -1).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return split.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("kept"))


def line_report(docs: DataFrame, **params) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    return dedup_lines(docs, **params).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM d),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY k.doc_id
"""
