"""Spelling variants: words one edit apart, grouped under the more frequent one.

Two words one edit apart differ at one place: what comes before it is equal,
and what comes after it. The vocabulary is therefore dealt by what two words
of lengths m and m + 1 share when that place lies in a window ``[lo, hi)``:
their first ``lo`` and last ``m - hi`` characters. There are two windows, the
halves of a word; where more than ``LIMIT`` words share one, it is halved
again, down to single places, so a group has a bounded number of words and
every pair belongs to exactly one window, that of its first difference.

Within a group what differs is a sorted list. Rows of the edit matrix, three
cells wide, are computed once for all words that share a prefix (the ranges
between two small LCPs of neighbours) against all words of the group at
once; a range goes on only with the words that its prefix is within one edit
of, and is skipped when there are none. Tasks return one row a word and
group: how many near words it has there and the most frequent one.

Forms lead to words at least twice as frequent, so roots come down from the
words without a form in at most log2(largest count) joins.

Defined cases: a null text has no words; a null id deletes nothing; rows
repeated under one id count each; texts are read whole, whatever their
length; ties between equally frequent near words go to the smallest in
code-point order; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthend.llm.linededup import UPPER
from monthend.llm.merkle import crc_of, crc_table
from monthend.session import materialize

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LIMIT = 2048
BATCH = 16384  # words gone through at once
FAR = 2  # stands for every distance above one


# ---- words

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97,
                min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n``: the runs of letters, of which one in ``every`` loses a character chosen by its hash."""
    text = F.translate(F.col(f"`{text_col}`"), UPPER, UPPER.lower())
    runs = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), F.col("run")).cast("binary"))
    place = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substr("run", place + 2))
    words = runs.where(F.length("run") >= min_chars).withColumn("h", h).select(
        F.when((F.col("h") % every == 0) & F.col("h").isNotNull(), shorter).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


# ---- groups

def _windows(words: DataFrame) -> DataFrame:
    """Each word with the two halves of the lengths m at which it can be half of a pair."""
    size = F.length("word")
    lengths = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where("m > 0")
    half = F.expr("m div 2")
    both = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (F.col("m") + 1).alias("hi")))
    return lengths.select("word", "n", "m", F.explode(both).alias("w")).select("word", "n", "m", "w.lo", "w.hi")


def _key() -> Column:
    """What the words of a group share: the lengths, the window, and all outside the window."""
    after = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    return F.concat_ws(" ", F.concat_ws(",", "m", "lo", "hi"), F.substr("word", F.lit(1), F.col("lo")),
                       F.when(after > 0, F.substr("word", F.length("word") - after + 1, after)).otherwise(F.lit("")))


def grouped(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n, m, lo, hi, key``: groups of at most ``limit`` words, or of a single place.

    A group above the limit is taken apart into the two halves of its window,
    round after round; only whether there is one reaches the driver.
    """
    rows, done = materialize(_windows(words).withColumn("key", _key())), None
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("hi") - F.col("lo")).alias("wide"))
        large = materialize(sizes.where((F.col("size") > limit) & (F.col("wide") > 1)).select("key"))
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        middle = F.expr("(lo + hi) div 2")
        halves = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
        rows = materialize(rows.join(large, "key", "left_semi").select("word", "n", "m", F.explode(halves).alias("w"))
                           .select("word", "n", "m", "w.lo", "w.hi").withColumn("key", _key()))


# ---- the sorted list of a group

def near_pairs(chars: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (t, q) of words of one group that are exactly one edit apart, both ways round.

    ``chars`` holds a word a row, in order within each group and filled up
    with zeros; the words of a group are distinct.
    """
    n, width = chars.shape
    # LCP of each word with the one before it; a group's first word shares nothing, not even the root
    lcp = np.full(n, -1)
    same = group[1:] == group[:-1]
    differs = chars[1:] != chars[:-1]
    lcp[1:][same] = np.where(differs.any(1), differs.argmax(1), width)[same]
    padded = np.zeros((n, width + 3), chars.dtype)  # character j (from 0) in column j + 2
    padded[:, 2:-1] = chars
    # at depth 0 a range is a whole group, and every word of it is compared with it
    starts = np.flatnonzero(lcp < 0)
    ends = np.append(starts[1:], n)
    count = (ends - starts)[np.cumsum(lcp < 0) - 1]
    at = np.repeat(starts, ends - starts)
    end = at + count
    query = np.arange(n)
    rows = np.tile(np.array([FAR, 0, 1], np.int8), (n, 1))  # cells depth - 1, depth, depth + 1
    found_t, found_q = [], []
    for depth in range(width + 1):
        # a word that ends here is the first of its range
        over = sizes[at] == depth
        offset = sizes[query] - depth + 1
        hit = over & (offset >= 0) & (offset <= 2)
        hit[hit] = rows[hit, offset[hit]] == 1
        found_t.append(at[hit])
        found_q.append(query[hit])
        if depth == width:
            break
        # the ranges one character longer that lie in each range
        nodes = np.flatnonzero((lcp <= depth) & (sizes > depth))
        bounds = np.append(np.flatnonzero(lcp <= depth), n)
        first, last = np.searchsorted(nodes, at), np.searchsorted(nodes, end)
        many = last - first
        parent = np.repeat(np.arange(len(at)), many)
        child = np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        at = nodes[child]
        query = query[parent]
        old = rows[parent]
        letter = chars[at, depth]
        new = np.empty_like(old)
        for o in range(3):  # cell j = depth + o of the next row; its letter is character j - 1
            best = old[:, o] + (padded[query, depth + o + 1] != letter)
            if o < 2:
                best = np.minimum(best, old[:, o + 1] + 1)
            if o:
                best = np.minimum(best, new[:, o - 1] + 1)
            new[:, o] = np.minimum(best, FAR)
        # cells before the word's begin or past its end do not exist
        if depth == 0:
            new[:, 0] = 1
        past = sizes[query] - depth
        new[:, 1][past < 1] = FAR
        new[:, 2][past < 2] = FAR
        go_on = new.min(1) < FAR
        at, query, rows = at[go_on], query[go_on], new[go_on]
        end = bounds[np.searchsorted(bounds, at, "right")]
    return np.concatenate(found_t), np.concatenate(found_q)


NEAR = pa.schema([("word", "string"), ("n", "int64"), ("n_near", "int64"), ("form_n", "int64"), ("form", "string")])


def _nearest(rows: pa.Table) -> pa.RecordBatch:
    """Per word of whole groups (sorted by key and word): its near words there and the best of them."""
    key = rows["key"].combine_chunks()
    group = np.concatenate([[0], np.cumsum(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False))])
    alone = np.bincount(group)[group] == 1
    rows, group = rows.filter(pa.array(~alone)), group[~alone]
    words = rows["word"].to_pylist()
    if not words:
        return pa.RecordBatch.from_pylist([], schema=NEAR)
    m, lo, hi, n = (rows[c].to_numpy() for c in ("m", "lo", "hi", "n"))
    lengths = np.array([len(w) for w in words])
    after = np.maximum(m - hi, 0)
    inner = [w[a:b] for w, a, b in zip(words, lo, lengths - after, strict=True)]
    sizes = lengths - after - lo
    width = int(sizes.max())
    chars = np.array(inner, f"U{width}").view(np.uint32).reshape(len(words), width)
    order = np.lexsort((*chars.T[::-1], group))
    t, q = near_pairs(chars[order], sizes[order], group[order])
    t, q = order[t], order[q]
    # of two words of length m + 1, and of a first difference past the window, another group tells
    shared = (chars[t] != chars[q]).argmax(1)
    keep = ((lengths[t] == m[t]) | (lengths[q] == m[q])) & (shared < (hi - lo)[t])
    t, q = t[keep], q[keep]
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(rows["word"]).to_numpy()] = np.arange(len(words))  # bytes of UTF-8: code-point order
    best = np.lexsort((rank[t], -n[t], q))
    t, q = t[best], q[best]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    of, form = q[first], t[first]
    return pa.RecordBatch.from_arrays([
        rows["word"].take(pa.array(of)).combine_chunks(), pa.array(n[of]),
        pa.array(np.diff(np.append(first, len(q)))), pa.array(n[form]), rows["word"].take(pa.array(form)).combine_chunks(),
    ], schema=NEAR)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through sorted rows, whole groups at a time."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        while held.num_rows >= BATCH:
            # up to the last place where a group begins; one that fills a batch is read on
            key = held["key"].combine_chunks()
            cuts = np.flatnonzero(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)) + 1
            if not len(cuts):
                break
            cut = int(cuts[max(np.searchsorted(cuts, BATCH, "right") - 1, 0)])
            yield _nearest(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield _nearest(held)


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n, n_near, best``: the number of words one edit away, and the most frequent (``n``, ``word``)."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grouped(words, limit).repartition(parts, "key").sortWithinPartitions("key", "word")
    near = dealt.select("word", F.col("n").cast("long"), "m", "lo", "hi", "key").mapInArrow(
        _scan, "word string, n long, n_near long, form_n long, form string")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("word")))
    return near.unionByName(none).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def variants(words: DataFrame, ratio: int = 2, limit: int = LIMIT) -> DataFrame:
    """Per word ``word, form, root, n, n_near, form_n`` for a vocabulary ``word, n`` of distinct words."""
    near = near_words(materialize(words), limit)
    large = -F.col("best.less") >= ratio * F.col("n")
    forms = materialize(near.select("word", F.when(large, F.col("best.word")).alias("form"), "n", "n_near",
                                    F.when(large, -F.col("best.less")).alias("form_n")))
    # roots come down: the words of each round have their form in the round before
    edges = forms.where(F.col("form").isNotNull()).select("word", "form")
    level = edges.join(forms.where(F.col("form").isNull()).select(F.col("word").alias("form")), "form").select(
        "word", F.col("form").alias("root"))
    roots = None
    while True:
        level = materialize(level)
        if level.isEmpty():
            break
        roots = level if roots is None else roots.unionByName(level)
        level = edges.join(level.withColumnRenamed("word", "form"), "form").select("word", "root")
    if roots is None:
        return forms.withColumn("root", F.col("word"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs))


SQL = rf"""
WITH RECURSIVE c AS (SELECT {crc_table()} AS t),
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                                 '{UPPER}', '{UPPER.lower()}') AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, k, {crc_of("(coalesce(doc_id, 0)::VARCHAR || ':' || run)", "t")} AS h, doc_id IS NOT NULL AS named FROM runs, c),
counted AS (
  SELECT CASE WHEN named AND h % 97 = 0
              THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(k)::BIGINT AS n
  FROM hashed GROUP BY 1),
words AS MATERIALIZED (SELECT word, n FROM counted WHERE length(word) >= 5 AND n >= 3),
cut AS MATERIALIZED (
  SELECT word, pos, length(word) AS size, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.pos = b.pos AND a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, a.rest FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT a.rest, a.word FROM cut a JOIN words b ON a.rest = b.word),
near AS (
  SELECT a AS word, count(*) AS n_near, max(w.n) AS most, arg_min(b, (-w.n, encode(b))) AS best
  FROM pairs JOIN words w ON w.word = b GROUP BY a),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN best END AS form,
         CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS here, form AS next FROM forms
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON f.word = walk.next)
SELECT f.word, f.form, walk.here AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""
