"""Removal of repeated passages, found by difference-cover anchors.

A passage is a window of ``window`` consecutive words whose sequence starts
in more than one place of the corpus. Short anchor windows are hashed only
where their position in the document, modulo a period, is in a difference
cover. Of two equal windows at any two positions some offset below the period
puts both on the cover, so they share an anchor that lies within them:

1. anchors are counted by hash; the repeated ones go into a bit filter of
   fixed size (a full filter would only let more candidates through);
2. each repeated anchor is extended to all full windows around it; these are
   hashed and counted exactly, and a window seen twice is a repeated passage;
3. the repeated starts return to the part of the table they came from, are
   merged to spans per document, and the words under them go.

Hashes travel as arrays, one per task and bucket. A hash met several times
within a task is sent once, marked, so a passage in a third of all documents
adds a hash per task and not one per document.

Defined cases: null and empty texts have no words; texts below the window's
length lose nothing; repeated rows, also under one id, are repetitions like
any others; rows with a null id are cleaned too; texts of any length are read
whole, in slices of about a megabyte or one text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.words import Words, text_slices, window_hashes, words_of

PERIOD = 21
COVER = (3, 6, 7, 12, 14)  # every difference modulo 21 occurs once
FILTER_BITS = 28           # the filter has 2**28 bits (32 MB), whatever the input
SLICE_BITS = 16            # bits of a filter slice
FLUSH = 1 << 20            # hashes a task holds before it sends them on


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes, by their upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filter slice and two bits in it for each hash."""
    low = np.uint64((1 << SLICE_BITS) - 1)
    part = (hashes >> np.uint64(64 - FILTER_BITS + SLICE_BITS)).astype(np.int64)
    return part, (hashes & low).astype(np.int64), (hashes >> np.uint64(SLICE_BITS) & low).astype(np.int64)


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    part, x, y = probes(hashes)
    base = part << SLICE_BITS
    look = lambda at: (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
    return (look(base + x) & look(base + y)).astype(bool)


def anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the words at which an anchor starts, and the anchors' hashes."""
    size = window - PERIOD + 1
    n, counts = len(words.hashes), words.counts
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place = np.arange(n) - np.repeat(words.first[:-1], counts)
    left = np.repeat(counts, counts) - place
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True
    at = np.flatnonzero(on_cover[place % PERIOD] & (left >= size) & (np.repeat(counts, counts) >= window))
    return at, window_hashes(words.hashes, size)[at]


def by_bucket(values: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes."""
    own = bucket_of(values, buckets)
    cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    return list(zip(own[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(own)], strict=True)) if len(own) else []


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows with an equal key."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != now:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


def u64(rows: list[dict], name: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), np.uint64)


def repeated_anchor_filter(docs: DataFrame, window: int, buckets: int) -> np.ndarray:
    """The bit filter of all anchors that occur more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send():
            values, times = np.unique(np.concatenate(held), return_counts=True)
            rows = [(b, values[i:j][times[i:j] == 1].tobytes(), values[i:j][times[i:j] > 1].tobytes())
                    for b, i, j in by_bucket(values, buckets)]
            return pa.RecordBatch.from_pydict(
                dict(zip(("bucket", "once", "more"), map(list, zip(*rows, strict=True)), strict=True)),
                pa.schema([("bucket", pa.int32()), ("once", pa.binary()), ("more", pa.binary())]))

        for batch in text_slices(batches, "text"):
            hashes = anchors(words_of(batch.column("text"), lower=False), window)[1]
            if len(hashes):
                held.append(hashes)
                n += len(hashes)
            if n >= FLUSH:
                yield send()
                held, n = [], 0
        if n:
            yield send()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "bucket"):
            values, times = np.unique(u64(rows, "once"), return_counts=True)
            found = np.union1d(values[times > 1], u64(rows, "more"))
            if not len(found):
                continue
            part, x, y = probes(found)
            parts, first = np.unique(part, return_index=True)
            blobs = []
            for i, j in zip(first, [*first[1:], len(part)], strict=True):
                bits = np.zeros(1 << SLICE_BITS, bool)
                bits[x[i:j]] = bits[y[i:j]] = True
                blobs.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "bits"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groups(batches, "part"):
            bits = np.bitwise_or.reduce([np.frombuffer(r["bits"], np.uint8) for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                                             ["part", "bits"])

    sent = docs.select("text").mapInArrow(count, "bucket int, once binary, more binary")
    found = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(repeated, "part int, bits binary")
    slices = found.repartition("part").sortWithinPartitions("part").mapInArrow(union, "part int, bits binary")
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    size = 1 << SLICE_BITS - 3
    for row in slices.toLocalIterator():
        bits[row["part"] * size:(row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return bits


def repeated_spans(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """``id, fp, cuts``: the words ``[cuts[0], cuts[1]), [cuts[2], cuts[3])...`` of a text that repeat."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(repeated_anchor_filter(docs, window, buckets))
    fields = pa.schema([("target", pa.int64()), ("flush", pa.int64()), ("hashes", pa.binary()), ("more", pa.binary()),
                        ("owner", pa.binary()), ("place", pa.binary()), ("ids", pa.list_(pa.int64())),
                        ("fps", pa.list_(pa.int64()))])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, fps, n, flush = [], [], [], 0, TaskContext.get().partitionId() << 32

        def send():
            hashes, owner, place = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes, kind="stable")
            hashes, owner, place = hashes[order], owner[order], place[order]
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            alone = new & np.concatenate([new[1:], [True]])
            # repetitions within this part are known already: their hash goes out once, marked
            rows = [{"target": -1 - flush, "flush": flush, "owner": owner[~alone].tobytes(),
                     "place": place[~alone].tobytes(), "ids": ids, "fps": fps, "hashes": b"", "more": b""}]
            for b, i, j in by_bucket(hashes, buckets):
                one = alone[i:j]
                rows.append({"target": b, "flush": flush, "hashes": hashes[i:j][one].tobytes(),
                             "more": hashes[i:j][new[i:j] & ~one].tobytes(), "owner": owner[i:j][one].tobytes(),
                             "place": place[i:j][one].tobytes(), "ids": None, "fps": None})
            return pa.RecordBatch.from_pylist(rows, fields)

        for batch in text_slices(batches, "text"):
            words = words_of(batch.column("text"), lower=False)
            at, hashes = anchors(words, window)
            if not len(at):
                continue
            at = at[contains(bits.value, hashes)]
            owner = np.searchsorted(words.first, at, "right") - 1
            lo = np.maximum(at - PERIOD + 1, words.first[owner])
            hi = np.minimum(at, words.first[owner + 1] - window) + 1
            ok = hi > lo
            step = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(step, lo[ok], 1)
            np.add.at(step, hi[ok], -1)
            start = np.flatnonzero(np.cumsum(step[:-1]))
            if not len(start):
                continue
            owner = np.searchsorted(words.first, start, "right") - 1
            docs_here, local = np.unique(owner, return_inverse=True)
            held.append((window_hashes(words.hashes, window)[start], (local + len(ids)).astype(np.uint32),
                         (start - words.first[owner]).astype(np.uint32)))
            ids += batch.column("id").take(pa.array(docs_here)).to_pylist()
            fps += batch.column("fp").take(pa.array(docs_here)).to_pylist()
            n += len(start)
            if n >= FLUSH:
                yield send()
                held, ids, fps, n, flush = [], [], [], 0, flush + 1
        if n:
            yield send()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for target, rows in groups(batches, "target"):
            if target < 0:  # what a part knew by itself, on its way
                yield pa.RecordBatch.from_pylist(
                    [{k: r[k] for k in ("flush", "owner", "place", "ids", "fps")} for r in rows], back)
                continue
            values, times = np.unique(u64(rows, "hashes"), return_counts=True)
            found = np.union1d(values[times > 1], u64(rows, "more"))
            out = []
            for r in rows:
                hit = np.isin(np.frombuffer(r["hashes"], np.uint64), found)
                if hit.any():
                    out.append({"flush": r["flush"], "ids": None, "fps": None,
                                "owner": np.frombuffer(r["owner"], np.uint32)[hit].tobytes(),
                                "place": np.frombuffer(r["place"], np.uint32)[hit].tobytes()})
            yield pa.RecordBatch.from_pylist(out, back)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, "flush"):
            ids, fps = next((r["ids"], r["fps"]) for r in rows if r["fps"] is not None)
            owner, place = (np.frombuffer(b"".join(r[c] for r in rows), np.uint32).astype(np.int64)
                            for c in ("owner", "place"))
            starts = np.sort(owner << 32 | place)
            if not len(starts):
                continue
            gap = np.concatenate([[True], starts[1:] > starts[:-1] + window])  # also where the document changes
            first, last = starts[gap], starts[np.append(np.flatnonzero(gap)[1:] - 1, len(starts) - 1)]
            spans = np.stack([first & 0xFFFFFFFF, (last & 0xFFFFFFFF) + window], 1)
            docs_here, cut = np.unique(first >> 32, return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in docs_here], pa.int64()), pa.array([fps[i] for i in docs_here], pa.int64()),
                 pa.array([s.ravel() for s in np.split(spans, cut[1:])], pa.list_(pa.int64()))], ["id", "fp", "cuts"])

    names = ("flush", "owner", "place", "ids", "fps")
    back = pa.schema([fields.field(n) for n in names])
    sql = {"target": "bigint", "flush": "bigint", "hashes": "binary", "more": "binary", "owner": "binary",
           "place": "binary", "ids": "array<bigint>", "fps": "array<bigint>"}
    sent = docs.select("id", "fp", "text").mapInArrow(extend, ", ".join(f"{k} {v}" for k, v in sql.items()))
    counted = sent.repartition("target").sortWithinPartitions("target").mapInArrow(
        count, ", ".join(f"{k} {sql[k]}" for k in names))
    return (counted.repartition("flush").sortWithinPartitions("flush")
            .mapInArrow(merge, "id bigint, fp bigint, cuts array<bigint>").dropDuplicates(["id", "fp"]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Per row its id, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space)."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("fp"),
                        F.col(text_col).alias("text"))
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = repeated_spans(plain, window, buckets).withColumnRenamed("id", "of").withColumnRenamed("fp", "print")
    whole = plain.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("fp") == F.col("print")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                words = (text or "").encode().split()
                left, at = [], 0
                for i, j in zip((cuts or [])[::2], (cuts or [])[1::2], strict=True):
                    left += words[at:i]
                    at = j
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], [id_col, "n_words", "n_removed", "kept"])

    return whole.select("id", "text", "cuts").mapInArrow(
        cut, f"`{id_col}` bigint, n_words bigint, n_removed bigint, kept string")
