"""Best-fit packing of documents into sequences by swap-based local search.

Documents are tokenised where they lie; longer ones are cut so that only
their first piece can be shorter than a sequence. From then on a piece is its
length. Pieces of one length are interchangeable, so the search works on the
histogram of lengths (at most ``capacity`` numbers, whatever the corpus):

1. bins start best-fit decreasing, as groups (contents, number of such bins);
2. local search over groups of underfull bins moves a piece, exchanges one
   for one or two for one, wherever that increases the sum of squared fill,
   so that light bins run empty and go;
3. pieces are dealt to the planned places by their rank among pieces of
   their length, counted per partition and summed over partitions.

Only the histogram and the plan, both bounded by the capacity, pass the
driver.

Defined cases: null text is empty (one end token); repeated rows and rows
with a null id are packed like any others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthend.llm.words import text_slices
from monthend.session import materialize

CAPACITY = 2048
END_ID = 0
SEARCH_STEPS = 20_000  # improvements made at most; a step may serve many equal bins

# Fixed value: the pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}  # fixed value: the file's one special token

Bins = dict[tuple[int, ...], int]  # contents (lengths, falling) -> number of such bins


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary as ranks: the same ids as its ``.json`` form, several times as fast."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def cut_documents(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """Pieces ``id, piece, start, length, ids_crc32`` with ``part`` and ``rank``.

    ``rank`` numbers the pieces of one length within the partition ``part``.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoding(tokenizer), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in text_slices(batches, "text"):
            rows, owner = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(enc.encode_to_numpy(text or "", allowed_special="all"), END_ID).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append((k, start, length, zlib.crc32(ids[start:start + length].tobytes()), part, seen[length]))
                    owner.append(i)
                    seen[length] += 1
            piece, start, length, crc, parts, rank = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(parts, pa.int32()),
                 pa.array(rank, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint")


def add(bins: Bins, contents: tuple[int, ...], n: int) -> None:
    """``n`` more (or fewer) bins of these contents; empty bins are dropped."""
    if contents and n:
        bins[contents] = bins.get(contents, 0) + n
        if not bins[contents]:
            del bins[contents]


def best_fit(histogram: dict[int, int], capacity: int) -> Bins:
    """Falling best-fit, a whole length class at a time."""
    bins: Bins = {}
    free: dict[int, list[tuple[int, ...]]] = {}  # room -> contents with that room

    def put(contents, n):
        if contents not in bins:
            free.setdefault(capacity - sum(contents), []).append(contents)
        bins[contents] = bins.get(contents, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r in free if r >= length and free[r]), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                    left %= each
                else:
                    put((length,) * left, 1)
                    left = 0
                continue
            contents = free[room].pop()
            n = bins.pop(contents)
            each = min(room // length, left)
            used = min(n, left // each)
            if n > used:
                put(contents, n - used)
            put(contents + (length,) * each, used)
            left -= used * each
    return bins


def swapped(a: tuple[int, ...], out: tuple[int, ...], into: tuple[int, ...]) -> tuple[int, ...]:
    rest = list(a)
    for x in out:
        rest.remove(x)
    return tuple(sorted([*rest, *into], reverse=True))


def improvement(a: tuple[int, ...], b: tuple[int, ...], capacity: int, same: bool) -> tuple | None:
    """The step that takes most from the lighter bin ``b`` into ``a``: what leaves each.

    A move, one of ``a`` for one of ``b``, or one for two; squared fill
    increases whenever the fuller bin gains.
    """
    room, best, gain = capacity - sum(a), None, 0
    give, take = sorted(set(b), reverse=True), sorted(set(a))
    for x in give:
        if gain < x <= room:
            best, gain = ((), (x,)), x
        for y in take:
            if gain < x - y <= room:
                best, gain = ((y,), (x,)), x - y
    many = [x for x in give if b.count(x) > 1]
    pairs = [(x, y) for i, x in enumerate(give) for y in give[i + 1:]] + [(x, x) for x in many]
    for y in take:
        for pair in pairs:
            if gain < sum(pair) - y <= room:
                best, gain = ((y,), pair), sum(pair) - y
    for x in give:  # one of the lighter for two of the fuller
        for i, y in enumerate(take):
            for z in take[i:]:
                if (y != z or a.count(y) > 1) and gain < x - y - z <= room:
                    best, gain = ((y, z), (x,)), x - y - z
    return best


def local_search(bins: Bins, capacity: int, steps: int = SEARCH_STEPS) -> Bins:
    """Empty the lightest bins into other underfull bins, step by step."""
    bins = dict(bins)
    stuck: set[tuple] = set()
    for _ in range(steps):
        under = sorted((c for c in bins if sum(c) < capacity), key=lambda c: (-sum(c), c))
        if not under or len(under) == 1 and bins[under[0]] == 1:
            break
        if sum((capacity - sum(c)) * bins[c] for c in under) < capacity:
            break  # the room of all underfull bins together does not make up one bin
        step = None
        for b in reversed(under):
            for a in under:
                if (a, b) in stuck or sum(a) < sum(b) or a == b and bins[a] < 2:
                    continue
                found = improvement(a, b, capacity, a == b)
                if found is None:
                    stuck.add((a, b))
                    continue
                step = (a, b, found)
                break
            if step:
                break
        if not step:
            break
        a, b, (from_a, from_b) = step
        n = bins[a] // 2 if a == b else min(bins[a], bins[b])
        add(bins, a, -n)
        add(bins, b, -n)
        add(bins, swapped(a, from_a, from_b), n)
        add(bins, swapped(b, from_b, from_a), n)
    return bins


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """Groups of equal bins that hold the histogram's pieces."""
    return local_search(best_fit(histogram, capacity), capacity)


def places(bins: Bins) -> dict[int, np.ndarray]:
    """For each length its places: rows (first rank, first sequence, offset in the sequence)."""
    rows: dict[int, list[tuple]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for contents in sorted(bins, reverse=True):
        n, offset = bins[contents], 0
        for length in contents:
            at = ranks.get(length, 0)
            rows.setdefault(length, []).append((at, sequence, offset))
            ranks[length] = at + n
            offset += length
        sequence += n
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """Per piece ``id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` is the path of a ``.tiktoken`` file readable on every
    executor. Offsets in a sequence are gapless from 0.
    """
    pieces = materialize(cut_documents(docs, tokenizer, id_col, text_col, capacity))
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    layout = places(plan_bins(histogram, capacity))
    kind = docs.schema[id_col].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                rows, at = layout[int(x)], np.flatnonzero(length == x)
                k = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                sequence[at] = rows[k, 1] + rank[at] - rows[k, 0]
                offset[at] = rows[k, 2]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])

    ranked = (pieces.join(counts.select("part", "length", "base"), ["part", "length"])
              .select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")))
    return ranked.mapInArrow(
        deal, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
              "offset bigint").withColumnRenamed("id", id_col)
