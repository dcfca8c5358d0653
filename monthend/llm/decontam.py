"""Benchmark decontamination: passages within an edit distance of benchmark items.

Texts are sequences of words (A-Z folded, punctuation separates). The CGK
random walk reads a sequence from a place on, writing the current word at
every step and moving on or not by a random bit of step and word; sequences a
few edits apart soon walk in step again, so edit distance becomes Hamming
distance of the written words. A repetition (its own random bits) samples a
few steps; windows that agree with an item on all of them are candidates, and
their surroundings are verified by exact edit distance.

Items are taken in classes of similar length, so that sampled steps lie
within the shortest of a class. Two running counts leave out places that no
item of a class can begin at, which loses nothing: within ``e`` edits at most
``e`` words are in no item, and all but ``e`` of an item's rare words (those
that few items hold) are there. The number of repetitions follows from how
often edited copies of the items themselves, at the largest distance allowed,
agree with them.

Items are searched in blocks of bounded size, each block sent to all tasks in
one pass over the documents; windows do not overlap documents.

Items below ``least_words`` words are searched for as well with ``short``, by
exact equality: of their words, or, if they begin or end in a script written
without spaces, of their characters (``LEAST_CHARS`` at least, as a shorter
one is in most texts); their distance is 0.

Defined cases: items without words match nothing, nor do items below
``least_words`` words without ``short``; null or empty texts hold nothing;
repeated rows of either table count once; rows of either table with a null id
are searched or searched for, and hit with a null id; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.words import PLAIN, mix, text_slices, window_hashes, words_of

EDITS = 0.2          # edits allowed, as a part of the item's words
LEAST_WORDS = 8
SAMPLED = 3          # steps a repetition compares
RECALL = 0.95        # of copies at the largest distance; nearer ones are found more often
TRIALS = 400         # edited copies that the number of repetitions is found with
MOST_ROUNDS = 400    # repetitions, beyond which fewer steps are sampled
BLOCK_WORDS = 1 << 20
RATIO = 1.25         # longest to shortest item of a class
COMMON = 0.02        # words in more than this part of a block's items are not rare
LEAST_CHARS = 8      # of short items that are searched for by characters
#: First and last characters of scripts written without spaces: South-East Asian, CJK and kana, full width, further CJK.
UNSPACED = np.array([(0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x31FF),
                     (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFDC), (0x20000, 0x3FFFF)])
_SEPARATED = bytes(32 if white else b + 32 if 65 <= b <= 90 else b for b, white in enumerate(PLAIN))

Item = tuple[int | None, np.ndarray]


def allowed(n: int, edits: float) -> int:
    return math.floor(edits * n + 1e-9)


@dataclass
class Repetition:
    """Random bits of a walk, the sampled steps, and the items by what they write there."""

    bits: np.ndarray
    steps: list[int]
    partial: list[np.ndarray]  # sorted values of the items after each sampled step
    keys: np.ndarray           # the items' final values, sorted, and whose they are
    items: np.ndarray


@dataclass
class LengthClass:
    shortest: int
    longest: int
    most_edits: int
    least_rare: int  # rare words that are left of any item of the class
    repetitions: list[Repetition]


def walk(words: np.ndarray, place: np.ndarray, bits: np.ndarray, steps: list[int],
         partial: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Values after each sampled step of walks from ``place``.

    Every text in ``words`` ends with the word 0, which a walk never leaves.
    With ``partial`` walks go on only while their value is one of an item's.
    Gives the walks that are left and their values after each sampled step.
    """
    left, values = np.arange(len(place)), []
    value = np.zeros(len(place), np.uint64)
    for step in range(steps[-1] + 1):
        word = words[place]
        if step in steps:
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
            if partial is not None:
                ok = among(value, partial[len(values)])
                left, value, place, word = left[ok], value[ok], place[ok], word[ok]
            values.append(value)
        place = place + ((word * bits[step]) >> np.uint64(63)).astype(np.int64)
    return left, values


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def edited(rng: np.random.Generator, words: np.ndarray, n: int) -> np.ndarray:
    """``words`` after ``n`` random insertions, deletions and replacements."""
    out = words.tolist()
    for _ in range(n):
        at, kind = int(rng.integers(len(out))), rng.integers(3)
        new = int(rng.integers(1, 1 << 63))
        if kind == 0:
            out.insert(at, new)
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out[at] = new
    return np.array(out, np.uint64)


def draw(rng: np.random.Generator, shortest: int, sampled: int) -> tuple[np.ndarray, list[int]]:
    """Random bits and sampled steps of one repetition for items of ``shortest`` words or more."""
    reach = 2 * shortest  # a walk passes a word in two steps on average
    steps = sorted(rng.choice(reach, min(sampled, reach), replace=False).tolist())
    return rng.integers(0, 1 << 63, reach, np.uint64) * np.uint64(2) + np.uint64(1), steps


def laid_out(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows one after another, each closed by the word 0, and where each begins."""
    zero = np.zeros(1, np.uint64)
    sizes = np.array([len(r) + 1 for r in rows])
    return np.concatenate([x for r in rows for x in (r, zero)]), np.cumsum(sizes) - sizes


def repetitions_needed(rng: np.random.Generator, items: list[Item], shortest: int, edits: float, recall: float,
                       sampled: int) -> tuple[int, int]:
    """How many repetitions of how many sampled steps find a copy at the largest distance with probability ``recall``.

    Copies are followed by other words, as in a document. Fewer steps are
    sampled where ``MOST_ROUNDS`` repetitions are not enough.
    """
    pick = [items[i][1] for i in rng.integers(len(items), size=TRIALS)]
    copies = [np.concatenate([edited(rng, w, allowed(len(w), edits)), rng.integers(1, 1 << 63, 2 * shortest, np.uint64)])
              for w in pick]
    both = [laid_out(pick), laid_out(copies)]
    for steps_of in range(sampled, 0, -1):
        found = np.zeros(TRIALS, bool)
        for rounds in range(1, MOST_ROUNDS + 1):
            bits, steps = draw(rng, shortest, steps_of)
            a, b = (walk(*x, bits, steps)[1][-1] for x in both)
            found |= a == b
            # the mean over copies, as their chances differ
            if rounds % 5 == 0 and found.mean() >= recall:
                return rounds, steps_of
    raise ValueError(f"a recall of {recall} is not reached for items of {shortest} words with {edits} edits a word")


@dataclass
class Exact:
    """Short items: by number of words their sorted hashes and whose they are, or by first eight bytes their text."""

    runs: dict[int, tuple[np.ndarray, np.ndarray]]
    texts: dict[int, list[tuple[int, bytes]]]


@dataclass
class Block:
    """Items by length, the words they hold, those of few items, their length classes, and then the short items."""

    items: list[Item]
    words: np.ndarray
    rare: np.ndarray
    classes: list[LengthClass]
    exact: Exact | None = None


def prepare(items: list[Item], edits: float, recall: float, sampled: int, seed: int = 7) -> Block:
    """A block of items made ready to be searched for."""
    rng, classes = np.random.default_rng(seed), []
    items = sorted(items, key=lambda x: (len(x[1]), x[0] is None, x[0] or 0, x[1].tobytes()))
    if not items:
        return Block([], np.zeros(0, np.uint64), np.zeros(0, np.uint64), [])
    vocabulary, times = np.unique(np.concatenate([np.unique(w) for _, w in items]), return_counts=True)
    rare = vocabulary[times <= max(2, COMMON * len(items))]
    at = 0
    while at < len(items):
        shortest, to = len(items[at][1]), at
        while to < len(items) and len(items[to][1]) <= max(RATIO * shortest, shortest + 1):
            to += 1
        own = items[at:to]
        words, place = laid_out([w for _, w in own])
        reps = []
        rounds, steps_of = repetitions_needed(rng, own, shortest, edits, recall, sampled)
        for _ in range(rounds):
            bits, steps = draw(rng, shortest, steps_of)
            _, values = walk(words, place, bits, steps)
            order = np.argsort(values[-1], kind="stable")
            reps.append(Repetition(bits, steps, [np.unique(v) for v in values], values[-1][order], order + at))
        longest = len(own[-1][1])
        least_rare = min(int(among(w, rare).sum()) - allowed(len(w), edits) for _, w in own)
        classes.append(LengthClass(shortest, longest, allowed(longest, edits), least_rare, reps))
        at = to
    return Block(items, vocabulary, rare, classes)


def nearest(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """The least edit distance of the item to any part of the region, and where the part ends."""
    at = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (region != word), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    end = int(row.argmin())
    return int(row[end]), end


def find_hits(words: np.ndarray, first: np.ndarray, block: Block, edits: float) -> list[tuple[int, int, int, int]]:
    """(text, item index, distance, end word) of the best part of each text for each item it holds."""
    n = len(words)
    if not n:
        return []
    counts = [np.concatenate([[0], np.cumsum(among(words, some))]) for some in (block.words, block.rare)]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, end_of = np.arange(n), first[1:][owner]
    closed = np.zeros(n + len(first) - 1, np.uint64)  # each text followed by the word 0
    closed[at + owner] = words
    starts, found = [], []
    for group in block.classes:
        inside = counts[0][np.minimum(at + group.shortest, end_of)] - counts[0][:-1]
        rare = counts[1][np.minimum(at + group.longest + group.most_edits, end_of)] - counts[1][:-1]
        start = np.flatnonzero((inside >= group.shortest - group.most_edits) & (rare >= group.least_rare))
        if not len(start):
            continue
        place = start + owner[start]
        for rep in group.repetitions:
            left, values = walk(closed, place, rep.bits, rep.steps, rep.partial)
            lo, hi = (np.searchsorted(rep.keys, values[-1], side) for side in ("left", "right"))
            times = hi - lo
            if times.any():
                pos = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                starts.append(np.repeat(start[left], times))
                found.append(rep.items[pos])
    if not starts:
        return []
    cand = np.concatenate(starts)
    cand = np.unique(np.stack([owner[cand], np.concatenate(found), cand], 1), axis=0)
    hits = {}
    k = 0
    while k < len(cand):  # candidates of a text and item that lie together are verified together
        text, which, lo = cand[k].tolist()
        item, hi = block.items[which][1], lo
        while k < len(cand) and cand[k, 0] == text and cand[k, 1] == which and cand[k, 2] - hi <= len(item):
            hi = int(cand[k, 2])
            k += 1
        e = allowed(len(item), edits)
        left, right = max(int(first[text]), lo - e), min(int(first[text + 1]), hi + len(item) + e)
        if len(item) - int(np.isin(item, words[left:right]).sum()) > e:
            continue  # every word of the item that is not there costs an edit
        distance, end = nearest(item, words[left:right])
        if distance <= e and distance < hits.get((text, which), (e + 1,))[0]:
            hits[text, which] = (distance, left + end - int(first[text]))
    return [(*key, *value) for key, value in hits.items()]


def separated(col: pa.Array) -> Iterator[bytes]:
    """The words of each text, A-Z folded, with a space between."""
    for text in col.cast(pa.large_string()).cast(pa.large_binary()).to_pylist():
        yield b" ".join((text or b"").translate(_SEPARATED).split())


def unspaced(char: str) -> bool:
    return bool(((UNSPACED[:, 0] <= ord(char)) & (ord(char) <= UNSPACED[:, 1])).any())


def prepare_exact(short: list[tuple[int | None, np.ndarray, bytes]], at: int) -> Exact:
    """Short items made ready to be searched for; the first has index ``at``."""
    runs, texts = {}, {}
    for k, (_, words, text) in enumerate(short, at):
        chars = text.decode(errors="replace")
        if not (unspaced(chars[0]) or unspaced(chars[-1])):
            runs.setdefault(len(words), []).append((int(window_hashes(words, len(words))[0]), k))
        elif len(chars) >= LEAST_CHARS:
            texts.setdefault(int.from_bytes(text[:8], "little"), []).append((k, text))
    laid = {n: sorted(x) for n, x in runs.items()}
    return Exact({n: (np.array([h for h, _ in x], np.uint64), np.array([k for _, k in x])) for n, x in laid.items()}, texts)


def find_runs(words: np.ndarray, first: np.ndarray, exact: Exact) -> Iterator[tuple[int, int, int, int]]:
    """``find_hits`` of the short items that are searched for by words."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for n, (keys, items) in exact.runs.items():
        start = np.flatnonzero(among(window_hashes(words, n), keys))
        start = start[start + n <= first[1:][owner[start]]]
        values = window_hashes(words, n)[start]
        lo, hi = (np.searchsorted(keys, values, side) for side in ("left", "right"))
        seen = {}
        for at, i, j in zip(start.tolist(), lo.tolist(), hi.tolist(), strict=True):
            for k in range(i, j):
                seen.setdefault((int(owner[at]), int(items[k])), at + n - int(first[owner[at]]))
        yield from ((*key, 0, end) for key, end in seen.items())


def find_texts(col: pa.Array, exact: Exact) -> Iterator[tuple[int, int, int, int]]:
    """``find_hits`` of the short items that are searched for by characters."""
    anchors, step = np.array(sorted(exact.texts), np.uint64), 1 << 20
    for k, own in enumerate(separated(col)):
        data, seen = np.frombuffer(own, np.uint8), set()
        for base in range(0, len(data) - 7, step):
            keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data[base:base + step + 7], 8)).view("<u8")[:, 0]
            for at in (np.flatnonzero(among(keys, anchors)) + base).tolist():
                for which, item in exact.texts[int.from_bytes(own[at:at + 8], "little")]:
                    to = at + len(item)
                    if which in seen or not own.startswith(item, at):
                        continue
                    chars = item.decode(errors="replace")  # beside a letter of a spaced script the word has to end
                    if (at == 0 or own[at - 1] == 32 or unspaced(chars[0])) and (
                            to == len(own) or own[to] == 32 or unspaced(chars[-1])):
                        seen.add(which)
                        yield k, which, 0, own.count(b" ", 0, to) + 1


def hits_of(col: pa.Array, block: Block, edits: float) -> list[tuple[int, int, int, int]]:
    """(text, item index, distance, end word) of the best part of each text for each item of a block it holds."""
    w = words_of(col, lower=True, plain=True)
    hits = find_hits(w.hashes, w.first, block, edits) if block.classes else []
    if block.exact and block.exact.runs and len(w.hashes):
        hits += find_runs(w.hashes, w.first, block.exact)
    if block.exact and block.exact.texts:
        hits += find_texts(col, block.exact)
    return hits


def read_items(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[int | None, np.ndarray, bytes]]:
    """Id, words and separated text of each item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            w = words_of(batch.column("text"), lower=True, plain=True)
            rows = [w.hashes[i:j].tobytes() for i, j in zip(w.first[:-1], w.first[1:], strict=True)]
            texts = list(separated(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary()), pa.array(texts, pa.binary())],
                                             ["id", "words", "text"])

    read = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id bigint, words binary, text binary").distinct()
    items = [(r["id"], np.frombuffer(r["words"], np.uint64), bytes(r["text"])) for r in read.collect() if len(r["words"])]
    return sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1].tobytes()))


def blocks_of(benchmark: DataFrame, item_col: str, item_text: str, edits: float, recall: float,
              least_words: int, short: bool) -> Iterator[Block]:
    """The benchmark's items in blocks of bounded size, each ready to be sent to all tasks."""
    size = benchmark.agg(F.sum(F.length(item_text))).first()[0] or 0
    blocks = max(1, math.ceil(size / 5 / BLOCK_WORDS))
    for k in range(blocks):
        # by text too, as many items may have a null id
        part = benchmark.where(F.pmod(F.xxhash64(item_col, item_text), F.lit(blocks)) == k)
        items = read_items(part, item_col, item_text)
        below = [x for x in items if len(x[1]) < least_words] if short else []
        above = [x[:2] for x in items if len(x[1]) >= least_words]
        if above or below:
            block = prepare(above, edits, recall, SAMPLED)
            block.exact = prepare_exact(below, len(block.items))
            block.items += [x[:2] for x in below]
            yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", edits: float = EDITS, recall: float = RECALL,
                 least_words: int = LEAST_WORDS, short: bool = False) -> DataFrame:
    """A row per document and item it holds: ids, ``item_words``, ``distance``, ``end_word``.

    ``distance`` counts word edits between the item and the nearest part of
    the text; the part ends before ``end_word``.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = f"`{id_col}` bigint, `{item_col}` bigint, item_words bigint, distance bigint, end_word bigint"
    out = spark.createDataFrame([], schema)
    for block in blocks_of(benchmark, item_col, item_text, edits, recall, least_words, short):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value.items
            for batch in text_slices(batches, "text"):
                hits = hits_of(batch.column("text"), sent.value, edits)
                if hits:
                    text, which, distance, end = (np.array(x) for x in zip(*hits, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(text)), pa.array([items[i][0] for i in which], pa.int64()),
                         pa.array([len(items[i][1]) for i in which], pa.int64()), pa.array(distance, pa.int64()),
                         pa.array(end, pa.int64())],
                        [id_col, item_col, "item_words", "distance", "end_word"])

        out = out.unionByName(plain.mapInArrow(run, schema))
    # repeated rows of a document or an item are one: the nearest counts
    return out.groupBy(id_col, item_col, "item_words").agg(F.min(F.struct("distance", "end_word")).alias("m")).select(
        id_col, item_col, "item_words", "m.distance", "m.end_word")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text: str = "text", edits: float = EDITS, recall: float = RECALL,
                         least_words: int = LEAST_WORDS, short: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no item, all their columns unchanged."""
    spark = docs.sparkSession
    out = docs
    for block in blocks_of(benchmark, item_col, item_text, edits, recall, least_words, short):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, text_col):
                keep = np.ones(batch.num_rows, bool)
                keep[[hit[0] for hit in hits_of(batch.column(text_col), sent.value, edits)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
