"""Token counts by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens by the tokenizer's pattern. New pre-tokens of a
batch lie as bytes one after another in one flat array; in every round each
pre-token merges all occurrences of its own lowest-rank pair at the same time
(left to right where they overlap), and those without a known pair are done.
What is left over of each is its number of tokens. Merging all occurrences of
the lowest rank together equals merging one by one, as a pair made by a merge
always ranks after it.

Counts of pre-tokens seen before are kept in a bounded table per task.

Defined cases: null is empty (no bytes, no tokens); a special token's string
within a text counts as one token; a text of any length counts whole; rows
repeated or with a null id are counted each on its own; an empty table gives
an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from monthend.llm.words import text_slices

CACHE_ENTRIES = 400_000  # pre-tokens remembered by a task before it starts afresh
MERGE_BYTES = 1 << 20    # bytes of new pre-tokens merged together

# The pattern and the byte alphabet of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

NONE = np.int64(1) << 62


class MergeTable:
    """Ranks of pairs of a byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        others = [b for b in range(256) if b not in set(PRINTED)]
        shown = {b: chr(b) for b in PRINTED} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.byte_ids = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in the table of each pair, and whether it is there."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def survivors(self, pieces: list[bytes]) -> np.ndarray:
        """How many symbols of each piece survive all merges."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        live = np.flatnonzero(lengths)  # the pieces still merging
        owner = np.repeat(np.arange(len(live)), lengths[live])
        while len(symbols):
            n = len(symbols)
            at, known = self.find(symbols[:-1], symbols[1:])
            rank = np.full(n, NONE)
            rank[:-1] = np.where(known & (owner[:-1] == owner[1:]), self.ranks[at], NONE)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            hit = (rank == lowest[owner]) & (rank < NONE)
            # in a run of overlapping hits (a a a) every other one merges
            where = np.flatnonzero(hit)
            if len(where):
                new_run = np.concatenate([[True], where[1:] != where[:-1] + 1])
                run_start = np.maximum.accumulate(np.where(new_run, where, 0))
                where = where[(where - run_start) % 2 == 0]
                symbols[where] = self.made[at[where]]
                keep = np.ones(n, bool)
                keep[where + 1] = False
            else:
                keep = np.ones(n, bool)
            done = lowest == NONE
            if done.any():
                out[live[done]] = np.diff(np.append(first, n))[done]
                keep &= ~done[owner]
                live = live[~done]
                owner = (np.cumsum(~done) - 1)[owner]
            symbols, owner = symbols[keep], owner[keep]
        return out


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


class Counter:
    """Counts tokens of texts; remembers pre-tokens it has merged."""

    def __init__(self, path: str):
        self.table = merge_table(path)
        self.pieces = regex.compile(PATTERN).findall
        marks = self.table.special
        self.special = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        cut, specials = [], []
        for text in texts:
            count = 0
            if self.special and any(m in text for m in self.table.special):
                parts = self.special.split(text)
                count = len(parts) - 1
                cut.append([p for part in parts for p in self.pieces(part)])
            else:
                cut.append(self.pieces(text))
            specials.append(count)
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        fresh = set().union(*cut).difference(self.known)
        self.learn(sorted(fresh))
        get = self.known.__getitem__
        return [n + sum(map(get, pieces)) for n, pieces in zip(specials, cut, strict=True)]

    def learn(self, pieces: list[str]) -> None:
        coded = [p.encode() for p in pieces]
        at = 0
        while at < len(coded):
            size, to = 0, at
            while to < len(coded) and (to == at or size + len(coded[to]) <= MERGE_BYTES):
                size += len(coded[to])
                to += 1
            self.known.update(zip(pieces[at:to], self.table.survivors(coded[at:to]).tolist(), strict=True))
            at = to


def counting(path: str, id_col: str, text_col: str, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in text_slices(batches, text_col):
            count = count or Counter(path)
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            tokens = np.array(count(texts), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(tokens), pa.array(tokens > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Per row: its id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``).

    ``tokenizer`` is the path of a byte-level BPE file, readable on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        counting(tokenizer, id_col, text_col, limit),
        f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
