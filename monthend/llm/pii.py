"""Personal data: rules, and a character-level BiLSTM-CRF that adds to them.

The base finds e-mail addresses, IP addresses, card and phone numbers by
rule. A tagger (see ``crf``) learns from such spans of a bounded sample, with
digits, letters and separators varied, and reads every text in overlapping
windows. A character takes the tag of the window it lies deepest in, so that
spans run on over window ends; runs of tags are the tagger's spans. Those
that overlap no base span and are plausible for their kind are added.

All four kinds hold a digit or ``@``, so reading begins in the windows that
have one. Wherever a run of tags reaches the end of what was read, the next
window is read too, until no run does: every span around such a character is
read whole, as if all windows were.

Defined cases: null is empty; texts of any length are read whole, in time
linear in their length; repeated rows are found again; where nothing is
labelled the base stands alone; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.crf import Adam, Tagger
from monthend.llm.words import text_slices
from monthend.session import materialize

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
TAGS = 1 + 2 * len(KINDS)  # outside; first and further characters of each kind

WIDTH, STRIDE = 64, 40     # a window, and from one window to the next
EDGE = (WIDTH - STRIDE) // 2
CONTEXT = 96               # characters kept around a labelled span
SAMPLE = 250               # labelled spans a kind, and windows without one, that are learnt from at most
STEPS, BATCH, RATE = 260, 48, 0.012
EMBEDDING, UNITS = 12, 20

TRIGGER = re.compile(r"[0-9@]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from each ``@`` back to where its local part begins."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans by rule, by kind and start."""
    if not TRIGGER.search(text):
        return []
    out: list[Span] = [("email", *s) for s in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(DIGIT.findall(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def plausible(kind: str, said: str) -> bool:
    """What an added span has to look like."""
    digits = "".join(DIGIT.findall(said))
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+\s?@\s?[^\s@]+\.[^\s@]{2,}", said)) and said[-1].isalnum()
    if kind == "ip":
        parts = re.split(r"[^0-9]+", said)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and not re.search(r"[^\s()0-9./+-]", said)


# ---- windows

CLASSES = 1 + 26 + 26 + 10 + 18 + 2  # padding, letters, capitals, digits, signs, other letters, anything else
_SIGNS = "@.+-()_% \n/:,\"'=#*"
_CLASS = np.full(128, CLASSES - 1, np.int8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = np.arange(1, 27), np.arange(27, 53), np.arange(53, 63)
for _i, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = 63 + _i


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], CLASSES - 2)


class Windows:
    """A text's windows: rows of classes, where they start, which hold a digit or ``@``, and which were read."""

    def __init__(self, classes: np.ndarray):
        n = self.length = len(classes)
        self.starts = np.arange(0, max(n - WIDTH, 0) + STRIDE, STRIDE) if n > WIDTH else np.zeros(1, np.int64)
        self.padded = np.zeros(self.starts[-1] + WIDTH, np.int8)
        self.padded[:n] = classes
        trigger = np.zeros(len(self.padded) + 1, np.int64)
        np.cumsum((self.padded >= 53) & (self.padded < 64), out=trigger[1:])  # digits and @
        self.wanted = trigger[self.starts + WIDTH] > trigger[self.starts]
        self.read = np.zeros(len(self.starts), bool)
        self.tags = np.zeros((len(self.starts), WIDTH), np.int8)

    def due(self) -> np.ndarray:
        return np.flatnonzero(self.wanted & ~self.read)

    def rows(self, which: np.ndarray) -> np.ndarray:
        return self.padded[self.starts[which, None] + np.arange(WIDTH)]

    def take(self, which: np.ndarray, tags: np.ndarray) -> None:
        """The tags of these windows; asks for those that a run of tags leads into."""
        self.tags[which], self.read[which] = tags, True
        found = np.flatnonzero(self.stitched())
        for beside in (found - 1, found + 1):
            inside = beside[(beside >= 0) & (beside < self.length)]
            self.wanted[np.clip((inside - EDGE) // STRIDE, 0, len(self.starts) - 1)] = True

    def stitched(self) -> np.ndarray:
        known = np.flatnonzero(self.read)
        return stitch(self.length, self.starts[known], self.tags[known])


def stitch(length: int, starts: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """One tag per character: that of the window in which it lies deepest."""
    out = np.zeros(length, np.int8)
    for start, row in zip(starts.tolist(), tags, strict=True):
        lo = 0 if start == 0 else EDGE
        hi = WIDTH if start + WIDTH >= length else WIDTH - EDGE
        hi = min(hi, length - start)
        if hi > lo:
            out[start + lo:start + hi] = row[lo:hi]
    return out


def tag_runs(tags: np.ndarray) -> list[Span]:
    """Runs of one kind; a first-character tag opens a new one."""
    out, at = [], np.flatnonzero(tags)
    begin = None
    for k, i in enumerate(at.tolist()):
        kind, first = divmod(int(tags[i]) - 1, 2)
        if begin is None or first == 0 or i != at[k - 1] + 1 or kind != begin[0]:
            if begin:
                out.append((KINDS[begin[0]], begin[1], int(at[k - 1]) + 1))
            begin = (kind, i)
    if begin:
        out.append((KINDS[begin[0]], begin[1], int(at[-1]) + 1))
    return out


def added_spans(texts: list[str], based: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """The tagger's plausible spans of each text that touch no base span."""
    cut = [Windows(classes_of(t)) if TRIGGER.search(t) else None for t in texts]
    due = [(w, w.due()) for w in cut if w]
    while due := [(w, which) for w, which in due if len(which)]:
        tags = tagger.decode(np.concatenate([w.rows(which) for w, which in due]))
        at = 0
        for w, which in due:
            w.take(which, tags[at:at + len(which)])
            at += len(which)
        due = [(w, w.due()) for w, _ in due]
    out = []
    for text, own, w in zip(texts, based, cut, strict=True):
        found = tag_runs(w.stitched()) if w else []
        keep = []
        for kind, i, j in found:
            while i < j and text[i].isspace():
                i += 1
            while j > i and text[j - 1].isspace():
                j -= 1
            if plausible(kind, text[i:j]) and not any(a < j and i < b for _, a, b in own):
                keep.append((kind, i, j))
        out.append(keep)
    return out


# ---- learning


def labelled_sample(docs: DataFrame, text_col: str, size: int) -> pd.DataFrame:
    """At most ``size`` snippets of each kind and as many without a span, chosen by hash.

    Columns ``kind`` (empty: none), ``snippet``, ``spans`` (kind:start:end,
    comma-joined, within the snippet).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, list] = {k: [] for k in ("", *KINDS)}

        def offer(kind, snippet, spans):
            order = -xxhash.xxh64_intdigest(snippet, 7) >> 1
            entry = (order, snippet, ",".join(f"{k}:{a}:{b}" for k, a, b in spans))
            if entry in heaps[kind]:
                return
            if len(heaps[kind]) < size:
                heapq.heappush(heaps[kind], entry)
            else:
                heapq.heappushpop(heaps[kind], entry)

        for batch in text_slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                text = text or ""
                found = base_spans(text)
                taken = sorted(found, key=lambda s: s[1])
                for kind, i, j in found:
                    if j - i > WIDTH:
                        continue
                    lo, hi = max(0, i - CONTEXT), min(len(text), j + CONTEXT)
                    inside = [(k, a - lo, b - lo) for k, a, b in taken if a >= lo and b <= hi]
                    offer(kind, text[lo:hi], inside)
                last = -CONTEXT
                for m in TRIGGER.finditer(text):  # digits and @ that are no personal data
                    i = m.start()
                    if i < last + 2 * CONTEXT or any(a - CONTEXT < i < b + CONTEXT for _, a, b in taken):
                        continue
                    last = i
                    offer("", text[max(0, i - CONTEXT):i + CONTEXT], [])
        rows = [(k, -e[0], e[1], e[2]) for k, h in heaps.items() for e in h]
        kinds, orders, snippets, spans = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(orders, pa.int64()), pa.array(snippets, pa.string()),
             pa.array(spans, pa.string())], ["kind", "priority", "snippet", "spans"])

    offered = materialize(docs.select(F.col(text_col).alias("text")).mapInArrow(
        run, "kind string, priority bigint, snippet string, spans string").distinct())
    chosen = [offered.where(F.col("kind") == k).orderBy("priority", "snippet", "spans").limit(size).toPandas()
              for k in ("", *KINDS)]
    return pd.concat(chosen, ignore_index=True)


def parse(spans: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


def varied(rng: np.random.Generator, snippet: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """The snippet with the spans' digits and letters drawn anew, and their signs at times changed."""
    out, at, moved = [], 0, []
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        said = snippet[a:b]
        if rng.random() < 0.7:
            said = "".join(str(rng.integers(10)) if c in "0123456789" else c for c in said)
        if kind == "email" and rng.random() < 0.5:
            said = "".join(chr(rng.integers(97, 123)) if c.islower() else c for c in said)
        if kind == "phone" and rng.random() < 0.3:
            said = said.replace("-", rng.choice([".", " ", "-"])).replace("(", "").replace(")", "")
        if kind == "card" and rng.random() < 0.4:
            sign = rng.choice([" ", "-", "."])
            digits = "".join(DIGIT.findall(said))
            said = sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))
        out.append(snippet[at:a])
        start = sum(map(len, out))
        out.append(said)
        moved.append((kind, start, start + len(said)))
        at = b
    out.append(snippet[at:])
    return "".join(out), moved


def train(sample: pd.DataFrame, steps: int = STEPS, seed: int = 8) -> Tagger | None:
    """A tagger learnt from labelled snippets, or None if there is no labelled span."""
    if not len(sample) or not (sample["kind"] != "").any():
        return None
    rng = np.random.default_rng(seed)
    allowed = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):  # a further character follows only its own kind
        allowed[:, 2 + 2 * k] = False
        allowed[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    tagger = Tagger.fresh(CLASSES, TAGS, allowed, EMBEDDING, UNITS, seed)
    adam = Adam(tagger.weights, RATE)
    rows = list(zip(sample["snippet"], map(parse, sample["spans"]), strict=True))
    for step in range(steps):
        x, y = np.zeros((BATCH, WIDTH), np.int8), np.zeros((BATCH, WIDTH), np.int8)
        for n in range(BATCH):
            text, spans = varied(rng, *rows[rng.integers(len(rows))])
            tags = np.zeros(len(text), np.int8)
            for kind, a, b in spans:
                tags[a:b] = 2 + 2 * KINDS.index(kind)
                tags[a] -= 1
            at = rng.integers(max(1, len(text) - WIDTH + 1))
            # a window that cuts into a span sees its further characters first
            own, said = classes_of(text)[at:at + WIDTH], tags[at:at + WIDTH]
            x[n, :len(own)], y[n, :len(own)] = own, said
        adam.rate = RATE * min(1, 2 * (1 - step / steps))
        adam.update(tagger.gradients(x.astype(np.int64), y.astype(np.int64))[1])
    return tagger


def written(spans: list[Span]) -> str:
    """kind:start:end by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       sample_size: int = SAMPLE) -> DataFrame:
    """Per row: its id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base), ``base_sha256``, ``spans``, ``n_added``."""
    tagger = train(labelled_sample(docs, text_col, sample_size))
    kind = docs.schema[id_col].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            based = [base_spans(t) for t in texts]
            more = added_spans(texts, based, tagger) if tagger else [[] for _ in texts]
            counts = [pa.array([sum(k == s[0] for s in own) for own in based], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *counts,
                 pa.array([hashlib.sha256(written(own).encode()).hexdigest() for own in based]),
                 pa.array([written(own + extra) for own, extra in zip(based, more, strict=True)], pa.string()),
                 pa.array([len(extra) for extra in more], pa.int64())],
                [id_col, *names, "base_sha256", "spans", "n_added"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, {', '.join(f'{n} bigint' for n in names)}, base_sha256 string, spans string, n_added bigint")
