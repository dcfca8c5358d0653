"""Plain single-process versions of the operators, and small fixtures."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import public_tokenizers
from tokenizers import Tokenizer

BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, texts, first_id=0, langs=None, ids=None):
    """A documents table of these texts."""
    ids = ids or range(first_id, first_id + len(texts))
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, g, "s", len(t or "")) for i, t, g in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def with_clashes(df, names):
    """The table with further columns of names that operators might use themselves."""
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit(7).alias(n) for n in names if n not in df.columns))


def tokenizer():
    return Tokenizer.from_file(BPE_JSON)


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def shingles(text, size):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def components(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_duplicates(texts, size, percent=80):
    """id -> (set size, component) of a dict of texts."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    named = components(ids, links)
    return {i: (len(sets[i]), named[i]) for i in ids}


def without_repeats(texts, window):
    """(words, removed, kept) of each of a list of texts."""
    split = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), sum(gone), b" ".join(kept).decode()))
    return out


def line_dedup(rows, min_docs=10):
    """(n_lines, n_dropped, kept) of each (id, text)."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))

    where = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                where[key(line)].add(i)
    out = []
    for _, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(where[key(x)]) < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def plain_words(text):
    return [w for w in re.split(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").encode().lower()) if w]


def edit_distance_within(item, text):
    """The least edit distance of a word sequence to any part of another."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def holds_item(item, text, edits=0.2):
    item = plain_words(item)
    return len(item) >= 8 and edit_distance_within(item, plain_words(text)) <= math.floor(edits * len(item) + 1e-9)


def cosine_links(rows, least):
    """(id, id) of rows (id, vector, label) that link."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = [x / max(map(abs, v)) for x in v]
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v]

    good = [(i, unit(v), g) for i, v, g in rows]
    good = [(i, u, g) for i, u, g in good if u and g is not None]
    return [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1:]
            if a[2] == b[2] and len(a[1]) == len(b[1]) and sum(x * y for x, y in zip(a[1], b[1], strict=True)) >= least]


def base_spans(text):
    """Personal data by the plain patterns."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(re.findall("[0-9]", m.group())) <= 15]
