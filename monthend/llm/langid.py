"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from its code point).
An n-gram's vector binds its letters' vectors, each rotated by its place; a
text's profile bundles (adds up) the vectors of all its n-grams, and so does
a language's prototype over all its labelled texts. A text gets the language
whose prototype has the largest cosine with its profile.

N-grams run over lower-cased letters; a run of other characters counts as one
boundary. Prototypes add up where the texts lie; one vector per language and
partition is shuffled, and one per language reaches the driver.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or
if there is nothing to learn from; ties go to the language first in order;
rows with a null language or a null id are not learnt from; repeated rows
count each time; an empty table gives an empty result; memory grows with the
longest text alone, by about twenty bytes a character, not with the alphabet;
other columns pass through (``keep_identified``) or are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthend.llm.words import text_slices

DIMENSIONS = 1024
N = 3
UNKNOWN = "und"
BOUNDARY = 0
LARGEST_TABLE = 1 << 22  # n-gram codes counted by a table; larger alphabets are sorted
LARGEST_COUNTS = 1 << 22  # texts x n-grams counted by a table; more are added up text by text
PIECE = 1 << 20  # letters gone through at once
BLOCK = 1 << 12  # n-gram vectors held at once
RARE = 1e-4  # share of a language's letters below which a letter is none of its own
NOISE = 4  # standard deviations of the cosine of two random vectors that a text must exceed


class Letters:
    """Index and vectors of the letters met so far by a task (a kilobyte each)."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.index = np.full(0x110000, -1, np.int32)  # -1: not met, -2: not a letter
        self.letters = np.zeros((0, dimensions), np.int8)
        self.meet(np.array([BOUNDARY]), boundary=True)

    def meet(self, points: np.ndarray, boundary: bool = False) -> None:
        letters = [p for p in points.tolist() if boundary or chr(p).isalpha()]
        self.index[points] = -2
        if not letters:
            return
        self.index[letters] = len(self.letters) + np.arange(len(letters))
        vectors = np.stack([np.random.default_rng([p, 9]).integers(0, 2, self.dimensions, np.int8) * 2 - 1
                            for p in letters])
        self.letters = np.concatenate([self.letters, vectors])

    def profiles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The bundled n-gram vectors of each text, a row each, and whether a text has a letter.

        The letters of all texts are gone through in pieces, and the n-grams
        of a piece in blocks, so memory does not grow with the alphabet. All
        sums are whole numbers, so the order of adding does not matter.
        """
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        firsts = np.cumsum([1, *(len(t) + 1 for t in lowered)])
        unmet = points[self.index[points] == -1]
        if len(unmet):
            self.meet(np.unique(unmet))
        at = np.maximum(self.index[points], BOUNDARY)  # what is no letter is a boundary
        size = len(self.letters)
        out, known = np.zeros((len(texts), self.dimensions), np.float32), np.zeros(len(texts), bool)
        for a in range(1, len(at) - 1, PIECE):
            middle = a + np.flatnonzero(at[a:min(a + PIECE, len(at) - 1)] != BOUNDARY)
            if not len(middle):
                continue
            owner = np.searchsorted(firsts, middle, "right") - 1
            code = (at[middle - 1].astype(np.int64) * size + at[middle]) * size + at[middle + 1]
            known[owner] = True
            self._bundle(out, code, owner)
        return out, known

    def counts(self, text: str) -> np.ndarray:
        """How often each letter met so far occurs, by index (0: everything else)."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.bincount(np.maximum(self.index[points], BOUNDARY), minlength=len(self.letters))

    def _bundle(self, out: np.ndarray, code: np.ndarray, owner: np.ndarray) -> None:
        """Adds the vector of each code to its owner's row."""
        size, low = len(self.letters), int(owner[0])
        owner = owner - low
        n = int(owner[-1]) + 1
        if size ** N <= LARGEST_TABLE:
            present = np.bincount(code, minlength=size ** N)
            codes, column = np.flatnonzero(present), (np.cumsum(present > 0) - 1)[code]
        else:
            codes, column = np.unique(code, return_inverse=True)
        pair = owner * len(codes) + column
        if n * len(codes) <= LARGEST_COUNTS:
            counts = np.bincount(pair, minlength=n * len(codes)).reshape(n, len(codes)).astype(np.float32)
            for a in range(0, len(codes), BLOCK):
                out[low:low + n] += counts[:, a:a + BLOCK] @ self.vectors(codes[a:a + BLOCK])
            return
        pair, times = np.unique(pair, return_counts=True)  # by owner
        for a in range(0, len(pair), BLOCK):
            who, what = np.divmod(pair[a:a + BLOCK], len(codes))
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            vectors = self.vectors(codes[what])
            vectors *= times[a:a + BLOCK, None]
            out[low + who[first]] += np.add.reduceat(vectors, first, axis=0)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The n-grams' bound vectors, a row each."""
        size = len(self.letters)
        bound = np.roll(self.letters[codes // size // size], 2, 1)
        bound *= np.roll(self.letters[codes // size % size], 1, 1)
        bound *= self.letters[codes % size]
        return bound.astype(np.float32)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          dimensions: int = DIMENSIONS) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The prototype of each language of ``docs``, and the letters that make up at least ``RARE`` of one.

    Rows without a language are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums, times = Letters(dimensions), {}, {}
        for batch in text_slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            profiles = letters.profiles([t or "" for t in batch.column("text").to_pylist()])[0]
            names = sorted(set(langs))
            member = np.array([[lang == n for lang in langs] for n in names], np.float64)
            for name, vector in zip(names, member @ profiles, strict=True):
                sums[name] = sums.get(name, 0) + vector
                mine = "".join(t for t, lang in zip(batch.column("text").to_pylist(), langs, strict=True) if lang == name)
                have, now = times.get(name, np.zeros(0, np.int64)), letters.counts(mine)
                now[:len(have)] += have
                times[name] = now
        points = np.zeros(len(letters.letters), np.int64)
        met = np.flatnonzero(letters.index >= 0)
        points[letters.index[met]] = met
        used = [np.flatnonzero(t[1:]) + 1 for t in times.values()]  # 0 is the boundary
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()), "profile": pa.array(list(sums.values()), pa.list_(pa.float64())),
            "letters": pa.array([points[u] for u in used], pa.list_(pa.int64())),
            "times": pa.array([t[u] for t, u in zip(times.values(), used, strict=True)], pa.list_(pa.int64()))})

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        times: dict[str, Counter] = {}
        for frame in frames:
            for lang, profile, letters, n in zip(*(frame[c] for c in frame.columns), strict=True):
                sums[lang] = sums.get(lang, 0) + profile
                for letter, k in zip(letters.tolist(), n.tolist(), strict=True):
                    times.setdefault(lang, Counter())[letter] += k
        if sums:
            common = [[p for p, k in times[g].items() if k >= RARE * times[g].total()] if g in times else [] for g in sums]
            yield pd.DataFrame({"lang": list(sums), "profile": list(sums.values()), "letters": common})

    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = known.mapInArrow(run, "lang string, profile array<double>, letters array<long>, times array<long>")
    found = parts.repartition("lang").mapInPandas(
        total, "lang string, profile array<double>, letters array<long>").collect()
    alphabet = np.unique(np.array([p for r in found for p in r["letters"]], np.int64))
    return {r["lang"]: np.array(r["profile"]) for r in sorted(found, key=lambda r: r["lang"])}, alphabet


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str], text_col: str = "text",
            dimensions: int = DIMENSIONS, alphabet: np.ndarray | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``familiar``.

    ``familiar`` tells whether at least half of a text's letters are in ``alphabet``.

    Columns of the same names in ``keep`` have to be renamed by the caller.
    """
    names = sorted(n for n, v in prototypes.items() if np.any(v))
    matrix = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names], 1).astype(np.float32) \
        if names else np.zeros((dimensions, 0), np.float32)
    langs = pa.array([*names, UNKNOWN])
    alphabet = np.zeros(0, np.int64) if alphabet is None else alphabet

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(dimensions)
        for batch in text_slices(batches, "_text"):
            profile, known = letters.profiles([t or "" for t in batch.column("_text").to_pylist()])
            best = np.full(batch.num_rows, len(names))
            score = np.zeros(batch.num_rows)
            if known.any() and names:
                norm = np.linalg.norm(profile, axis=1)
                cosine = (profile @ matrix) / np.maximum(norm, 1e-9)[:, None]
                best[known] = cosine[known].argmax(1)
                score[known] = np.clip(cosine[known].max(1), 0, 1)
            ours = np.zeros(len(letters.letters), bool)
            ours[letters.index[alphabet][letters.index[alphabet] > 0]] = True
            familiar = np.zeros(batch.num_rows, bool)
            if len(alphabet):
                for i, text in enumerate(batch.column("_text").to_pylist()):
                    n = letters.counts(text or "")
                    familiar[i] = 2 * n[ours].sum() >= n[1:].sum() > 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), langs.take(pa.array(best)), pa.array(score),
                 pa.array(familiar)], [*keep, "lang_pred", "score", "familiar"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(
        run, f"{schema}, lang_pred string, score double, familiar boolean")


def held_out(id_col: str) -> Column:
    """The quarter of the ids that is never learnt from (a null id is in neither part)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: its id, ``held_out``, ``lang_pred``, ``score``; learnt from the rows not held out."""
    flagged = docs.withColumn("_held_out", held_out(id_col))
    prototypes, _ = learn(flagged.where(~F.col("_held_out") & F.col(id_col).isNotNull()), text_col, lang_col)
    said = predict(flagged, prototypes, [id_col, "_held_out"], text_col)
    return said.drop("familiar").withColumnRenamed("_held_out", "held_out")


def keep_identified(docs: DataFrame, least_score: float = NOISE / DIMENSIONS ** 0.5, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a language, all their columns unchanged.

    Rejected are texts without a letter, and those whose cosine is within the
    noise of two random vectors (``least_score``) and whose letters mostly
    belong to no language learnt: very short texts in a learnt alphabet have
    a small cosine too, and stay.
    """
    flagged = docs.withColumn("_held_out", held_out(id_col))
    prototypes, alphabet = learn(flagged.where(~F.col("_held_out") & F.col(id_col).isNotNull()), text_col, lang_col)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    said = predict(renamed, prototypes, list(names.values()), names[text_col], alphabet=alphabet)
    kept = said.where((F.col("lang_pred") != UNKNOWN) & ((F.col("score") >= least_score) | F.col("familiar")))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
