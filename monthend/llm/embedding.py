"""Embedding near-dedup by cross-polytope hashing.

A table's hash function rotates a unit vector with three rounds of random
signs and a fast Hadamard transform and takes the nearest of the coordinate
axes and their opposites; a bucket is several such functions together. Each
vector is also sent to the buckets it nearly fell into (multiprobe): the ones
whose axes lose least. A pair meets if one of its vectors has its main bucket
where the other probes.

Equal vectors of a label are one class and go on once. Buckets are split into
cells of bounded size by their counts, each pair of parts its own cell, and a
cell's pairs are verified by their cosine in double precision. A verified
pair is told only by the first table and bucket its vectors share, so no pair
is told twice and nothing has to be sorted out afterwards.

Defined cases: a null label, a null, empty or zero vector, or one with null
or non-finite components links with nothing (its component is its own id);
vectors of different lengths never link; repeated rows are classes like other
copies; rows with a null id are linked with nothing, their component is null
and they are kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.components import connected_components
from monthend.session import materialize

TABLES, FUNCTIONS, PROBES = 10, 2, 4  # about 3 of a million pairs at a cosine of 0.93 are missed, fewer above
CELL = 512  # vectors of a bucket that are compared by one task at a time


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (a power of two long), normalised."""
    n, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        half *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, function: int) -> np.ndarray:
    """A pseudo-random rotation of unit rows, padded to a power of two."""
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    for sign in np.random.default_rng([table, function, d]).choice([-1.0, 1.0], (3, d)):
        x = hadamard(x * sign)
    return x


def bucket_lists(unit: np.ndarray) -> np.ndarray:
    """Buckets of each row: (rows, tables, probes); the first probe is the main bucket."""
    out = np.empty((len(unit), TABLES, PROBES), np.int64)
    for t in range(TABLES):
        axes, losses = [], []
        for f in range(FUNCTIONS):
            y = rotated(unit, t, f)
            top = min(PROBES, y.shape[1])
            near = np.argpartition(-np.abs(y), top - 1, 1)[:, :top]
            size = np.take_along_axis(np.abs(y), near, 1)
            order = np.argsort(-size, 1, kind="stable")
            near, size = np.take_along_axis(near, order, 1), np.take_along_axis(size, order, 1)
            axes.append(2 * near + (np.take_along_axis(y, near, 1) < 0))
            losses.append((size[:, :1] - size) ** 2)
        code, loss = axes[0], losses[0]
        for more, lose in zip(axes[1:], losses[1:], strict=True):
            code = (code[:, :, None] * (2 * y.shape[1]) + more[:, None, :]).reshape(len(unit), -1)
            loss = (loss[:, :, None] + lose[:, None, :]).reshape(len(unit), -1)
        best = np.argsort(loss, 1, kind="stable")[:, :PROBES]
        got = np.take_along_axis(code, best, 1)
        out[:, t] = np.pad(got, ((0, 0), (0, PROBES - got.shape[1])), "edge")
    return out


def as_matrix(blobs: pd.Series) -> np.ndarray:
    """Stored vectors of one length as unit rows."""
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def read_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Every row as ``id, label, blob``; ``blob`` (doubles, scaled by the largest) is null where nothing can link."""
    kind = vectors.schema[label_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blobs = []
            for v in frame["vector"]:
                x = np.array([np.nan if c is None else c for c in (() if v is None else v)], np.float64)
                fine = len(x) > 0 and np.isfinite(x).all() and x.any()
                blobs.append((x / np.abs(x).max()).tobytes() if fine else None)
            frame["blob"] = blobs
            yield frame[["id", "label", "blob"]]

    read = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("vector")).mapInPandas(run, f"id bigint, label {kind}, blob binary")
    can = F.col("id").isNotNull() & F.col("label").isNotNull()
    return read.select("id", "label", F.when(can, F.col("blob")).alias("blob"))


def probes(classes: DataFrame) -> DataFrame:
    """``label, length, rep, lists`` and, for each probed bucket, ``tab, bucket, main``."""
    kind = classes.schema["label"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, own in frame.groupby(frame["blob"].map(len)):
                for at in range(0, len(own), 1000):
                    some = own.iloc[at:at + 1000]
                    lists = bucket_lists(as_matrix(some["blob"])).astype("<i4")
                    yield pd.DataFrame({"label": some["label"].to_numpy(), "length": length, "rep": some["rep"].to_numpy(),
                                        "blob": some["blob"].to_numpy(), "lists": [x.tobytes() for x in lists],
                                        "buckets": list(lists.reshape(len(some), -1))})

    return classes.mapInPandas(run, f"label {kind}, length int, rep bigint, blob binary, lists binary, buckets array<int>")


def complete_runs(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Sorted frames, cut where the key changes, and the number of each row's run."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        run = np.cumsum((frame[key] != frame[key].shift()).any(axis=1).to_numpy())
        whole = int(np.searchsorted(run, run[-1]))
        if whole:
            yield frame.iloc[:whole], run[:whole]
        held = frame.iloc[whole:].reset_index(drop=True)
    if held is not None and len(held):
        yield held, np.zeros(len(held), int)


def link_classes(classes: DataFrame, least: float) -> DataFrame:
    """Pairs ``a, b`` of classes of a label with a cosine of at least ``least``, each once."""
    bucket, cell = ["label", "length", "tab", "bucket"], ["label", "length", "tab", "bucket", "i", "j"]
    hashed = materialize(probes(classes))
    places = (hashed.select("label", "length", "rep", F.posexplode("buckets").alias("at", "bucket"))
              .select("label", "length", "rep", F.expr(f"at div {PROBES}").cast("int").alias("tab"), "bucket",
                      (F.col("at") % PROBES == 0).alias("main")))
    crowds = (places.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.max("main").alias("any_main"))
              .where((F.col("n") > 1) & F.col("any_main"))
              .select(*bucket, F.ceil(F.col("n") / CELL).cast("int").alias("parts")))
    met = (places.join(crowds, bucket)
           .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .select(*bucket, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                   "part", "rep", "main"))
    rows = met.join(hashed.select("rep", "blob", "lists"), "rep").repartition(*cell).sortWithinPartitions(*cell)

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, run in complete_runs(frames, cell):
            for _, own in frame.groupby("length"):
                yield from compare(own, run[own.index.to_numpy() - frame.index[0]])

    def compare(frame: pd.DataFrame, run: np.ndarray) -> Iterator[pd.DataFrame]:
        unit = as_matrix(frame["blob"])
        lists = np.frombuffer(b"".join(frame["lists"]), "<i4").reshape(len(frame), TABLES, PROBES)
        main, rep, part, i, j, tab, code = (frame[c].to_numpy() for c in ("main", "rep", "part", "i", "j", "tab", "bucket"))
        for step in range(1, len(frame)):
            x = np.flatnonzero(run[step:] == run[:-step])
            if not len(x):
                break
            y = x + step
            # in a cell of two parts only pairs across them; a cell of one part holds all its pairs
            ok = (main[x] | main[y]) & ((i[x] == j[x]) | (part[x] != part[y]))
            x, y = x[ok], y[ok]
            ok = np.einsum("ij,ij->i", unit[x], unit[y]) >= least
            x, y = x[ok], y[ok]
            if not len(x):
                continue
            first = np.ones(len(x), bool)
            for t in range(TABLES):
                earlier = tab[x] > t
                for one, other in ((x, y), (y, x)):  # the main bucket of one, among the other's
                    own = lists[one, t, 0]
                    met = (lists[other, t] == own[:, None]).any(1)
                    first &= ~(met & (earlier | (tab[x] == t) & (own < code[x])))
            yield pd.DataFrame({"a": np.minimum(rep[x], rep[y])[first], "b": np.maximum(rep[x], rep[y])[first]})

    return rows.mapInPandas(verify, "a bigint, b bigint")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.93) -> DataFrame:
    """Per row its id, ``n_links``, ``component_id``, ``kept``.

    Vectors of an equal label link at a cosine of at least ``least``;
    ``n_links`` counts the other rows linked directly.
    """
    read = materialize(read_vectors(vectors, id_col, vector_col, label_col)
                       .withColumn("h1", F.xxhash64("blob")).withColumn("h2", F.xxhash64(F.lit("second"), "blob")))
    key = ["label", "h1", "h2"]
    classes = materialize(
        read.where(F.col("blob").isNotNull()).groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "blob")).alias("r"))
        .select(*key, "copies", F.col("r.id").alias("rep"), F.col("r.blob").alias("blob")))
    links = materialize(link_classes(classes, least))
    copies = classes.select(F.col("rep").alias("to"), "copies")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("rep"), F.col("a").alias("to")))
    linked = ends.join(copies, "to").groupBy("rep").agg(F.sum("copies").alias("others"))
    known = (classes.drop("blob").join(linked, "rep", "left")
             .join(connected_components(links).withColumnRenamed("node", "rep"), "rep", "left")
             .select(*key, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    named = read.select("id", *(F.when(F.col("blob").isNotNull(), F.col(c)).alias(c) for c in key)).join(known, key, "left")
    component = F.coalesce("component", "id")
    return named.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
