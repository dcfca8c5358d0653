"""MinHash near-dedup with an LSH forest.

Each document has a set of word shingles and, for each of several trees, a
label of minhash values. Documents with equal sets form a class, and one
document of each class goes on. Every tree lists all labels in sorted order,
so that the labels with the longest common prefix stand side by side; a
document's candidates are its nearest neighbours there, as long as they share
a prefix of ``MIN_DEPTH`` values. The documents that share it are a region.

Of these neighbours each document is paired with the most similar by sketch,
unless their sketches disagree too much for the threshold (by a margin of
about five standard deviations). Pairs are confirmed on their full sets.

A region of several components that holds more documents than neighbours
were paired is then gone through whole: all its pairs between different
components are compared by signature and the similar ones on their full sets,
each in the first tree that brings it together; only links leave the region.
A region of any size is compared whole, at the same prefix: above ``CROWD``
documents it is dealt in parts, each pair of parts to a task of its own. Its
largest component is only what the other documents are compared with, so one
large group of copies is sent once for every ``CROWD`` of the others.

A text moves only if its document has candidates. Sorted orders are cut into
ranges, a crowded region into several; a task that compares signatures holds
about two times ``CROWD`` of them at most.

Defined cases: a text without words (or null) has an empty set and is linked
with nothing; fewer words than a shingle has make one shingle of the whole
sequence; repeated rows are classes like other copies; an id that stands for
several texts is one document, linked through each of them; rows with a null
id are linked with nothing, their component is null and they are kept; texts
of any length are read whole, in slices of about a megabyte or one text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.components import connected_components, merged, release
from monthend.llm.idfilter import id_filter, thin
from monthend.llm.words import mix, shingle_sets, text_slices, words_of
from monthend.session import materialize

TREES, DEPTH, MIN_DEPTH = 16, 8, 3
NEIGHBOURS = 8     # places on either side that are looked at
PARTNERS = 2       # of them, those that a document is paired with in a tree
CROWD = 8192       # documents of a part of a region; a task compares two parts
CELL = 1 << 20     # shingles of a region that a task compares with as many others
SKETCH = 64        # bytes compared before full sets are
SKETCH_MARGIN = 0.25
SIGNATURE_MARGIN = 0.18  # the same for whole signatures, of twice as many values

_FUNCTIONS = np.random.default_rng(20_240).integers(0, 1 << 63, (2, TREES * DEPTH), np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minhash values (texts x trees * depth, 32 bits) of nonempty sets."""
    out = np.empty((len(first) - 1, TREES * DEPTH), np.uint32)
    for i in range(TREES * DEPTH):
        values = sets * _FUNCTIONS[0, i]
        values += _FUNCTIONS[1, i]
        out[:, i] = np.minimum.reduceat(values, first[:-1]) >> np.uint64(32)
    return out


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Each row of a 2-d byte array as a binary value."""
    n, width = rows.shape
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(rows))])


def byte_rows(col: pa.Array, width: int) -> np.ndarray:
    """The inverse of ``fixed_binary``, without nulls."""
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(len(col), width)


def texts_with_prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, print, text``: an id may stand for several texts, the hash tells which."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("print"),
                       F.col(text_col).alias("text"))


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Of every row ``id, print`` (the text's hash), ``n`` (set size), ``fp1, fp2`` (set fingerprint), ``signature``, ``sketch``.

    The sketch is the low bytes of some of the signature's values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets, first = shingle_sets(words_of(batch.column("text"), lower=True), size)
            n = np.diff(first)
            some = np.flatnonzero(n)
            signature = np.zeros((len(n), TREES * DEPTH), np.uint32)
            fp1, fp2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(some):
                starts = first[:-1][some]
                signature[some] = signatures(sets, np.append(starts, len(sets)))
                mixed = mix(sets + np.uint64(1))
                fp1[some] = np.add.reduceat(mixed, starts)
                fp2[some] = np.bitwise_xor.reduceat(mix(mixed ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
            sketch = signature[:, ::TREES * DEPTH // SKETCH].astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("print"), pa.array(n, pa.int64()), pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)),
                 fixed_binary(signature.astype(">u4").view(np.uint8)), fixed_binary(sketch)],
                ["id", "print", "n", "fp1", "fp2", "signature", "sketch"])

    return texts_with_prints(docs, id_col, text_col).mapInArrow(
        run, "id bigint, print bigint, n bigint, fp1 bigint, fp2 bigint, signature binary, sketch binary")


def regions_of(rows: np.ndarray, tree: int) -> np.ndarray:
    """Of signatures (bytes) a tree and its prefix of ``MIN_DEPTH`` values, as one number."""
    values = np.ascontiguousarray(rows[:, 4 * DEPTH * tree:4 * DEPTH * (tree + 1)]).view(">u4").astype(np.uint64)
    number = np.full(len(rows), tree, np.uint64)
    for depth in range(MIN_DEPTH):
        number = mix(number * np.uint64(0x9E3779B97F4A7C15) + values[:, depth])
    return number.view(np.int64)


def forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree: ``region`` (tree and shortest prefix), ``label`` (the rest), ``rep, n, sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = byte_rows(batch.column("signature"), 4 * TREES * DEPTH)
            for tree in range(TREES):
                label = rows[:, 4 * (DEPTH * tree + MIN_DEPTH):4 * DEPTH * (tree + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(regions_of(rows, tree)), fixed_binary(label), batch.column("rep"), batch.column("n"),
                     batch.column("sketch")], ["region", "label", "rep", "n", "sketch"])

    return classes.select("signature", "rep", "n", "sketch").mapInArrow(
        run, "region bigint, label binary, rep bigint, n bigint, sketch binary")


def crowded(classes: DataFrame, component: DataFrame) -> DataFrame:
    """``region, tree, rep, n, component, signature, parts, whole, big`` of mixed regions where pairs were passed over.

    A region of more than ``CROWD`` documents is dealt: its largest component
    (``big``) in ``whole`` parts, the other documents in ``parts``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = byte_rows(batch.column("signature"), 4 * TREES * DEPTH)
            for tree in range(TREES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(regions_of(rows, tree)), pa.array(np.full(len(rows), tree, np.int32)), batch.column("rep")],
                    ["region", "tree", "rep"])

    places = classes.select("signature", "rep").mapInArrow(run, "region bigint, tree int, rep bigint")
    sizes = places.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PARTNERS + 1)
    rows = materialize(places.join(sizes.select("region"), "region").join(component, F.col("rep") == F.col("node"), "left")
                       .select("region", "tree", "rep", F.coalesce("component", "rep").alias("component")))
    counts = rows.groupBy("region", "component").agg(F.count(F.lit(1)).alias("own"))
    mixed = counts.groupBy("region").agg(F.sum("own").alias("size"), F.max(F.struct("own", "component")).alias("top")).where(
        F.col("size") > F.col("top.own"))
    in_parts = lambda n: F.when(F.col("size") > CROWD, F.ceil(n / CROWD)).cast("int")
    dealt = mixed.select("region", F.col("top.component").alias("largest"),
                         F.coalesce(in_parts(F.col("size") - F.col("top.own")), F.lit(1)).alias("parts"),
                         F.coalesce(in_parts(F.col("top.own")), F.lit(0)).alias("whole"))
    return (rows.join(dealt, "region").withColumn("big", (F.col("whole") > 0) & (F.col("component") == F.col("largest")))
            .drop("largest").join(classes.select("rep", "n", "signature"), "rep"))


def cells(rows: DataFrame) -> DataFrame:
    """The rows of ``crowded`` with their ``part``, once for each pair of parts ``i <= j`` whose documents are compared.

    Parts of the largest component come last and meet only those of the other
    documents, so a cell holds two parts of about ``CROWD`` documents at most,
    however large the region or the component.
    """
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("big"), F.col("whole")).otherwise(F.col("parts"))).cast("int")
    last = F.when(F.col("big"), F.col("parts")).otherwise(F.col("parts") + F.col("whole")) - 1
    return (rows.withColumn("part", F.when(F.col("big"), F.col("parts")).otherwise(F.lit(0)) + own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
            .select("region", "i", "j", *Region.names, "signature"))


class Region:
    """Documents of a region that are compared: those of one part with each other, or of two parts across.

    The largest component comes first, or the larger part, which has nothing
    to compare within.
    """

    names = ("n", "component", "rep", "tree", "part")

    def __init__(self, columns: dict[str, np.ndarray], values: np.ndarray, percent: int, across: bool):
        _, which, sizes = np.unique(columns["part" if across else "component"], return_inverse=True, return_counts=True)
        self.order = np.lexsort((which, -sizes[which]))
        self.n, self.component, self.rep, self.tree, _ = (columns[c][self.order] for c in self.names)
        self.values, self.others, self.percent, self.across = values[self.order], int(sizes.max()), percent, across
        self.least_agree = int(TREES * DEPTH * (percent / 100 - SIGNATURE_MARGIN))

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """(j, earlier places) whose signatures agree enough, each pair in the first tree that brings it together."""
        for j in range(self.others, len(self.n)):
            to = self.others if self.across else j
            i = np.flatnonzero((self.component[:to] != self.component[j])
                               & (100 * np.minimum(self.n[:to], self.n[j]) >= self.percent * np.maximum(self.n[:to], self.n[j])))
            same = self.values[i] == self.values[j]
            enough = same.sum(1) >= self.least_agree
            i, same = i[enough], same[enough]
            met = same.reshape(len(i), TREES, DEPTH)[:, :self.tree[j], :MIN_DEPTH].all(2)
            i = i[~met.any(1)]
            if len(i):
                yield j, i


def in_regions(rows: DataFrame, percent: int) -> DataFrame:
    """``region, rep`` of the documents that have a candidate there; each cell is a task's of its own."""
    cell = ["region", "i", "j"]

    def within(key: tuple, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = Region(dict(zip(Region.names, columns[:-1], strict=True)), columns[-1], percent, key[1] != key[2])
        has = np.zeros(len(own.n), bool)
        for j, i in own.candidates():
            has[j] = has[i] = True
        if has.any():
            rep = own.rep[has]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rep), key[0])), pa.array(rep)], ["region", "rep"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in (*cell, *Region.names)]
            new.append(byte_rows(batch.column("signature"), 4 * TREES * DEPTH).view(np.uint32))
            held = [np.concatenate([x, y]) for x, y in zip(held, new, strict=True)] if held else new
            other = np.any([x[1:] != x[:-1] for x in held[:3]], axis=0)
            cut = [0, *(np.flatnonzero(other) + 1).tolist()]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                yield from within(tuple(x[i] for x in held[:3]), [x[i:j] for x in held[3:]])
            held = [x[cut[-1]:] for x in held]  # the last cell may go on in the next batch
        if held:
            yield from within(tuple(x[0] for x in held[:3]), held[3:])

    return cells(rows).repartition(*cell).sortWithinPartitions(*cell).mapInArrow(run, "region bigint, rep bigint")


def confirm_in_regions(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` between components within regions, from the texts of ``rows``.

    A region is dealt in parts of about ``CELL`` shingles, each pair of parts
    to a task of its own. Only links come out, one of each document and
    component at most.
    """
    rows = rows.drop("parts", "whole", "big")
    parts = rows.groupBy("region").agg(F.ceil(F.sum("n") / CELL).cast("int").alias("parts"))
    cell = ["region", "i", "j"]
    dealt = (rows.join(parts, "region").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}))

    def compare(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = {c: np.array([r[k] for r in held]) for k, c in enumerate(Region.names)}
        own = Region(columns, np.stack([r[5] for r in held]), percent, key[1] != key[2])
        sets = [held[k][6] for k in own.order]
        a, b = [], []
        for j, i in own.candidates():
            cat, mine = np.concatenate([sets[k] for k in i]), sets[j]
            hit = mine[np.minimum(np.searchsorted(mine, cat), len(mine) - 1)] == cat
            both = np.add.reduceat(hit, np.cumsum([0, *(len(sets[k]) for k in i[:-1])]), dtype=np.int64)
            i = i[100 * both >= percent * (own.n[i] + own.n[j] - both)]
            i = i[np.unique(own.component[i], return_index=True)[1]]
            a += np.minimum(own.rep[i], own.rep[j]).tolist()
            b += np.maximum(own.rep[i], own.rep[j]).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in text_slices(batches, "text"):
            sets, first = shingle_sets(words_of(batch.column("text"), lower=True), size)
            values = byte_rows(batch.column("signature"), 4 * TREES * DEPTH).view(np.uint32)
            keys = zip(*(batch.column(c).to_pylist() for c in cell), strict=True)
            rest = zip(*(batch.column(c).to_pylist() for c in Region.names), strict=True)
            for k, (own, row) in enumerate(zip(keys, rest, strict=True)):
                if own != key and held:
                    yield from compare(key, held)
                    held = []
                key = own
                held.append((*row, values[k], sets[first[k]:first[k + 1]]))
        if held:
            yield from compare(key, held)

    return (dealt.select(*cell, *Region.names, "signature", "text").repartition(*cell)
            .sortWithinPartitions(*cell).mapInArrow(run, "a bigint, b bigint"))


def neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``a, b``: neighbours in each tree's sorted order."""
    least_agree = int(SKETCH * (percent / 100 - SKETCH_MARGIN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in ("region", "rep", "n")]
            new.append(byte_rows(batch.column("sketch"), SKETCH))
            seen = len(last[0]) if last else 0
            region, rep, n, sketch = (np.concatenate([x, y]) for x, y in zip(last, new, strict=True)) if last else new
            score = np.full((NEIGHBOURS, len(region)), -1, np.int64)  # agreement with the row so many places back
            for step in range(1, NEIGHBOURS + 1):
                j = np.arange(max(seen, step), len(region))
                i = j - step
                ok = region[i] == region[j]
                ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                agree = (sketch[i] == sketch[j]).sum(1)
                score[step - 1, j] = np.where(agree >= least_agree, agree, -1)
            found = []
            for _ in range(PARTNERS):
                step = score.argmax(0)
                j = np.flatnonzero(score[step, np.arange(len(region))] >= 0)
                i = j - step[j] - 1
                found.append((np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])))
                score[step[j], j] = -1
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            last = [x[-NEIGHBOURS:] for x in (region, rep, n, sketch)]

    listed = rows.repartitionByRange("region", "label", "rep").sortWithinPartitions("region", "label", "rep")
    return listed.mapInArrow(run, "a bigint, b bigint").distinct()


def confirm(pairs: DataFrame, pool: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets are similar enough.

    ``pool`` has the texts. A pair's texts meet where its first document's
    pairs are; they stream by, one set held.
    """
    roles = pairs.select(F.col("a").alias("hub"), F.col("b").alias("id"), F.lit(1).alias("leaf")).unionByName(
        pairs.select(F.col("a").alias("hub"), F.col("a").alias("id"), F.lit(0).alias("leaf")).distinct())
    rows = roles.join(pool, "id").repartition("hub").sortWithinPartitions("hub", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in text_slices(batches, "text"):
            sets, first = shingle_sets(words_of(batch.column("text"), lower=True), size)
            a, b = [], []
            for i, (key, node, leaf) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hub", "id", "leaf")),
                                                      strict=True)):
                own = sets[first[i]:first[i + 1]]
                if not leaf:
                    hub, hub_set = key, own
                    continue
                if key != hub:
                    raise ValueError("a pair's first document is missing")
                both = len(np.intersect1d(hub_set, own, assume_unique=True))
                if 100 * both >= percent * (len(hub_set) + len(own) - both):
                    a.append(key)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def one_id(own: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between the classes of the texts that stand under one id."""
    own_set = F.struct("fp1", "fp2")
    several = materialize(own.groupBy("id").agg(F.min(own_set).alias("least"), F.max(own_set).alias("most"))
                          .where(F.col("least") != F.col("most")).select("id"))
    of = (own.select("id", "fp1", "fp2").join(several, "id", "left_semi").distinct()
          .join(classes.select("fp1", "fp2", "rep"), ["fp1", "fp2"]))
    least = of.groupBy("id").agg(F.min("rep").alias("a"))
    return materialize(of.join(least, "id").where(F.col("a") != F.col("rep")).select("a", F.col("rep").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: its id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if 100 * intersection >= percent * union of
    their shingle sets; a component is named by its smallest id, and its
    document of that id is kept.
    """
    sketches = materialize(sketch_documents(docs, id_col, text_col, shingle_words))
    own = sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
    grouped = own.groupBy("fp1", "fp2").agg(F.min(F.struct("id", "print", "n", "signature", "sketch")).alias("r"))
    classes = materialize(grouped.select("fp1", "fp2", F.monotonically_increasing_id().alias("rep"), "r.id", "r.print",
                                         "r.n", "r.signature", "r.sketch"))
    spark = docs.sparkSession
    same = one_id(own, classes)
    del own, grouped
    release(spark)
    texts = texts_with_prints(docs, id_col, text_col)

    def texts_of(reps):
        """``id`` (a class), ``text`` of these classes."""
        wanted = materialize(reps.distinct().join(classes.select("rep", "id", "print"), "rep"))
        found = thin(texts, "id", id_filter(wanted.select("id").distinct())).join(wanted, ["id", "print"])
        return materialize(found.select(F.col("rep").alias("id"), "text").dropDuplicates(["id"]))

    pairs = materialize(neighbours(forest(classes), percent))
    pool = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")))
    component = connected_components(confirm(pairs, pool, shingle_words, percent).unionByName(same))
    del pairs, pool
    rows = materialize(crowded(classes, component))
    release(spark)
    some = materialize(in_regions(rows, percent))
    if not some.isEmpty():
        passed = rows.join(some, ["region", "rep"], "left_semi")
        pool = texts_of(some.select("rep")).withColumnRenamed("id", "rep")
        component = merged(component, materialize(confirm_in_regions(passed.join(pool, "rep"), shingle_words, percent)))
    first = classes.select("fp1", "fp2", "rep", F.col("id").alias("first"))
    names = (component.join(first, F.col("node") == F.col("rep")).groupBy("component").agg(F.min("first").alias("name")))
    named = (sketches.select("id", "n", "fp1", "fp2").join(first, ["fp1", "fp2"], "left")
             .join(component.join(names, "component").select("node", "name"), F.col("rep") == F.col("node"), "left"))
    found = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("name", "first", "id"))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"),
                        F.coalesce(F.col("id") == found, F.lit(True)).alias("kept"))
