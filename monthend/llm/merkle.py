"""Merkle manifest of a table: leaves, roots, proofs, and versions of tampered leaves.

Every row is a leaf (SHA-256 of its columns); per group the leaves, in order
of id, are hashed in runs of sixteen until one node is left, and so are the
groups' roots. The tree is kept in aligned blocks of 4,096 nodes (three
levels), one row a block. A task has one block at a time: it builds the
block's base nodes, which all versions share, and for a tampered leaf copies
only the leaf's ancestors within the block. The tops of the blocks are the
nodes of the tier above, in blocks of their own, so a table of n rows needs
log4096(n) tiers; the siblings above a block come down to it tier by tier as
one row a block, and a version goes on through them in the distributed table
of versions. Only a tier's emptiness reaches the driver. The texts are read
once and never shuffled.

Defined cases: null values are written ``-``; a null group is a group of its
own and comes first; rows with a null id come first in their group; rows
repeated under one id are leaves of their own, in order of their digests; a
single leaf is its group's root; an empty table gives an empty result; texts
of any length are hashed whole by the JVM; only the named columns are read,
so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from monthend.llm.linededup import UPPER
from monthend.session import materialize

FANOUT = 16
LEVELS = 3  # of a block, which so has up to 4,096 nodes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE_BITS = 33  # of monotonically_increasing_id, below the partition's number


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """An aligned block of a persistent tree.

    ``levels`` are the base nodes, shared by every version. A version is the
    list of nodes copied for it, one on each level; all its other nodes are
    those of the base.
    """

    def __init__(self, digests, last: bool, height: int):
        self.levels = [list(digests)]
        while len(self.levels[-1]) > 1 if last else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([sha("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, level: int, i: int) -> tuple[str, str]:
        """The other nodes of the run of node ``i``: those before it and those after it."""
        start = i - i % FANOUT
        run = self.levels[level][start:start + FANOUT]
        return "".join(run[:i - start]), "".join(run[i - start + 1:])

    def path(self, i: int) -> list[tuple[str, str]]:
        """The siblings of node ``i`` and of its ancestors in this block."""
        return [self.siblings(level, i // FANOUT ** level) for level in range(len(self.levels) - 1)]

    @staticmethod
    def version(digest: str, path: list[tuple[str, str]]) -> list[str]:
        """The nodes copied when the leaf with this path becomes ``digest``: itself and its ancestors."""
        copies = [digest]
        for left, right in path:
            copies.append(sha(left + copies[-1] + right))
        return copies


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values in order, each as UTF-8 byte count, colon, value, or ``-`` if null."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``at`` (position in the group ``g``, from 0) and ``total`` (its size), for stored ``rows``.

    Rows are dealt to ranges of ``g`` and ``order``; where a third of them
    ties in all of that, the row's own number parts them. The ranges are
    stored with the rows before they are used.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", *order, "tie"]
    ranged = materialize(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", PLACE_BITS)))
    counts = ranged.groupBy("part", "g").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    group = Window.partitionBy("g")  # a row a range at most
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", "g", (F.coalesce(before, F.lit(0)) - F.col("least")).alias("shift"),
                           F.sum("n").over(group).alias("total"))
    return (ranged.join(starts, ["part", "g"]).withColumn("at", F.col("place") + F.col("shift"))
            .drop("tie", "place", "part", "shift"))


def in_blocks(nodes: DataFrame, carried: list[str], height: int) -> DataFrame:
    """One row a block: its nodes' digests and ``carried`` columns as arrays, in order.

    ``last`` marks the blocks that are their group's only one in this tier.
    """
    held = F.sort_array(F.collect_list(F.struct("at", "digest", *carried)))
    size = FANOUT ** height
    rows = nodes.groupBy("g", "total", F.expr(f"at div {size}").alias("block")).agg(held.alias("held"))
    return rows.select("g", "total", "block", (F.col("total") <= size).alias("last"), F.lit(height).alias("height"),
                       *(F.col(f"held.{c}").alias(c) for c in ("digest", *carried)))


def _tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        digests = [Block(row.digest, row.last, row.height).top for row in rows.itertuples(index=False)]
        yield pd.DataFrame({"g": rows["g"], "at": rows["block"], "digest": digests,
                            "total": -(-rows["total"] // FANOUT ** rows["height"])})


def grow(nodes: DataFrame, carried: list[str], height: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every tier, bottom up, and the group's roots (``g``, ``digest``)."""
    tiers, roots = [], None
    while True:
        tiers.append(materialize(in_blocks(nodes, carried, height)))
        tops = materialize(tiers[-1].mapInPandas(_tops, "g string, at long, total long, digest string"))
        done = tops.where(F.col("total") == 1).select("g", "digest")
        roots = done if roots is None else roots.unionByName(done)
        nodes, carried = tops.where(F.col("total") > 1), []
        if nodes.isEmpty():
            return tiers, roots


ABOVE = "above array<struct<left: string, right: string>>, subroot string, root string"


def _down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for row in rows.itertuples(index=False):
            block = Block(row.digest, row.last, row.height)
            above = [(p["left"], p["right"]) for p in row.above]
            paths = [[{"left": a, "right": b} for a, b in block.path(i) + above] for i in range(len(row.digest))]
            first = row.block * FANOUT ** row.height
            yield pd.DataFrame({"g": row.g, "at": range(first, first + len(paths)), "last": False,
                                "above": paths, "subroot": row.subroot, "root": row.root})


def under(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The blocks with the path above each; both sides have one row a block."""
    return blocks.join(above.withColumnRenamed("at", "block"), ["g", "block", "last"])


def paths_to(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The path above every block of the lowest tier, brought down from the groups' roots.

    ``top`` holds the path above each group's root, at 0 and marked ``last``.
    """
    above = top
    for blocks in reversed(tiers[1:]):
        lower = under(blocks, above).mapInPandas(_down, f"g string, at long, last boolean, {ABOVE}")
        above = materialize(top.unionByName(lower))
    return above


def _named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for row in rows.itertuples(index=False):
            block = Block(row.digest, row.last, row.height)
            above = [(p["left"], p["right"]) for p in row.above]
            yield pd.DataFrame({
                "g": list(row.name), "at": 0, "last": True,
                "above": [[{"left": a, "right": b} for a, b in block.path(i) + above] for i in range(len(row.digest))],
                "subroot": list(row.digest), "root": row.root})


LEAVES = "array<struct<at: long, proof_sha256: string, copy: string>>"


def _leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each leaf's proof, and its version's copy of the block's top."""
    for rows in batches:
        for row in rows.itertuples(index=False):
            block = Block(row.digest, row.last, row.height)
            rest = "".join(p["left"] + p["right"] for p in row.above)
            found = []
            for i, (digest, tampered) in enumerate(zip(row.digest, row.tampered, strict=True)):
                path = block.path(i)
                proof = sha("".join(left + right for left, right in path) + rest)
                found.append({"at": i, "proof_sha256": proof,
                              "copy": Block.version(digest if tampered is None else tampered, path)[-1]})
            yield pd.DataFrame({"above": [row.above], "subroot": row.subroot, "root": row.root,
                                "id": [row.id], "leaf": [row.digest], "found": [found]})


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "source",
             tampered: dict[str, Column] | None = None, when: Column | None = None, height: int = LEVELS) -> DataFrame:
    """Per row: its id, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``tampered`` gives new values of columns for the rows where ``when``
    holds; each such row makes one version of the tree. ``height`` is the
    number of levels of a block (memory and tiers; the result is the same). ``folded_root`` is the
    root of the row's version (of the base where it was not tampered with),
    ``verified`` whether it is the root.
    """
    plain = [F.col(f"`{c}`") for c in columns]
    changed = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in columns]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("g"),
        F.col(f"`{id_col}`").alias("id"), leaf_digest(plain).alias("digest"),
        F.when(F.lit(False) if when is None else when, leaf_digest(changed)).alias("tampered"))
    tiers, subroots = grow(placed(materialize(leaves), ["id", "digest"]), ["id", "tampered"], height)

    names = materialize(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"))
    upper, roots = grow(placed(names, ["name"]), ["name"], height)
    top = roots.select("g", F.lit(0).cast("long").alias("at"), F.lit(True).alias("last"),
                       F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("above"),
                       F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    named = under(upper[0], paths_to(upper, top)).mapInPandas(_named, f"g string, at long, last boolean, {ABOVE}")
    above = paths_to(tiers, materialize(named))

    id_type = dict(docs.dtypes)[id_col]
    versions = under(tiers[0], above).mapInPandas(
        _leaves, f"{ABOVE}, id array<{id_type}>, leaf array<string>, found {LEAVES}")
    each = versions.select("above", "subroot", "root", F.explode(F.arrays_zip("id", "leaf", "found")).alias("v"))
    # the versions go on above their block: each copied node with the siblings it shares
    folded = F.aggregate("above", F.col("v.found.copy"),
                         lambda node, run: F.sha2(F.concat(run["left"], node, run["right"]).cast("binary"), 256))
    return (each.select(F.col("v.id").alias(id_col), "v.leaf", "subroot", "root", "v.found.proof_sha256",
                        folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def tampered_manifest(docs: DataFrame, every: int = 5) -> DataFrame:
    """The manifest of ``documents`` where texts of ids with a CRC-32 that ``every`` divides are lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(every) == 0
    return manifest(docs, tampered={"text": lower_ascii(F.col("text"))}, when=chosen)


def crc_table() -> str:
    """SQL of the CRC-32 table, as a list: the common reversed polynomial applied to each byte."""
    return ("list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def crc_of(text: str, table: str) -> str:
    """SQL of the unsigned CRC-32 of the UTF-8 bytes of ``text``."""
    data = (f"list_transform(range(octet_length(encode({text}))), "
            f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {data}), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")


def _sql_levels(nodes: str, prefix: str, levels: int) -> str:
    """CTEs ``{prefix}0..{prefix}{levels}``: per level each node, its siblings and what it becomes."""
    out = [f"{prefix}0 AS (SELECT g, pos, digest, count(*) OVER (PARTITION BY g) AS n FROM {nodes})"]
    run = "PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
    for k in range(levels):
        out.append(
            f"{prefix}s{k} AS (SELECT g, pos, n, digest,"
            f" coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"
            f" FROM {prefix}{k})")
        out.append(
            f"{prefix}{k + 1} AS (SELECT g, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(digest)"
            f" ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest, any_value((n + 15) // 16) AS n"
            f" FROM {prefix}{k} GROUP BY g, pos // 16)")
    return ",\n".join(out)


def _sql_fold(start: str, prefix: str, levels: int, out: str) -> str:
    """CTEs that take ``start`` (row, g, pos, node, proof) up through the levels."""
    steps, name = [], start
    for k in range(levels):
        steps.append(
            f"{out}{k} AS (SELECT v.row, v.g, v.pos // 16 AS pos, CASE WHEN s.n = 1 THEN v.node"
            f" ELSE sha256(s.l || v.node || s.r) END AS node, v.proof || s.l || s.r AS proof"
            f" FROM {name} v JOIN {prefix}s{k} s ON s.g = v.g AND s.pos = v.pos)")
        name = f"{out}{k}"
    return ",\n".join(steps)


def _sql(depth: int = 6, upper: int = 3) -> str:
    """The manifest in SQL, for up to 16 ** depth leaves a source and 16 ** upper sources."""
    def leaf(text: str) -> str:
        parts = " || ".join(
            f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
            for c in ("doc_id", "source", "lang", "n_chars", text))
        return f"sha256({parts})"

    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    return f"""
WITH c AS (SELECT {crc_table()} AS t),
leaves AS (
  SELECT coalesce('=' || source, '') AS g, doc_id, {leaf('text')} AS digest,
         CASE WHEN {crc_of("coalesce(doc_id, 0)::VARCHAR", "t")} % 5 = 0 AND doc_id IS NOT NULL
              THEN {leaf(lowered)} END AS tampered
  FROM documents, c),
base AS (SELECT *, row_number() OVER () AS row,
                row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves),
{_sql_levels("base", "a", depth)},
subroots AS (SELECT g AS name, digest FROM a{depth}),
named AS (SELECT '' AS g, name, digest, row_number() OVER (ORDER BY encode(name)) - 1 AS pos FROM subroots),
{_sql_levels("named", "b", upper)},
start AS (SELECT row, g, pos, coalesce(tampered, digest) AS node, '' AS proof FROM base),
{_sql_fold("start", "a", depth, "f")},
middle AS (SELECT f.row, '' AS g, m.pos, f.node, f.proof FROM f{depth - 1} f JOIN named m ON m.name = f.g),
{_sql_fold("middle", "b", upper, "h")}
SELECT d.doc_id, d.digest AS leaf, m.digest AS subroot, z.digest AS root, sha256(h.proof) AS proof_sha256,
       h.node AS folded_root, h.node = z.digest AS verified
FROM h{upper - 1} h JOIN base d ON d.row = h.row JOIN named m ON m.name = d.g JOIN b{upper} z ON z.pos = 0
"""


SQL = _sql()
