"""A bit filter of fixed size over a set of ids, to thin a table before a join.

Rows whose id is surely not in the set are left out where they are read, so
that a wide table moves only about its matching rows. The filter has
``2 ** BITS`` bits (8 MB) whatever the set's size; a full one would let more
rows through, which the join that follows sorts out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthend.llm.words import mix

BITS, SLICE = 26, 16


def places(ids: np.ndarray) -> np.ndarray:
    """Bit of each id."""
    return (mix(ids.astype(np.int64).view(np.uint64) + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> Broadcast:
    """The filter of the one bigint column of ``ids``, sent to all executors."""
    name = ids.columns[0]

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(at >> SLICE), pa.array(at & (1 << SLICE) - 1)], ["part", "bit"])

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[int, np.ndarray] = {}  # of this task's parts, of which there are 2 ** (BITS - SLICE) in all
        for frame in frames:
            for part, bits in frame.groupby("part")["bit"]:
                slices.setdefault(part, np.zeros(1 << SLICE, bool))[bits.to_numpy()] = True
        if slices:
            yield pd.DataFrame({"part": list(slices), "bits": [np.packbits(s, bitorder="little").tobytes() for s in slices.values()]})

    some = ids.where(F.col(name).isNotNull()).mapInArrow(bits_of, "part bigint, bit bigint").distinct()
    filled = np.zeros(1 << BITS - 3, np.uint8)
    size = 1 << SLICE - 3
    for row in some.repartition("part").mapInPandas(pack, "part bigint, bits binary").toLocalIterator():
        filled[row["part"] * size:(row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(filled)


def thin(rows: DataFrame, id_col: str, sent: Broadcast) -> DataFrame:
    """``rows`` without most of those whose id is not in the filter; null ids go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = places(batch.column(id_col).to_numpy())
            yield batch.filter(pa.array(((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)))

    return rows.where(F.col(id_col).isNotNull()).mapInArrow(run, rows.schema)
