"""Sets of 64-bit hashes as bitmaps of a fixed size, to be sent to every task.

A bitmap says "no" only of what is not in the set; of some of the rest it says "yes" too.  Use
it to leave work out early where an exact comparison follows, or where extra work does no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB, whatever the number of hashes.
BITS = 27
PAGE = 15


class Bitmap:
    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.mask = np.uint64(len(cells) * 8 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.uint64, copy=False) & self.mask
        return (self.cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(hashes: DataFrame, column: Column, bits: int | None = None) -> Bitmap:
    """Of a column of 64-bit hashes: each page is made in one task, from its own positions."""
    bits = BITS if bits is None else bits
    at = column.bitwiseAND(F.lit((1 << bits) - 1))
    dealt = hashes.select(at.alias("at")).repartition(F.shiftright("at", PAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            every = np.unique(batch.column(0).to_numpy())
            cut = np.flatnonzero(np.diff(every >> PAGE)) + 1
            for own in np.split(every, cut) if len(every) else []:
                page = pages.setdefault(int(own[0]) >> PAGE, np.zeros(1 << PAGE, bool))
                page[own & (1 << PAGE) - 1] = True
        for number, page in pages.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 pa.array([np.packbits(page, bitorder="little").tobytes()], pa.binary())],
                ["page", "bits"])

    cells = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << PAGE) // 8
    for row in dealt.mapInArrow(run, "page long, bits binary").collect():  # all pages together are the bitmap
        cells[row["page"] * size:(row["page"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Bitmap(cells)
