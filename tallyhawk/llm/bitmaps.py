"""How common the hashes of a corpus are, as bitmaps of a fixed size.

Every hash of every document is counted. Hashes are sent sorted, as gaps, so a hash
costs about three bytes of shuffle. The bitmaps only tell apart; whoever uses them must
get the same result, at more cost, when two hashes share a bit.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhawk.llm.common import spread

#: A bitmap has 2 ** MAP_BITS bits; a larger corpus may take up to 30.
MAP_BITS = 27
#: Counted hashes are cut to so many bits.
COUNT_BITS = 40
#: Hashes sorted together before they are sent.
FLUSH = 2_000_000
SLICES = 256


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The row groups of a stream that is sorted by ``keys``."""
    parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        arrays = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for a in arrays:
            change[1:] |= a[1:] != a[:-1]
        change[0] = last is not None and last != tuple(a[0] for a in arrays)
        at = 0
        for cut in np.flatnonzero(change):
            if cut > at:
                parts.append(batch.slice(at, cut - at))
            if parts:
                yield pa.Table.from_batches(parts)
            parts, at = [], cut
        parts.append(batch.slice(at))
        last = tuple(a[-1] for a in arrays)
    if parts:
        yield pa.Table.from_batches(parts)


def common_bitmaps(
    df: DataFrame,
    hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    above: tuple[int, ...],
    map_bits: int = MAP_BITS,
) -> tuple[bytes, ...]:
    """For each number of ``above`` a bitmap of the hashes counted more often.

    ``hashes_of`` gives arrays of 64-bit hashes for a batch of ``df``. The driver gets
    2 ** map_bits bits for each bitmap, whatever the size of the corpus.
    """
    shift = np.uint64(64 - COUNT_BITS)
    per_slice = np.uint64((1 << COUNT_BITS) // SLICES)
    width = (1 << map_bits) // SLICES

    def send(hashes: list[np.ndarray]) -> pa.RecordBatch:
        values = np.sort(np.concatenate(hashes) >> shift)
        cuts = np.searchsorted(values, np.arange(SLICES + 1, dtype=np.uint64) * per_slice)
        ids, blobs = [], []
        for k in range(SLICES):
            part = values[cuts[k] : cuts[k + 1]]
            if len(part):
                gaps = np.diff(part, prepend=np.uint64(k) * per_slice).astype(np.uint32)
                planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T)
                ids.append(k)
                blobs.append(zlib.compress(planes.tobytes(), 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "gaps"]
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for hashes in hashes_of(batch):
                held.append(hashes)
                n += len(hashes)
                if n >= FLUSH:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["slice"]):
            k = table.column("slice")[0].as_py()
            values = []
            for blob in table.column("gaps").to_pylist():
                planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(4, -1)
                gaps = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
                values.append(np.cumsum(gaps, dtype=np.uint64))
            found, counts = np.unique(np.concatenate(values), return_counts=True)
            place = (found >> np.uint64(COUNT_BITS - map_bits)).astype(np.int64)
            maps = []
            for least in above:
                bits = np.zeros(width, dtype=bool)
                bits[place[counts > least]] = True
                maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([maps], pa.list_(pa.binary()))],
                ["slice", "maps"],
            )

    rows = (
        df.mapInArrow(scan, "slice int, gaps binary")
        .repartition(min(SLICES, 2 * spread(df)), "slice").sortWithinPartitions("slice")
        .mapInArrow(mark, "slice int, maps array<binary>").collect()
    )
    maps = {r["slice"]: [zlib.decompress(m) for m in r["maps"]] for r in rows}
    empty = [bytes(width // 8)] * len(above)
    return tuple(b"".join(maps.get(k, empty)[i] for k in range(SLICES)) for i in range(len(above)))


def set_slots(bitmap: bytes) -> np.ndarray:
    """The numbers of the bits that are set, in order: a small list where few are."""
    data = np.frombuffer(bitmap, dtype=np.uint8)
    at = np.flatnonzero(data)
    byte, bit = np.nonzero(np.unpackbits(data[at, None], axis=1))
    return (at[byte] * 8 + bit).astype(np.uint64)


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set in ``bitmap``, the bytes of one bitmap."""
    map_bits = len(bitmap).bit_length() + 2
    slot = (hashes >> np.uint64(64 - map_bits)).astype(np.int64)
    return (bitmap[slot >> 3] & (np.uint8(128) >> (slot & 7).astype(np.uint8))) != 0
