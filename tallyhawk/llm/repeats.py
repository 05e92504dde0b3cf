"""Removing passages that occur earlier in the corpus: sampled suffixes of a joint text.

The text of all documents has far more suffixes than a shuffle can carry, and a cover
sample taken at fixed positions would put several of them into every window. So the
sample is a synchronising set, the content-defined form of a difference cover: of the
32-byte strings in a window of 100 bytes, the one of least hash is its anchor. Equal
windows have equal anchors at equal offsets, wherever they stand, which is what a cover
is for; one position in 35 is sampled.

1. Name the sampled suffixes by hash of their first bytes; discard names that occur once.
2. Sort what is left by name, document and position.
3. Merge in the suffixes that were not sampled: every window start belongs to one anchor
   and is compared inside its name's group only, with the bytes around the anchor.
4. Of equal prefixes of ``length`` bytes, the first in order stays, the others are removed.

A name counted more than ``BUSY`` times would be one large group. Its windows go one by
one instead, by hash of all their bytes, after equal windows of a piece are combined: what
meets in a task is equal windows only, and one place is remembered of them.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from tallyhawk.llm.bitmaps import MAP_BITS, common_bitmaps, marked, set_slots
from tallyhawk.llm.common import cut_lineage, ship_package, spread
from tallyhawk.llm.shingles import mix, powers

LENGTH = 100
#: Bytes scanned together; a longer document is scanned in pieces.
PIECE = 1_000_000
_PLACE = np.uint64((1 << 24) - 1)
#: A list of so many copies, 16 bytes each, may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Rounds that the names are compared in.
ROUNDS = 4
#: A name counted more often is compared window by window.
BUSY = 20_000
#: Texts that go to a Python worker at a time, so that workers stay small.
BATCH_ROWS = 1_000
LAST = (1 << 63) - 1
#: A place and the size of its span travel as one number.
_SPAN = 1 << 16
#: Marks, in place of the bytes left of a name, a window that is compared alone.
_WINDOW = -1


def name_bytes(length: int) -> int:
    """Bytes that name a sampled suffix."""
    return max(1, length * 8 // 25)


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which any substring's hash follows, and the factors for it."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total, down


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes at every position."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, down = _sums(data)
    return mix((total[width:] - total[:-width]) * down[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: -(width - done)], values[width - done :])
    return values


def _anchors(data: np.ndarray, bounds: np.ndarray, length: int):
    """Names, anchors, first and last window starts in ``data``, and their text's index.

    ``bounds`` are the ends of the joined texts, from 0 on.
    """
    width = name_bytes(length)
    names = _hashes(data, width)
    starts = np.arange(max(0, len(data) - length + 1))
    if not len(starts):
        return None
    ends = np.repeat(bounds[1:], np.diff(bounds))
    names_end = ends[: len(names)]
    order = (names & ~_PLACE) | np.arange(len(names), dtype=np.uint64)
    order[np.arange(len(names)) + width > names_end] = np.uint64(LAST * 2 + 1)
    least = _least(order, length - width + 1)
    starts = starts[starts + length <= ends[: len(starts)]]
    if not len(starts):
        return None
    anchor = (least[starts] & _PLACE).astype(np.int64)
    cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first, last = starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])]
    anchor = anchor[np.concatenate([[0], cut])]
    return names[anchor], anchor, first, last, np.searchsorted(bounds, first, side="right") - 1


def _pieces(texts: pa.Array, length: int):
    """Joined texts with their bounds, the index of the first, and where it begins."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1
        if to > at:
            yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at, 0
            at = to
            continue
        text = data[offsets[at] : offsets[at + 1]]
        for start in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[start : start + PIECE + length - 1]
            yield part, np.array([0, len(part)]), at, start
        at += 1


def _windows(anchors: tuple, total: np.ndarray, down: np.ndarray, place: tuple, length: int):
    """The windows of the spans ``anchors``, of one piece, that are first in it, and the other runs.

    ``place`` is the (owner, text hash, start) of each span. Gives window hashes, the index
    of their spans and starts in the piece; then index, first and last start of each run of
    windows that stand earlier in the piece.
    """
    _, _, first, last, _ = anchors
    owner, th, at = place
    sizes = last - first + 1
    span = np.repeat(np.arange(len(sizes)), sizes)
    start = first[span] + np.arange(len(span)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    window = mix((total[start + length] - total[start]) * down[start])
    order = np.lexsort((at[span] + start - first[span], th[span], owner[span], window))
    again = np.zeros(len(order), dtype=bool)
    again[order[1:]] = window[order[1:]] == window[order[:-1]]
    lead, rest = np.flatnonzero(~again), np.flatnonzero(again)
    begins = np.ones(len(rest), dtype=bool)
    begins[1:] = (rest[1:] != rest[:-1] + 1) | (span[rest[1:]] != span[rest[:-1]])
    ends = np.concatenate([begins[1:], np.ones(min(1, len(rest)), dtype=bool)])
    return window[lead], span[lead], start[lead], span[rest[begins]], start[rest[begins]], start[rest[ends]]


def _not_first(key: np.ndarray, least: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``key``, sorted, differ from the first row of their first column's value.

    ``least`` is the first row of the value that the rows before ended with.
    """
    lead = np.arange(len(key))
    lead[1:][key[1:, 0] == key[:-1, 0]] = 0
    firsts = key[np.maximum.accumulate(lead)]
    if least is not None:
        firsts[key[:, 0] == least[0]] = least
    return (key != firsts).any(axis=1), firsts[-1].copy()


def _cover(docs: DataFrame, length: int) -> DataFrame:
    """(ord, th, s, e): byte ranges of ``docs(ord, th, text)`` that occur earlier.

    The spans around repeated names are the bulk of what is shuffled. They go in ROUNDS
    shares of the names, one after the other: a round scans the texts again, and its
    shuffle is dropped before the next, so the disk holds one share at a time.
    """

    def names_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for data, bounds, _, _ in _pieces(batch.column(2), length):
            found = _anchors(data, bounds, length)
            if found is not None:
                yield found[0]

    width = name_bytes(length)
    conf = docs.sparkSession.conf
    rows = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(BATCH_ROWS, int(rows) or BATCH_ROWS)))
    try:
        return _compare_rounds(docs, length, names_of, width)
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def _compare_rounds(docs: DataFrame, length: int, names_of, width: int) -> DataFrame:
    maps = common_bitmaps(docs, names_of, (1, BUSY))
    bits = docs.sparkSession.sparkContext.broadcast((maps[0], set_slots(maps[1])))

    def one_by_one(anchors: tuple, total: np.ndarray, down: np.ndarray, place: tuple) -> pa.RecordBatch:
        owner, th, at = place
        window, span, start, later, s, e = _windows(anchors, total, down, place, length)
        begin = at - anchors[2]
        into = np.concatenate([span, later])
        where = begin[into] + np.concatenate([start, s])
        size = np.concatenate([np.full(len(span), length), e - s + length])
        # A run that is known to stand earlier only travels: any key that spreads it will do.
        key = np.concatenate([window, mix((begin[later] + s).astype(np.uint64) + th[later].view(np.uint64))])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(key.view(np.int64)), pa.array(owner[into]), pa.array(th[into]),
                pa.array(where * _SPAN + size),
                pa.array(np.repeat(np.array([_WINDOW, 0], np.int16), [len(span), len(later)])),
                pa.array([b""] * len(into), pa.binary()),
            ],
            ["name", "ord", "th", "at", "left", "span"],
        )

    def sample(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
        shared, often = np.frombuffer(bits.value[0], dtype=np.uint8), bits.value[1]
        for batch in batches:
            owners, hashes = (batch.column(k).to_numpy() for k in (0, 1))
            for data, bounds, row, start in _pieces(batch.column(2), length):
                anchors = _anchors(data, bounds, length)
                if anchors is None:
                    continue
                kept = marked(shared, anchors[0]) & (anchors[0] % np.uint64(ROUNDS) == share)
                name, anchor, first, last, text = (x[kept] for x in anchors)
                total, down = _sums(data)
                size = last - first + length
                whole = mix((total[first + size] - total[first]) * down[first]) + size.astype(np.uint64)
                owner, th, at = owners[row + text], hashes[row + text], first - bounds[text] + start
                # Of equal spans of a piece, the first alone can have a first window. The
                # others go without their bytes, and under a name that spreads them.
                order = np.lexsort((at, th, owner, name, whole))
                again = np.zeros(len(order), dtype=bool)
                again[1:] = (whole[order][1:] == whole[order][:-1]) & (name[order][1:] == name[order][:-1])
                copy, same = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
                copy[order] = again
                again[1:] &= (
                    (owner[order][1:] == owner[order][:-1]) & (th[order][1:] == th[order][:-1])
                    & (at[order][1:] == at[order][:-1])
                )
                same[order] = again  # a repeated row
                key = np.where(copy, mix(whole + at.astype(np.uint64) + th.view(np.uint64)), name)
                busy = np.flatnonzero(~copy & ~same & np.isin(name >> np.uint64(64 - MAP_BITS), often))
                if len(busy):
                    yield one_by_one(
                        tuple(x[busy] for x in (name, anchor, first, last, text)), total, down,
                        (owner[busy], th[busy], at[busy]),
                    )
                    same[busy] = True
                kept = np.flatnonzero(~same)
                # The bytes of the name are the same in its whole group and stay behind.
                sent = np.where(copy, 0, size - width)[kept]
                ends = np.concatenate([[0], np.cumsum(sent)])
                place = np.arange(ends[-1], dtype=np.int32)
                place -= np.repeat(ends[:-1], sent).astype(np.int32)
                place += np.where(place < np.repeat(anchor[kept] - first[kept], sent), 0, width).astype(np.int32)
                place += np.repeat(first[kept], sent).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[kept].view(np.int64)), pa.array(owner[kept]), pa.array(th[kept]),
                        pa.array(at[kept] * _SPAN + size[kept]), pa.array((anchor - first)[kept].astype(np.int16)),
                        pa.Array.from_buffers(
                            pa.binary(), len(kept),
                            [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[place])],
                        ),
                    ],
                    ["name", "ord", "th", "at", "left", "span"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, seen, last, least = None, np.empty(0, np.uint64), None, None
        for batch in batches:
            bare = np.asarray(pa.compute.binary_length(batch.column(5))) == 0
            gone = bare & (batch.column(4).to_numpy() != _WINDOW)
            alone = np.flatnonzero(bare & ~gone)
            if len(alone):
                later, least = _not_first(
                    np.column_stack([batch.column(k).to_numpy()[alone] for k in range(4)]), least
                )
                gone[alone] = later
            if gone.any():
                rows = batch.filter(pa.array(gone))
                at, size = np.divmod(rows.column(3).to_numpy(), _SPAN)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(1), rows.column(2), pa.array(at), pa.array(at + size)],
                    ["ord", "th", "s", "e"],
                )
            batch = batch.filter(pa.array(~bare))
            key = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]).any(axis=1)
            if last is not None and len(key):
                fresh[0] = (key[0] != last).any()
            batch = batch.filter(pa.array(fresh))  # a repeated row's spans count once
            if not batch.num_rows:
                continue
            last = key[-1]
            names = batch.column(0).to_numpy()
            at = batch.column(3).to_numpy() // _SPAN
            spans = batch.column(5)
            _, offsets, data = spans.buffers()
            offsets = np.frombuffer(offsets, np.int32)[spans.offset : spans.offset + len(spans) + 1]
            data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
            offsets = (offsets - offsets[0]).astype(np.int64)
            # A window is its bytes without the name, and where the name stands in it.
            rest = length - width
            sizes = np.diff(offsets) - rest + 1
            row = np.repeat(np.arange(len(sizes)), sizes)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            before = (batch.column(4).to_numpy()[row] - inside).astype(np.uint64)
            windows = _hashes(data, rest)[offsets[:-1][row] + inside]
            windows = mix(windows + before * np.uint64(0x9E3779B97F4A7C15)) ^ names[row].view(np.uint64)
            distinct, first = np.unique(windows, return_index=True)
            later = np.ones(len(windows), dtype=bool)
            later[first] = False
            if open_name == names[0]:
                later[first] |= np.isin(distinct, seen, assume_unique=True)
            # Rows go on being compared with the names' group that is still open.
            tail = np.unique(windows[names[row] == names[-1]])
            seen = np.union1d(seen, tail) if open_name == names[-1] else tail
            open_name = names[-1]
            edge = np.flatnonzero(later)
            if not len(edge):
                continue
            begins = np.ones(len(edge), dtype=bool)
            begins[1:] = (edge[1:] != edge[:-1] + 1) | (row[edge[1:]] != row[edge[:-1]])
            s, e = edge[begins], edge[np.concatenate([np.flatnonzero(begins)[1:] - 1, [len(edge) - 1]])]
            rows = pa.array(row[s])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(rows), batch.column(2).take(rows),
                    pa.array(at[row[s]] + inside[s]), pa.array(at[row[s]] + inside[e] + length),
                ],
                ["ord", "th", "s", "e"],
            )

    found = None
    for share in range(ROUNDS):
        part = cut_lineage(
            docs.mapInArrow(
                partial(sample, share=share),
                "name long, ord long, th long, at long, left short, span binary",
            )
            .repartition(2 * spread(docs), "name").sortWithinPartitions("name", "ord", "th", "at")
            .mapInArrow(compare, "ord long, th long, s long, e long")
        )
        found = part if found is None else found.unionByName(part)
        # Spark deletes the files of a shuffle when the driver forgets its plan.
        gc.collect()
        docs.sparkSession.sparkContext._jvm.System.gc()
    return found


def earlier_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(ord, th, ranges) for each row of ``docs(ord, th, text)`` with bytes to remove.

    Later copies of a whole text are known by a digest and are not scanned; those are
    one range. ``ranges`` are sorted and may overlap.
    """
    narrow = cut_lineage(
        docs.select("ord", "th", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
                    F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
        .where(F.col("n") >= length)
    )
    first = narrow.groupBy(F.col("digest").alias("d")).agg(F.min("ord").alias("first"))
    copies = cut_lineage(
        narrow.join(first, F.col("digest") == F.col("d")).where("ord > first")
        .select("ord", "th", "n").distinct()
    )
    listed = copies.select("ord", "th")
    if copies.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    scanned = docs.where(F.octet_length("text") >= length).join(listed, ["ord", "th"], "left_anti")
    covered = _cover(scanned.select("ord", "th", "text"), length).unionByName(
        copies.select("ord", "th", F.lit(0).cast("long").alias("s"), F.col("n").alias("e"))
    )
    return cut_lineage(
        covered.groupBy("ord", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("ranges"))
    )


def _merge(ranges) -> list[list[int]]:
    out: list[list[int]] = []
    for r in ranges or ():
        if out and r["s"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["e"])
        else:
            out.append([r["s"], r["e"]])
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn(
        "th", F.xxhash64("text")
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """``docs`` with kept (bytes), n_bytes, n_removed and n_spans of every row.

    With ``as_text``, kept is text, without the rest of characters that were cut apart.

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a
    row of smaller doc_id, or earlier in the same row. Strings are judged on the input.
    Matches never cross rows. Null texts are empty; texts shorter than ``length`` stay.
    A null doc_id comes after all others. Repeated rows, equal in doc_id and text, are one
    document, so none of them is earlier; rows of one doc_id and different texts are
    documents of their own in the order of their hashes. Columns of the four names are
    replaced. An empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    own = ["kept", "n_bytes", "n_removed", "n_spans"]
    docs = docs.drop(*own)
    columns = docs.columns
    ranges = earlier_ranges(_keyed(docs.select("doc_id", "text")), length)
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rep_ord"),
                        F.xxhash64("text").alias("rep_th"))
    same = (F.col("rep_ord") == F.col("ord")) & (F.col("rep_th") == F.col("th"))
    if ranges.count() <= BROADCAST_ROWS:
        # Texts that lose nothing need not be shuffled.
        listed = F.broadcast(ranges.select("ord", "th"))
        joined = keyed.join(listed, same, "left_semi").join(ranges.hint("merge"), same, "left").select(
            *columns, "ranges"
        ).unionByName(
            keyed.join(listed, same, "left_anti").select(*columns, F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges"))
        )
    else:
        joined = keyed.join(ranges, same, "left").select(*columns, "ranges")
    at = columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for text, ranges in zip(
                batch.column(at).cast(pa.large_binary()).to_pylist(),
                batch.column(len(columns)).to_pylist(), strict=True,
            ):
                text = text or b""
                merged = _merge(ranges)
                parts, done = [], 0
                for s, e in merged:
                    parts.append(text[done:s])
                    done = e
                parts.append(text[done:])
                rest = b"".join(parts)
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                spans.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(kept, pa.string() if as_text else pa.binary()),
                 *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)]],
                [*columns, *own],
            )

    schema = StructType(list(docs.schema.fields)).add("kept", StringType() if as_text else BinaryType())
    for name in own[1:]:
        schema = schema.add(name, LongType())
    return joined.mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes gone from ``text`` and n_chars, if there, counted anew.

    Rows that lose their whole text go; null texts stay null, all other columns as they are.
    """
    shortened = remove_repeats(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"), length, True)
    shortened = shortened.where("n_removed < n_bytes or n_bytes = 0")
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(
            columns["n_chars"]
        ).cast(docs.schema["n_chars"].dataType)
    return shortened.select(*[column.alias(c) for c, column in columns.items()])


def repeats_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
