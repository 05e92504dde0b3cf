"""Fill-in-the-middle form of documents, as one ``pyarrow.compute`` pipeline per batch.

A text is cut into units, code points by default. Two cuts divide them into prefix, middle
and suffix, and the pieces are written behind sentinels in one of two orders::

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle

Inside a task the units of many texts are one list array over the bytes of the batch. It is
flattened with parent indices; a unit's ordinal in its text gives its role; units are
filtered by role, the lists built again, and their pieces joined. Texts are worked through
a fixed number of bytes at a time, long ones in several parts, so a task holds little
more than its Arrow batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import ship_package
from tallyhawk.llm.shingles import joined_texts

#: Bytes whose units are laid out at a time.
PART_BYTES = 1_000_000
UNITS = ("char", "word", "line")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Sentinels(NamedTuple):
    """The marks before prefix, suffix and middle.

    The first characters of the marks may not occur later in any of them, so that no mark
    appears where a piece and a mark meet and every output can be taken apart again.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def checked(self) -> Sentinels:
        heads = {mark[:1] for mark in self}
        if "" in heads or len(set(self)) < 3 or any(c in heads for mark in self for c in mark[1:]):
            raise ValueError("sentinels must differ, and not repeat the character they begin with")
        return self


def unit_starts(data: np.ndarray, bounds: np.ndarray, unit: str) -> np.ndarray:
    """Byte offsets at which the units of the joined texts begin.

    A char is a code point, a word a run of other characters with the white space after
    it (white space before the first word is a unit), a line ends with its line feed.
    """
    begins = np.zeros(len(data), dtype=bool)
    if unit == "char":
        np.not_equal(data & 0xC0, 0x80, out=begins)
    elif unit == "word":
        space = _SPACE[data]
        begins[1:] = space[:-1] & ~space[1:]
    elif unit == "line":
        begins[1:] = data[:-1] == 0x0A
    else:
        raise ValueError(f"unit is one of {UNITS}, not {unit!r}")
    begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.flatnonzero(begins)


def _list_of(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _units(data: np.ndarray, bounds: np.ndarray, unit: str) -> pa.ListArray:
    """One list of units per text; the units share the bytes of the batch."""
    starts = unit_starts(data, bounds, unit)
    offsets = np.append(starts, len(data)).astype(np.int32)
    flat = pa.Array.from_buffers(pa.utf8(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    first = np.searchsorted(starts, bounds).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), flat)


def _parts(data: np.ndarray, bounds: np.ndarray, unit: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The joined texts at most PART_BYTES at a time, but for one longer unit: bytes, bounds, text of each part."""
    if len(data) <= PART_BYTES:
        yield data, bounds, np.arange(len(bounds) - 1)
        return
    starts = unit_starts(data, bounds, unit)
    marks = np.unique(np.concatenate([
        bounds, starts[np.minimum(np.searchsorted(starts, np.arange(0, len(data), PART_BYTES)), len(starts) - 1)]
    ]))
    at = 0
    while at < len(marks) - 1:
        to = max(at + 1, int(np.searchsorted(marks, marks[at] + PART_BYTES, side="right")) - 1)
        a, b = marks[at], marks[to]
        some = np.concatenate([[a], np.unique(bounds[(bounds > a) & (bounds < b)]), [b]])
        yield data[a:b], some - a, np.searchsorted(bounds, some[:-1], side="right") - 1
        at = to


def count_units(texts: pa.Array, unit: str = "char") -> np.ndarray:
    """Number of units of each text."""
    found = [
        np.diff(np.searchsorted(unit_starts(data, bounds, unit), bounds)) for data, bounds, _ in joined_texts(texts)
    ]
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def cut_pieces(texts: pa.Array, low: np.ndarray, high: np.ndarray, unit: str = "char") -> list[pa.Array]:
    """Prefix, middle and suffix of every text: units before ``low``, before ``high``, and the rest."""
    out: list[list[pa.Array]] = [[], [], []]
    for data, bounds, at in joined_texts(texts):
        owners: list[np.ndarray] = []
        pieces: list[list[pa.Array]] = [[], [], []]
        before, last = 0, -1  # units of the last text that earlier parts held
        for part, part_bounds, owner in _parts(data, bounds, unit):
            units = _units(part, part_bounds, unit)
            sizes = np.diff(units.offsets.to_numpy())
            skip = np.zeros(len(owner), dtype=np.int64)
            skip[owner == last] = before
            parents = pc.list_parent_indices(units).to_numpy()
            ordinals = np.arange(len(parents)) - units.offsets.to_numpy()[parents] + skip[parents]
            owned = at + owner[parents]
            role = pc.add(
                pc.greater_equal(pa.array(ordinals), pa.array(low[owned])).cast(pa.int8()),
                pc.greater_equal(pa.array(ordinals), pa.array(high[owned])).cast(pa.int8()),
            )
            flat = pc.list_flatten(units)
            for k in range(3):
                mine = pc.equal(role, pa.scalar(k, pa.int8()))
                counts = np.bincount(parents[mine.to_numpy(zero_copy_only=False)], minlength=len(owner))
                pieces[k].append(pc.binary_join(_list_of(counts, pc.filter(flat, mine)), ""))
            owners.append(owner)
            if len(owner):
                before = (before if owner[-1] == last else 0) + int(sizes[owner == owner[-1]].sum())
                last = owner[-1]
        counts = np.bincount(np.concatenate(owners), minlength=len(bounds) - 1) if owners else np.zeros(len(bounds) - 1)
        for k in range(3):
            joined = pa.concat_arrays(pieces[k]) if pieces[k] else pa.array([], pa.utf8())
            out[k].append(pc.binary_join(_list_of(counts, joined), ""))
    return [pa.concat_arrays(found) if found else pa.array([], pa.utf8()) for found in out]


def write_forms(texts: pa.Array, form: pa.Array, pieces: list[pa.Array], marks: Sentinels) -> pa.Array:
    """The output of every text from its pieces and form; a plain text as it is."""
    prefix, middle, suffix = pieces
    psm = pc.binary_join_element_wise(marks.prefix, prefix, marks.suffix, suffix, marks.middle, middle, "")
    spm = pc.binary_join_element_wise(marks.suffix, suffix, marks.prefix, prefix, marks.middle, middle, "")
    return pc.if_else(pc.equal(form, "plain"), texts, pc.if_else(pc.equal(form, "psm"), psm, spm))


def read_forms(output: pa.Array, form: pa.Array, marks: Sentinels) -> pa.Array:
    """The exact texts again, from outputs and forms alone."""
    n = len(output)
    places, parts = [], []
    for name, one, two in (("plain", "", ""), ("psm", marks.prefix, marks.suffix), ("spm", marks.suffix, marks.prefix)):
        mine = pc.equal(form, name)
        places.append(np.flatnonzero(mine.to_numpy(zero_copy_only=False)))
        some = pc.filter(output, mine)
        if name != "plain" and len(some):
            halves = pc.split_pattern(pc.utf8_slice_codeunits(some, len(one)), two, max_splits=1)
            first = pc.list_element(halves, 0)
            rest = pc.split_pattern(pc.list_element(halves, 1), marks.middle, max_splits=1)
            second, middle = pc.list_element(rest, 0), pc.list_element(rest, 1)
            prefix, suffix = (first, second) if name == "psm" else (second, first)
            some = pc.binary_join_element_wise(prefix, middle, suffix, "")
        parts.append(some)
    order = np.empty(n, dtype=np.int64)
    order[np.concatenate(places)] = np.arange(n)
    return pc.take(pa.concat_arrays(parts), pa.array(order))


def draws(key: Column) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``1:`` and the key, as numbers.

    A missing key counts as no digits.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, marks: Sentinels = Sentinels(), unit: str = "char", plain_share: int = 10, spm_share: int = 20
) -> DataFrame:
    """``docs(doc_id, text)`` in fill-in-the-middle form, one row each.

    doc_id, n (units), form (plain, psm or spm), prefix_units and middle_units (null where
    plain) and output. Cuts and form follow from doc_id alone: ``plain_share`` of a hundred
    documents stay plain, as do texts that are empty or hold a sentinel; of the others
    ``spm_share`` of a hundred are spm. A null text is empty; a null doc_id draws from the
    digest of ``1:``. Repeated rows give equal rows, an empty table an empty one, other
    columns play no part. Texts of any length are read whole; a text as long as half of what
    Arrow's 32-bit offsets reach (1 GB) is the limit of one cell.
    """
    marks.checked()
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}, not {unit!r}")
    ship_package(docs.sparkSession)
    held = "|".join(re.escape(mark) for mark in marks)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            n = count_units(texts, unit)
            h = [batch.column(f"h{k}").to_numpy() for k in range(4)]
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            plain = pc.or_(
                pc.match_substring_regex(texts, held),
                pa.array((n == 0) | (h[2] % 100 >= 100 - plain_share)),
            )
            form = pc.if_else(plain, "plain", pc.if_else(pa.array(h[3] % 100 < spm_share), "spm", "psm"))
            output = write_forms(texts, form, cut_pieces(texts, low, high, unit), marks)
            nothing = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), form,
                 pc.if_else(plain, nothing, pa.array(low)), pc.if_else(plain, nothing, pa.array(high - low)), output],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output"],
            )

    drawn = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id").cast("long")))],
    )
    return drawn.mapInArrow(
        transform, "doc_id long, n long, form string, prefix_units long, middle_units long, output string"
    )


def restored(forms: DataFrame, marks: Sentinels = Sentinels()) -> DataFrame:
    """What ``fill_in_middle`` returned with ``text``, rebuilt from output and form."""
    marks.checked()
    ship_package(forms.sparkSession)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = read_forms(batch.column("output"), batch.column("form"), marks)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "text"])

    names = ", ".join(f"{name} {kind}" for name, kind in forms.dtypes)
    return forms.mapInArrow(rebuild, f"{names}, text string")


def infill_digest(docs: DataFrame) -> DataFrame:
    """Form, pieces and hashes of the output and of the text rebuilt from it."""
    return restored(fill_in_middle(docs)).select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


INFILL_SQL = """
select doc_id, n, form, case when form <> 'plain' then low end as prefix_chars,
    case when form <> 'plain' then high - low end as middle_chars,
    sha256(case form when 'plain' then text
        when 'psm' then '<P>' || text[1:low] || '<S>' || text[high + 1:] || '<M>' || text[low + 1:high]
        else '<S>' || text[high + 1:] || '<P>' || text[1:low] || '<M>' || text[low + 1:high] end) as output_sha256,
    sha256(text) as restored_sha256
from (
    select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
        case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
            when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from (
        select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
            ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
            ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
        from (select doc_id, text, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents) d
    ) e
) f
"""
