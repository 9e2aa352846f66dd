"""Fill-in-middle transformation with a learned rank index of the cuts (operator 12).

A text is cut at two code points into prefix, middle and suffix and written in another order, so that a
model reads both sides before the middle. Where the n-th code point starts in the UTF-8 bytes is looked up
in a piecewise-linear model of all boundaries: segments are grown over (code point, byte offset) as long as
one line stays within ``EPSILON`` bytes of every boundary under them, and what the line misses is stored as
one signed byte a boundary. A cut is predicted by its segment's line and corrected by its residual, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from prefspark.llm.bpe import slices
from prefspark.llm.common import binary_list, map_batches

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A line may miss a boundary by so many bytes; with rounding, residuals fit a signed byte.
EPSILON = 64
#: Bytes that are fitted at a time, and so the most boundaries under one segment.
SPAN = 1 << 16


@dataclass
class RankIndex:
    """From code point to byte offset: segment i starts at code point ``starts[i]`` and byte ``bases[i]``."""

    starts: np.ndarray
    bases: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray  # a signed byte for each boundary, the end of the text included

    @property
    def length(self) -> int:
        """Code points of the text."""
        return len(self.residuals) - 1

    def offset(self, rank: int) -> int:
        """The byte at which code point ``rank`` starts; the text's bytes if it is its length."""
        at = int(np.searchsorted(self.starts, rank, side="right")) - 1
        line = np.floor(self.bases[at] + self.slopes[at] * (rank - self.starts[at]) + 0.5)
        return int(line) + int(self.residuals[rank])


def _grow(y: np.ndarray, at: int) -> tuple[int, float]:
    """How far one line from boundary ``at`` of ``y`` keeps within EPSILON of all boundaries, and its slope."""
    low, high, end, step = -np.inf, np.inf, at + 1, 64
    while end < len(y):
        x = np.arange(end - at, min(len(y), end + step) - at, dtype=np.float64)
        rise = (y[end : end + len(x)] - y[at]).astype(np.float64)
        lows = np.maximum.accumulate(np.maximum((rise - EPSILON) / x, low))
        highs = np.minimum.accumulate(np.minimum((rise + EPSILON) / x, high))
        fits = int(np.searchsorted(lows > highs, True))  # the cone only narrows, so the first misfit ends it
        if fits:
            low, high, end = float(lows[fits - 1]), float(highs[fits - 1]), end + fits
        if fits < len(x):
            break
        step *= 4
    return end, 1.0 if end == at + 1 else 1.0 if low <= 1.0 <= high else (low + high) / 2


def fit(data: bytes) -> RankIndex:
    """The index of every boundary of UTF-8 ``data``: each byte that continues no code point, and the end.

    Fitted ``SPAN`` bytes at a time, so that what is held besides the index does not grow with the text.
    """
    view = np.frombuffer(data, np.uint8)
    starts, bases, slopes, residuals, done = [], [], [], [], 0
    for at in range(0, len(view) + 1, SPAN):
        part = view[at : at + SPAN]
        y = np.flatnonzero((part & 0xC0) != 0x80) + at
        if at + SPAN > len(view):
            y = np.append(y, len(view))
        first = 0
        while first < len(y):
            end, slope = _grow(y, first)
            base = int(y[first])
            line = np.floor(base + slope * np.arange(end - first) + 0.5)
            starts.append(done + first)
            bases.append(base)
            slopes.append(slope)
            residuals.append((y[first:end] - line).astype(np.int8))
            first = end
        done += len(y)
    return RankIndex(np.array(starts, np.int64), np.array(bases, np.float64), np.array(slopes), np.concatenate(residuals))


def draws(key: Column, seed: int = 1, count: int = 4) -> list[Column]:
    """Unsigned 32-bit draws of a row: the first groups of 8 hex digits of the SHA-256 of ``seed:key``."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 90, spm_rate: int = 20, seed: int = 1
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output (existing columns of these names are replaced).

    Of 100 texts about ``rate`` are transformed, and of these about ``spm_rate`` as suffix, prefix, middle (``spm``), the
    others as prefix, suffix, middle (``psm``). An empty or null text (output: empty) and one that contains a
    mark stay ``plain``, with null lengths. Draws depend on id and seed alone: rows that repeat an id are cut by the same draws,
    null ids draw as the empty id. Texts of any length are cut whole; an empty table stays empty.
    """
    added = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*kept, *[h.alias(f"_fim{i}") for i, h in enumerate(draws(F.col(id_col), seed))])
    fields = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
              StructField("middle_chars", LongType()), StructField("output", StringType())]
    schema = StructType([*docs.select(*kept).schema.fields, *fields])
    at = kept.index(text_col)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def one(text: bytes, h: list[int]) -> tuple:
        index = fit(text)
        n = index.length
        if not text or any(mark in text for mark in marks) or h[2] % 100 >= rate:
            return n, "plain", None, None, text
        first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = index.offset(first), index.offset(second)
        parts = (p, text[:a], s, text[b:], m, text[a:b])
        form = "psm"
        if h[3] % 100 < spm_rate:
            form, parts = "spm", (s, text[b:], p, text[:a], m, text[a:b])
        return n, form, first, second - first, b"".join(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                drawn = np.stack([part.column(len(kept) + i).to_numpy() for i in range(4)], axis=1).tolist()
                rows = [one(text, h) for text, h in zip(binary_list(part.column(at)), drawn, strict=True)]
                n, form, first, middle, out = zip(*rows, strict=True)
                made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()), pa.array(middle, pa.int64()),
                        pa.array(out, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], schema.names)

    return map_batches(source, run, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output was made of. A mark stands once in an output, as no transformed text contains one."""
    out = F.col(output)
    tail = F.substring_index(out, MIDDLE, -1)
    left = F.substring_index(out, MIDDLE, 1)

    def sides(opening: str, between: str) -> tuple[Column, Column]:
        before = F.substring_index(left, between, 1)
        return F.substring(before, len(opening) + 1, F.char_length(before)), F.substring_index(left, between, -1)

    prefix, suffix = sides(PREFIX, SUFFIX)
    suffix_first, prefix_second = sides(SUFFIX, PREFIX)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, tail, suffix))
        .when(F.col(form) == "spm", F.concat(prefix_second, tail, suffix_first))
        .otherwise(out)
    )
