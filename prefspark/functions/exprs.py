"""Scalar column expressions shared by the operators (all JVM-side, code-generated)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word tokenizer splits on space, tab, carriage return and line feed only.
TOKEN_PATTERN = r"[^ \t\r\n]+"
# Fixed value: chat template markers are written ``<|name|>``.
MARKER_PATTERN = r"(<\|[a-z_]+\|>)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Whitespace word tokens of a text, in order (never ``\\s``: no Unicode-space folding).

    A template marker is a token of its own, even where it touches a word.
    """
    t = _c(text)
    parted = F.when(F.contains(t, F.lit("<|")), F.regexp_replace(t, MARKER_PATTERN, " $1 ")).otherwise(t)
    return F.regexp_extract_all(parted, F.lit(TOKEN_PATTERN), 0)


def softplus(x) -> Column:
    """Numerically stable ``ln(1 + exp(x))``."""
    x = _c(x)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def log_sigmoid(x) -> Column:
    """Stable ``ln(sigmoid(x)) = -softplus(-x)``; finite at |x| = 800 where the naive form is not."""
    return -softplus(-_c(x))


def md5_key(*parts) -> Column:
    """md5 hex of the parts joined with ':' (numbers rendered as decimal strings)."""
    return F.md5(F.concat_ws(":", *[_c(p).cast("string") for p in parts]))


def unit_uniform(*parts) -> Column:
    """A repeatable draw in (0, 1): first 8 hex digits of ``md5_key(parts)`` as an integer, centred."""
    hi = F.conv(F.substring(md5_key(*parts), 1, 8), 16, 10).cast("double")
    return (hi + F.lit(0.5)) / F.lit(4294967296.0)


def round6(x) -> Column:
    """Round to 6 decimals for hash-stable output, as ``floor(x * 1e6 + 0.5) / 1e6``.

    Engines disagree on ``round`` at exact ties of the double value (decimal vs binary
    rounding), so output rounding is spelled as plain IEEE operations that any SQL
    engine evaluates bit-identically; ``+ 0.0`` turns -0.0 into 0.0.
    """
    return F.floor(_c(x).cast("double") * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0) + F.lit(0.0)


def ids_string(arr) -> Column:
    """Render an int array as a space-joined string (hash-stable output form)."""
    return F.array_join(F.transform(_c(arr), lambda v: v.cast("string")), " ")


def strip_line(line) -> Column:
    """SF1: strip surrounding ASCII whitespace of a line (space, tab, LF, CR, VT, FF), as a
    line strip does -- plain ``trim`` would only remove spaces."""
    return F.btrim(_c(line), F.lit(" \t\n\r\x0b\x0c"))


def last_segment(path) -> Column:
    """SF5: last '/'-separated segment of a path or model name."""
    return F.element_at(F.split(_c(path), "/"), -1)
