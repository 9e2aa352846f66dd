"""Token counts with a whole-token shortcut (operator 1).

A vocabulary string that the merges rebuild from its bytes as one token, and that the
pre-token pattern leaves whole, always counts one. ``prove_whole`` finds that set offline,
once, on the vocabulary alone. Counting then looks each pre-token up in the proven set and
merges only the rest. The tokenizer file is read on the driver; its content (a fixed size)
is broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from prefspark.llm.bpe import Memo, merge_heap, slices
from prefspark.llm.common import map_batches

#: The split of byte-level tokenizers (fixed value of the format).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the byte-level format -> byte: printable Latin-1 stands for itself,
    the other bytes, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevelModel:
    """Merges and special strings of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer or prefix space is supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special strings that strip or match whole words are not supported")
        letters = byte_alphabet()
        raw = lambda s: bytes(letters[c] for c in s)
        pairs = [[raw(x) for x in (m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.merges = {a + b: i for i, (a, b) in enumerate(pairs)}
        self.left = [len(a) for a, _ in pairs]
        if len(self.merges) != len(pairs):
            raise ValueError("two merges make the same token")
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.whole = self.prove_whole([raw(s) for s in model["vocab"] if s not in set(self.specials)])

    def prove_whole(self, tokens: list[bytes]) -> frozenset[str]:
        """Vocabulary strings that are valid text, stay one pre-token and merge into one token."""
        split = regex.compile(BYTE_LEVEL_PATTERN)
        proven = []
        for token in tokens:
            try:
                text = token.decode()
            except UnicodeDecodeError:
                continue
            # the last alternatives look ahead, so a string can only be matched whole if it splits whole
            if split.findall(text) == [text] and len(merge_heap(token, self.merges, self.left)) == 1:
                proven.append(text)
        return frozenset(proven)


class TokenCounter(Memo):
    """Pre-token -> number of tokens: 1 if it is in the proven set; the rest is merged. Both are remembered."""

    def __init__(self, model: ByteLevelModel):
        super().__init__()
        self.model = model
        self.find_all = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.cut = regex.compile("|".join(map(regex.escape, model.specials))) if model.specials else None

    def resolve(self, pre: str) -> int:
        if pre in self.model.whole:
            return 1
        return len(merge_heap(pre.encode(), self.model.merges, self.model.left))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.cut is None or not any(s in text for s in self.model.specials):
            return sum(map(self.__getitem__, self.find_all(text)))
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.find_all(p))) for p in parts)


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(df: DataFrame, tokenizer_path: str, text_col: str = "text", count_col: str = "n_tokens") -> DataFrame:
    """Add ``count_col`` (long): tokens of the whole text, special strings inside counted as one each.

    Null text counts as empty (0). Rows stay in their partition: no shuffle.
    """
    kept = [c for c in df.columns if c != count_col]
    source = df.select(*kept)
    schema = StructType([*source.schema.fields, StructField(count_col, LongType(), False)])
    shared = df.sparkSession.sparkContext.broadcast(ByteLevelModel(tokenizer_path))
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _COUNTERS:
            _COUNTERS[tokenizer_path] = TokenCounter(shared.value)
        count = _COUNTERS[tokenizer_path].count
        for batch in batches:
            for part in slices(batch, at):
                counts = np.fromiter((count(t or "") for t in part.column(at).to_pylist()), np.int64, part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts)], [*kept, count_col])

    return map_batches(source, run, schema)
