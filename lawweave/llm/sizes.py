"""Sizes of texts in tokens of the public tokenizers, for problems 8 and 9."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StructField, StructType

from lawweave.llm.bpe import vocabulary
from lawweave.llm.common import tokenizer_dir


@lru_cache(maxsize=None)
def counter(name: str, folder: str | None = None) -> Callable[[str], int]:
    """A function text -> number of tokens, without special tokens; loaded once per worker process.

    ``*.tiktoken`` ranks go through the BPE encoder, ``*.model`` through sentencepiece, ``*.json`` through tokenizers.
    """
    base = os.path.join(tokenizer_dir(folder), name)
    if os.path.exists(base + ".tiktoken"):
        v = vocabulary(name, folder)
        return lambda t: len(v.encode_packed(t)) // 4
    if os.path.exists(base + ".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=base + ".model")
        return lambda t: len(sp.encode(t))
    if os.path.exists(base + ".json"):
        from tokenizers import Tokenizer

        tk = Tokenizer.from_file(base + ".json")
        tk.encode_special_tokens = True
        return lambda t: len(tk.encode(t, add_special_tokens=False).ids)
    raise ValueError(f"no tokenizer named {name!r} in {tokenizer_dir(folder)}")


@lru_cache(maxsize=None)
def token_ends(name: str, folder: str | None = None) -> Callable[[str], np.ndarray]:
    """A function text -> the place after each of its tokens, in characters."""
    base = os.path.join(tokenizer_dir(folder), name)
    if not os.path.exists(base + ".model"):
        from tokenizers import Tokenizer

        tk = Tokenizer.from_file(base + ".json")
        tk.encode_special_tokens = True
        return lambda t: np.maximum.accumulate(np.array([e for _, e in tk.encode(t, add_special_tokens=False).offsets] or [0], np.int64))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=base + ".model")
    # A token stands for as many characters as its string has; of byte tokens the first byte of a character counts.
    chars = np.array([len(p) if not sp.is_byte(k) else int((int(p[3:5], 16) & 0xC0) != 0x80) for k in range(sp.get_piece_size()) for p in [sp.id_to_piece(k)]], np.int64)

    def lengths(t: str) -> np.ndarray:
        return np.cumsum(chars[np.array(sp.encode(t), np.int64)]) - 1  # a mark stands before the first character

    blocks = ["".join(map(chr, range(o, o + 64))) for o in range(32, 0xFFC0, 64) if not 0xD7C0 < o < 0xE000]
    if all(int(lengths(b)[-1]) == len(b) for b in ("a  b", *blocks)):  # the model leaves every character as it is
        kept = (sp.id_to_piece(k).replace("▁", " ") for k in range(sp.get_piece_size()) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unused(k)))
        lengths.single = frozenset(p for p in kept if len(p) == 1)
        return lengths

    def ends(t: str) -> np.ndarray:
        return np.maximum.accumulate(np.array([p.end for p in sp.encode(t, out_type="immutable_proto").pieces], np.int64))

    return ends


@lru_cache(maxsize=None)
def crossings(name: str, folder: str | None = None) -> frozenset[str] | None:
    """Pairs of signs that some token of a sentencepiece vocabulary holds side by side; None for other tokenizers.

    Between any other two signs no token reaches over, so sizes of the parts beside such a place add up.
    """
    path = os.path.join(tokenizer_dir(folder), f"{name}.model")
    if not os.path.exists(path):
        return None
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return frozenset(p[i : i + 2] for k in range(sp.get_piece_size()) if not sp.is_byte(k) for p in [sp.id_to_piece(k)] for i in range(len(p) - 1))


@lru_cache(maxsize=None)
def single_signs(name: str, folder: str | None = None) -> frozenset[str]:
    """Signs that are tokens by themselves in a sentencepiece vocabulary; none where a model may change signs, and for other tokenizers.

    Every token but those of bytes stands for a sign or more, so a text of such signs has no more tokens than signs and the mark.
    """
    if not os.path.exists(os.path.join(tokenizer_dir(folder), f"{name}.model")):
        return frozenset()
    return getattr(token_ends(name, folder), "single", frozenset())


def token_counts(df: DataFrame, id: str, text: str, tokenizers: list[str], folder: str | None = None) -> DataFrame:
    """(id, one int column per tokenizer): the size of every text; null and empty texts have size 0.  Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [counter(n, folder) for n in tokenizers]
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(np.fromiter((c(t) if t else 0 for t in texts), np.int32, len(texts))) for c in count], names=[id, *tokenizers])

    return df.select(id, text).mapInArrow(run, StructType([df.schema[id]] + [StructField(n, IntegerType()) for n in tokenizers]))
