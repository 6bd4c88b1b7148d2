"""Token counts of whole texts under a sentence-piece model, in Arrow functions that return lengths only.

A long text is cut at single spaces between two other characters. No piece of the model
holds a space mark after another character (checked when the model is loaded), and the
library puts a space mark before each text it encodes, so the part after such a space,
given without it, has the tokens it has inside the text. Parts are encoded in batches of
about equal bytes.

Null or empty text: 0 bytes, 0 tokens. Repeated rows are counted one by one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stallmetrics.llm.common import sized, texts

#: Characters of a part, and of the parts that are encoded in one call.
PART_CHARS = 8192
CALL_CHARS = 1 << 19
_MARK = "▁"


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    safe = model.encode("a") == model.encode(" a")[-1:] and not any(_MARK in p.lstrip(_MARK) for p in pieces)
    safe = safe and model.encode("a b") == model.encode("a") + model.encode("b")
    return model, safe


def safe_parts(text: str, size: int = PART_CHARS) -> list[str]:
    """``text`` in parts of ``size`` characters or somewhat more, cut at lone spaces only."""
    parts, start = [], 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut != -1 and (cut + 1 == len(text) or text[cut - 1] in (" ", _MARK) or text[cut + 1] in (" ", _MARK)):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        parts.append(text[start:cut])
        start = cut + 1
    parts.append(text[start:])
    return parts


def lengths(model_path: str, given: list[str]) -> np.ndarray:
    """Tokens of each text."""
    model, safe = _model(model_path)
    parts, owner = [], []
    for k, text in enumerate(given):
        for part in safe_parts(text) if safe else [text]:
            parts.append(part)
            owner.append(k)
    found = np.zeros(len(given), dtype=np.int64)
    call, chars, first = [], 0, 0
    for j, part in enumerate([*parts, None]):
        if call and (part is None or chars + len(part) > CALL_CHARS):
            n = [len(ids) for ids in model.encode(call, num_threads=1)]
            np.add.at(found, owner[first:j], n)
            call, chars, first = [], 0, j
        if part is not None:
            call.append(part)
            chars += len(part)
    return found


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the text has more than ``limit`` tokens."""

    def count(batches):
        for batch in sized(batches, "text"):
            given = texts(batch)
            n = lengths(model_path, given)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(t.encode()) for t in given], pa.int64()), pa.array(n, pa.int64()),
                 pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
