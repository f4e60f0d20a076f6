"""Token counts of sections by offsets.

A whole document is encoded once; each token covers a span of the text's bytes, and spans are
joined with the sections' intervals. Encoding sections one by one would give other tokens at
their borders.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "largest")
RESULT = "doc_id long, section int, start_char long, n_chars long, n_tokens long, n_crossing long"


def load_encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(encoding) -> np.ndarray:
    """Bytes of each token id."""
    return np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)], np.int64)


def line_bounds(text: bytes) -> np.ndarray:
    """Byte bounds of the lines of a text, each with its line end; one empty section for an empty text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.unique(np.concatenate([[0], ends, [len(text)]])) if text else np.array([0, 0])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and border-crossing tokens per section.

    ``ends`` are the tokens' byte ends, ``bounds`` the sections' bounds, both ascending. A token
    over a border goes to the section of its first or last byte, or to the one that holds most of
    its bytes (the earliest of equals); it counts as crossing in every section it touches.
    """
    n = len(bounds) - 1
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(bounds[1:], starts, side="right")
    last = np.searchsorted(bounds[1:], ends - 1, side="right")
    owner = (last if rule == "last" else first).copy()
    crossing = np.zeros(n, np.int64)
    for t in np.flatnonzero(first != last):
        touched = np.arange(first[t], last[t] + 1)
        crossing[touched] += 1
        if rule == "largest":
            owner[t] = touched[np.argmax(np.minimum(bounds[touched + 1], ends[t]) - np.maximum(bounds[touched], starts[t]))]
    return np.bincount(owner, minlength=n) if len(ends) else np.zeros(n, np.int64), crossing


def count_sections(docs: DataFrame, encoding: str, rule: str = "largest") -> DataFrame:
    """Tokens per line of each document.

    Sections cover a text without gaps, so its sections' ``n_tokens`` add up to its tokens. Null and
    empty texts have one empty section. Repeated rows give repeated results; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches):
        encoder = load_encoding(encoding)
        sizes = token_lengths(encoder)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                raw = (text or "").encode()
                ids = np.array(encoder.encode_ordinary(text or ""), np.int64)
                bounds = line_bounds(raw)
                tokens, crossing = attribute(np.cumsum(sizes[ids]), bounds, rule)
                heads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80  # one per character
                chars = np.concatenate([[0], np.cumsum(heads)])[bounds]
                out.append((np.arange(len(tokens)), chars[:-1], np.diff(chars), tokens, crossing))
            if out:
                repeats = [len(o[0]) for o in out]
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(out)), repeats)))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(np.concatenate(c).astype(t)) for c, t in zip(zip(*out), ("i4", "i8", "i8", "i8", "i8")))],
                    [f.split()[0] for f in RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)
