"""Byte-level BPE: encode with the tiktoken library over a local rank file, decode to raw bytes.

Long texts are split before a space that follows a non-space. No match of the pattern spans such
a place (every match that holds the space starts with it, and none that ends before it looks
further), so the ids of the parts, joined, are those of the whole. A long run of white space has no
such place inside, and the library's expression gives up on it; but what the pattern matches there
is known: the whole run at the end of a text, else all of it but the last character, which belongs
to what follows. That match is merged by itself. Runs of other characters need no care.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import per_block, whole

#: Texts beyond so many characters are split, at safe boundaries, to parts of about this size.
PART_CHARS = 200_000
_SAFE = regex.compile(r"(?<=\S) ")
#: White space of so many characters in a row is merged by itself.
LONG_RUN = 10_000
_RUN = regex.compile(rf"(?<!\s)\s{{{LONG_RUN},}}")


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, most: int = PART_CHARS) -> list[str]:
    """Cut at the first safe boundary from each ``most`` characters on; a run without one stays whole."""
    out, start = [], 0
    while len(text) - start > most and (m := _SAFE.search(text, start + most)):
        out.append(text[start : m.start()])
        start = m.start()
    return [*out, text[start:]]


def encode(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit integers; what looks like a special token is text."""
    if len(text) <= LONG_RUN:
        return enc.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
    out, start = [], 0
    for run in _RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += [enc.encode_to_numpy(x, disallowed_special=()) for x in parts(text[start : run.start()])]
        out.append(np.array(enc._encode_single_piece(text[run.start() : end]), "<u4"))
        start = end
    out += [enc.encode_to_numpy(x, disallowed_special=()) for x in parts(text[start:])]
    return np.concatenate(out).astype("<u4", copy=False)


def decode(ids: np.ndarray, enc: tiktoken.Encoding) -> bytes:
    """The raw bytes, whether or not they are valid UTF-8."""
    return enc.decode_bytes(ids.tolist())


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ids (binary, u4 little-endian), n_tokens, decoded (binary).

    Null text counts as empty; an empty text has no ids. Every row is on its own: repeated rows
    and ids repeat, and no shuffle is made. A kept column must not be named as the three are."""
    out = docs.select(*keep, whole(text).alias("_text"))
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        ids = [encode(t, enc) for t in batch.column("_text").to_pylist()]
        cols = [batch.column(k) for k in keep]
        cols += [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())]
        return pa.RecordBatch.from_arrays([*cols, pa.array([decode(x, enc) for x in ids], pa.binary())], [*keep, "ids", "n_tokens", "decoded"])

    return out.mapInArrow(per_block(run, "_text"), f"{schema}, ids binary, n_tokens bigint, decoded binary")


def decode_ids(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that each row's ids stand for (null ids: null)."""

    @F.pandas_udf("binary")
    def back(col):
        enc = encoding(path)
        return col.map(lambda b: None if b is None else decode(np.frombuffer(b, "<u4"), enc))

    return frame.withColumn(out, back(ids))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the two SHA-256 digests, made beside the encoding so that neither ids
    nor bytes leave the worker. Null text is empty, a null id stays, repeated rows repeat, an empty
    table gives no rows; other columns, whatever their names, are not looked at."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        n, a, b = [], [], []
        for t in batch.column("_text").to_pylist():
            ids = encode(t, enc)
            n.append(len(ids))
            a.append(hashlib.sha256(ids.tobytes()).hexdigest())
            b.append(hashlib.sha256(decode(ids, enc)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole().alias("_text")).mapInArrow(per_block(run, "_text"), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
