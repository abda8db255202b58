"""Helpers on texts that several operators share.

A word is a maximal run of characters outside ASCII white space (``[^\\x20\\x09-\\x0D]+``); ``bytes.split()`` and
Arrow's ``ascii_split_whitespace`` cut UTF-8 at exactly those bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(name: str, taken: list[str]) -> str:
    """``name`` with underscores in front until no column in ``taken`` is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name = "_" + name
    return name


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key is in no fold and counts as -1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(-1))


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part's texts have about ``most_bytes`` at most, or the part is a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = at[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(at, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text: offsets (one more than texts), a code for each word, and the words by code."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy()
    values = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if len(split) else split.values
    offsets = offsets - offsets[0]
    filled = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    if not filled.all():
        values = values.filter(pa.array(filled))
        offsets = np.concatenate([[0], np.cumsum(filled)])[offsets]
    coded = values.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return offsets.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
