"""Embedding.

The default encoder is a hashed bag of words: token -> bucket
``int(sha256(token)[:8], 16) % dim``, term counts, L2-normalised, float32.
An ASCII text goes to an Arrow UDF as it is, which lower-cases it and puts spaces between its tokens by a table of bytes; Spark
does so for other texts. The UDF splits a text there, hashes each distinct token of a slice of rows once (and keeps the hashes of recent ones) and counts the whole slice with one ``np.bincount``. A user encoder (``Callable[[list[str]], np.ndarray]``) runs
through ``mapInPandas`` once per Arrow batch, loaded once per Python worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.plan import model_key, worker_model
from tessera.functions.text import byte_table, collection_name, spaced_tokens, translated, unless_ascii, word_tokens
from tessera.sources.collections import collection_append

DIM = 64
#: Rows whose tokens are hashed and counted at a time, at most, and their bytes, at most about.
SLICE_ROWS, SLICE_BYTES = 8192, 1 << 20
_SPACED = byte_table()


def bucket_ids(col, dim: int = DIM) -> Column:
    toks = word_tokens(col)
    return F.transform(toks, lambda t: F.pmod(F.conv(F.substring(F.sha2(t, 256), 1, 8), 16, 10).cast("bigint"),
                                              F.lit(dim)).cast("int"))


#: Hashes of tokens that a worker keeps: of the first it meets, so of the frequent ones.
KEPT_HASHES = 1 << 17
_HASHES: dict[bytes, int] = {}


def _token_hash(token: bytes) -> int:
    h = int.from_bytes(hashlib.sha256(token).digest()[:4], "big")
    if len(_HASHES) < KEPT_HASHES:
        _HASHES[token] = h
    return h


def _token_buckets(tokens: pa.Array, dim: int) -> np.ndarray:
    """Bucket of each token, as ``bucket_ids`` has it, -1 for an empty one; a token that repeats is hashed once."""
    coded = tokens.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    found = list(map(_HASHES.get, words))
    for i, h in enumerate(found):
        if h is None:
            found[i] = _token_hash(words[i]) if words[i] else -1
    of = np.array(found, dtype=np.int64)
    return np.where(of < 0, -1, of % dim)[coded.indices.to_numpy()]


def _count_vectors(rows: pa.Array, dim: int) -> np.ndarray:
    """Unit-length bucket counts (n, dim) of n token lists; a list without tokens gives zeros."""
    n_of = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
    at = np.repeat(np.arange(len(rows)) * dim, n_of)
    of = _token_buckets(rows.flatten(), dim)
    real = of >= 0  # between two separators there is no token
    v = np.bincount(at[real] + of[real], minlength=len(rows) * dim).reshape(-1, dim).astype(np.float64)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))  # counts: exact in any order
    return np.divide(v, norm, out=v, where=norm > 0).astype(np.float32)


def _slices(rows: pa.Array):
    ends = np.cumsum(pc.fill_null(pc.binary_length(rows), 0).to_numpy(), dtype=np.int64)
    lo = 0
    while lo < len(rows):
        upto = ends[lo - 1] if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(ends, upto + SLICE_BYTES, side="right"))), lo + SLICE_ROWS, len(rows))
        yield rows.slice(lo, hi - lo)
        lo = hi


def _count_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def _vec(rows: pa.Array) -> pa.Array:
        parts = [_count_vectors(pc.split_pattern(translated(part, _SPACED), " "), dim).ravel() for part in _slices(rows)]
        values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dim, type=pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(values), mask=rows.is_null())
    return _vec


def hashed_embedding(col, dim: int = DIM) -> Column:
    """Column: default unit-length hashed bag-of-words vector (array<float>)."""
    return _count_udf(dim)(unless_ascii(col, spaced_tokens(col)))


def hashed_embeddings(texts: Column, dim: int = DIM) -> Column:
    """Column: the default vectors of an array of texts (array<array<float>>), one Arrow stage."""
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def _vecs(rows: pd.Series) -> pd.Series:
        out = []
        for row in rows:
            vecs = []
            for b in [] if row is None else row:
                v = np.bincount(np.asarray(b, dtype=np.int64), minlength=dim).astype(np.float64)
                n = np.sqrt(np.dot(v, v))
                vecs.append((v / n if n > 0 else v).astype(np.float32))
            out.append(vecs)
        return pd.Series(out)

    return _vecs(F.transform(texts, lambda t: bucket_ids(t, dim)))


def embed(df: DataFrame, text: str, out: str = "embedding", encoder: Callable | None = None,
          dim: int = DIM, batch_rows: int = 256, encoder_factory: Callable[[], Callable] | None = None) -> DataFrame:
    """Add ``out`` = vector of ``text`` (E4). ``encoder`` maps a list of texts to an (n, d) array;
    ``encoder_factory`` builds such an encoder once per Python worker (heavy models)."""
    if encoder is None and encoder_factory is None:
        return df.withColumn(out, hashed_embedding(text, dim))
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])
    key = model_key(encoder_factory) if encoder is None else None

    def run(it):
        nonlocal encoder
        if encoder is None:
            encoder = worker_model(encoder_factory, key)
        for pdf in it:
            for i in range(0, len(pdf), batch_rows):
                part = pdf.iloc[i:i + batch_rows].copy()
                vecs = np.asarray(encoder(part[text].fillna("").tolist()), dtype=np.float32)
                part[out] = list(vecs)
                yield part

    return df.mapInPandas(run, schema)


def l2_normalize(col) -> Column:
    """Scale to unit L2 norm, in double; a zero vector stays zero (E5)."""
    c = F.col(col) if isinstance(col, str) else col
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(c, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(x.cast("double")))


def collection_build(chunks: DataFrame, store: str, model: str, splitter: str, env: str = "dev",
                     encoder: Callable | None = None, mode: str = "skip") -> str:
    """Embed chunks and append them to their named collection; skipped if it holds rows."""
    name = chunks.sparkSession.range(1).select(collection_name(F.lit(model), F.lit(splitter), F.lit(env))).first()[0]
    vecs = embed(chunks, "page_content", encoder=encoder)
    collection_append(vecs, store, name, mode=mode)
    return name
