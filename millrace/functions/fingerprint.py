"""64-bit SimHash fingerprints, bands and Hamming distance."""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .text import TOKEN, all_of


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def bands(h: Column, n: int = 4, bits: int = 64) -> list[Column]:
    """n slices of equal width, from the top."""
    if bits % n:
        raise ValueError("bits must be a multiple of the number of bands")
    w = bits // n
    mask = (1 << w) - 1 if w < 64 else -1
    return [F.shiftrightunsigned(h, bits - w * (i + 1)).bitwiseAND(F.lit(mask).cast("long")) for i in range(n)]


def block_masks(blocks: int = 6) -> list[int]:
    """The bits of each block, as signed 64-bit numbers."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (z - a)) - 1) << a for a, z in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_keys(h: Column, blocks: int = 6, agree: int = 3) -> Column:
    """Keys of which fingerprints within (blocks - agree) bits share one at least: every choice of `agree` of the blocks.

    At three bits the keys have 30 bits or more, where four bands have 16: buckets stay small as the corpus grows.
    """
    masks, out = block_masks(blocks), []
    for no, choice in enumerate(combinations(range(blocks), agree)):
        mask = F.lit(sum(masks[i] for i in choice)).cast("long")
        out.append(F.struct(F.lit(no).alias("no"), h.bitwiseAND(mask).alias("key")))
    return F.array(*out)


def first_shared(a: Column, b: Column, no: Column, blocks: int = 6, agree: int = 3) -> Column:
    """Whether `no` is the first of the keys that two fingerprints share: of the blocks up to its last, they agree on its own only.

    A pair is thus found under one of its keys, and nothing has to be made distinct after the join.
    """
    differ = a.bitwiseXOR(b)
    same = [differ.bitwiseAND(F.lit(m).cast("long")) == 0 for m in block_masks(blocks)]
    agreed = reduce(Column.__add__, [F.when(x, 1 << i).otherwise(0) for i, x in enumerate(same)])
    choices = [sum(1 << i for i in c) for c in combinations(range(blocks), agree)]
    ups = F.array(*[F.lit((1 << c.bit_length()) - 1) for c in choices])
    return agreed.bitwiseAND(F.get(ups, no)) == F.get(F.array(*map(F.lit, choices)), no)


def simhash_md5(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, simhash: native; each token weighs as often as it occurs, hashed by the first 64 bits of MD5; ties give 0.

    A text's tokens come from one row, so the 64 sums are combined before the shuffle, which gets one row for each text.
    """
    tokens = df.select(F.col(id_col), F.explode_outer(all_of(F.lower(F.col(text_col)), TOKEN)).alias("token"))
    hexed = F.md5(F.col("token").cast("binary"))
    h = tokens.select(id_col, F.conv(F.substring(hexed, 1, 8), 16, 10).cast("long").alias("hi"), F.conv(F.substring(hexed, 9, 8), 16, 10).cast("long").alias("lo"))
    one = F.lit(1).cast("long")
    sums = [F.sum(2 * F.shiftright("lo" if i < 32 else "hi", i % 32).bitwiseAND(one) - 1).alias(f"s{i}") for i in range(64)]
    total = h.groupBy(id_col).agg(*sums)
    bit = [F.when(F.col(f"s{i}") > 0, F.shiftleft(one, i)).otherwise(F.lit(0).cast("long")) for i in range(64)]
    return total.select(id_col, reduce(Column.bitwiseOR, bit).alias("simhash"))


@lru_cache(maxsize=100_000)
def _digest(token: str) -> bytes:
    return hashlib.blake2b(token.encode(), digest_size=8).digest()


def simhash_of(text: str | None) -> int:
    """The same with BLAKE2b token hashes; unsigned. Empty or without tokens: 0."""
    import re

    counts = Counter(re.findall(TOKEN, (text or "").lower()))
    if not counts:
        return 0
    raw = b"".join(map(_digest, counts))
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).astype(np.int64)
    weight = np.fromiter(counts.values(), np.int64)
    score = 2 * (weight @ bits) - weight.sum()
    return int.from_bytes(np.packbits(score > 0).tobytes(), "big")


def signed(h: int) -> int:
    """Two's complement of 64 bits."""
    return h - (1 << 64) if h >> 63 else h


@F.pandas_udf(LongType())
def simhash_blake2b_of(text: pd.Series) -> pd.Series:
    """The same as a column, where a join by id would move texts; null for a null text."""
    return pd.Series([None if t is None else int(np.uint64(simhash_of(t)).view(np.int64)) for t in text], dtype="Int64")


def simhash_blake2b(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, simhash (two's complement) by Arrow batches."""

    def run(batches):
        for b in batches:
            h = np.array([simhash_of(t) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h.view(np.int64), pa.int64())], [id_col, "simhash"])

    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, simhash bigint")


def unsigned(h: Column) -> Column:
    """For output: the fingerprint as DECIMAL(20,0)."""
    d = h.cast("decimal(20,0)")
    return F.when(h < 0, d + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(d).cast("decimal(20,0)")
