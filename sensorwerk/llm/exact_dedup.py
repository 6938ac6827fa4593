"""Exact dedup (6): minimal perfect hash over the historical distinct digests.

The corpus is split into a history (rows up to the median ``doc_id``) and a new batch. The
history's distinct SHA-256 digests are grouped into digest-prefix buckets of bounded size; each
bucket becomes one index row: a minimal perfect hash (cascaded collision-free bit levels, slot =
rank of the bit) whose slots hold the full digest, the winner's locator and its copy count. The
new batch, pre-aggregated to distinct digests, looks its slots up bucket by bucket and compares
all 32 bytes: members are repeats of the slot's winner, non-members form their own groups.

Defined cases: null text counts as empty; null ``doc_id`` ranks after every other id; of
repeated rows with one id one row stays; an empty table gives an empty result; other columns
are not read, so clashing names do not matter.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.llm.common import SPACE, materialize

BUCKET_KEYS = 16_384      # distinct digests in one index row (about 1 MB)
GAMMA = 2.0               # bits per key of each level of the hash
MAX_LEVELS = 40

INDEX_SCHEMA = ("bucket long, n_keys long, level_bits array<long>, bits binary, digests binary, "
                "ids binary, no_id binary, rids binary, copies binary")


def _slot_hash(words: np.ndarray, level: int) -> np.ndarray:
    """64-bit mix of a digest's four words, another one at every level."""
    x = words[:, level % 4] ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_mph(digests: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and their bits. ``digests``: distinct rows of 32 bytes."""
    words, left = digests.view("<u8").reshape(-1, 4), np.arange(len(digests))
    sizes, levels = [], []
    for level in range(MAX_LEVELS):
        if not len(left):
            break
        size = max(64, int(GAMMA * len(left)))
        at = (_slot_hash(words[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        left = left[~alone[at]]
    if len(left):
        raise ValueError("digests of a bucket are not distinct")
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def lookup_mph(sizes: list[int], bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of every digest; -1 where no level claims it. Members get distinct slots 0..n-1."""
    words = digests.view("<u8").reshape(-1, 4)
    rank = np.cumsum(bits) - 1
    slot = np.full(len(digests), -1, np.int64)
    left, base = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = base + (_slot_hash(words[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return slot


def _rows32(col) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, col)), np.uint8).reshape(-1, 32)


def _build(key, pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _rows32(pdf.digest)
    sizes, bits = build_mph(digests)
    at = lookup_mph(sizes, bits, digests)
    order = np.empty(len(at), np.int64)
    order[at] = np.arange(len(at))
    pack = lambda c, t: pdf[c].to_numpy(t)[order].tobytes()
    return pd.DataFrame([{
        "bucket": key[0], "n_keys": len(at), "level_bits": sizes, "bits": np.packbits(bits).tobytes(),
        "digests": digests[order].tobytes(), "ids": pack("id", "<i8"), "no_id": pack("no_id", "u1"),
        "rids": pack("rid", "<i8"), "copies": pack("copies", "<i8")}])


def _lookup(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """One verdict per distinct digest of a bucket: the winner and the group's size."""
    new = new[["digest", "id", "no_id", "rid", "copies"]]
    if index.empty:
        return new
    if len(index) != 1:
        raise ValueError("a bucket has one index row")
    ix = index.iloc[0]
    sizes = [int(x) for x in ix.level_bits]
    bits = np.unpackbits(np.frombuffer(ix.bits, np.uint8))[:sum(sizes)].astype(bool)
    held = np.frombuffer(ix.digests, np.uint8).reshape(-1, 32)
    n = len(held)
    add, outside = np.zeros(n, np.int64), new
    if len(new):
        asked = _rows32(new.digest)
        slot = lookup_mph(sizes, bits, asked)
        member = slot >= 0
        member[member] = (held[slot[member]] == asked[member]).all(axis=1)      # all bytes compared
        np.add.at(add, slot[member], new.copies.to_numpy(np.int64)[member])
        outside = new[~member]
    own = pd.DataFrame({
        "digest": [held[i].tobytes() for i in range(n)], "id": np.frombuffer(ix.ids, "<i8"),
        "no_id": np.frombuffer(ix.no_id, "u1").astype("int32"), "rid": np.frombuffer(ix.rids, "<i8"),
        "copies": np.frombuffer(ix.copies, "<i8") + add})
    return pd.concat([own, outside], ignore_index=True) if len(outside) else own


VERDICT_SCHEMA = "digest binary, id long, no_id int, rid long, copies long"


def _distinct(rows: DataFrame) -> DataFrame:
    """Partial aggregation runs before the shuffle: a hot text ships one row per task."""
    first = F.min(F.struct(F.col("doc_id").isNull().cast("int").alias("no_id"),
                           F.coalesce("doc_id", F.lit(0)).alias("id"), "rid")).alias("w")
    return rows.groupBy("digest").agg(first, F.count("*").alias("copies")).select(
        "digest", "w.id", "w.no_id", "w.rid", "copies")


def digests_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``doc_id, digest, rid`` written once; ``rid`` (or ``row_col``) tells repeated rows apart."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    return materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
                                   (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid")),
                       "digests")


def build_index(history: DataFrame, keys_per_bucket: int = BUCKET_KEYS, buckets: int | None = None) -> DataFrame:
    """Index rows of the history's distinct digests (columns of :func:`_distinct`)."""
    if buckets is None:
        buckets = max(1, -(-history.count() // keys_per_bucket))
    keyed = history.withColumn("bucket", bucket_of("digest", buckets))
    return keyed.groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA)


def bucket_of(col: str, buckets: int):
    """Bucket from the digest's first 7 bytes."""
    return F.conv(F.hex(F.substring(F.col(col), 1, 7)), 16, 10).cast("long") % buckets


def verdicts(rows: DataFrame, keys_per_bucket: int = BUCKET_KEYS) -> DataFrame:
    """Winner and size of every distinct digest of ``digests_of`` rows."""
    split = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    in_history = F.coalesce(F.col("doc_id") <= F.lit(split), F.lit(False)) if split is not None else F.lit(False)
    history = materialize(_distinct(rows.where(in_history)), "history")
    most = max(history.count(), rows.where(~in_history).count())      # the batch's rows bound its distinct digests
    buckets = max(1, -(-most // keys_per_bucket))
    index = materialize(build_index(history, buckets=buckets), "mph-index")
    new = _distinct(rows.where(~in_history)).withColumn("bucket", bucket_of("digest", buckets))
    return new.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_lookup, VERDICT_SCHEMA)


def kept_rows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``row_col`` values (column ``rid``) of the rows that stay: one per distinct text."""
    return verdicts(digests_of(docs, id_col, text_col, row_col)).select("rid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = digests_of(docs, id_col, text_col)
    best = verdicts(rows).select(F.col("digest").alias("d"), "id", "no_id", F.col("rid").alias("keep_rid"), "copies")
    return rows.join(best, rows.digest == best.d).select(
        "doc_id", F.when(F.col("no_id") == 0, F.col("id")).alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
