"""SimHash near-dedup (5): bit-sliced comparison of 64-bit fingerprints.

Fingerprints: words of the ASCII-lower-cased text, shingles of ``shingle`` words, XXH64 (seed 42)
of each; a bit is 1 if it is set in over half the hashes. Distinct fingerprints (one row each,
whatever the number of copies) go to six buckets: of four 16-bit blocks, two fingerprints within
two bits agree on at least two, so a bucket per pair of blocks finds every link. Inside a task
the buckets' rows lie side by side, larger buckets first, and are stored as bit planes (plane b
holds bit b of 64 rows per machine word). At lag d every row is compared with the row d places
on: planes are XORed with their shifted selves and summed by carry-save counters; a block of 64
comparisons is abandoned as soon as all its counts exceed the radius. Links are reduced to stars
before they leave the task and to components by alternating star steps.

A bucket above ``bucket_rows`` distinct fingerprints takes the exact way for the rest: each
member is listed under itself and its 64 one-bit neighbours, and members of one list (at most 65)
are linked; two fingerprints within two bits always share such a list.

Defined cases: null and empty texts have fingerprint 0 and link like any other; fewer words than
a shingle hash as one sequence; repeated rows are rows of one fingerprint; a null ``doc_id`` never
becomes a component id unless all ids of the component are null; empty tables give empty results.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.llm.common import components, materialize

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCK_BITS = 16
BUCKET_ROWS = 8_192
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()      # bytes: ASCII rules only
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    begin = end - size + 1
    k = min(shingle, len(words))
    begin, end = begin[:len(words) - k + 1], end[k - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for c in range(0, len(begin), CHUNK):
        spans = zip(begin[c:c + CHUNK].tolist(), end[c:c + CHUNK].tolist())
        h = np.array([digest(line[a:b], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(begin)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = np.array([fingerprint(t, shingle, seed) for t in pdf.text], np.uint64).view(np.int64)
            yield pd.DataFrame({"rid": pdf.rid, "doc_id": pdf.doc_id, "fp": f})
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED, row_col: str | None = None) -> DataFrame:
    """``rid, doc_id, fp`` (the 64 bits as a long), written once."""
    rows = docs.select((F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    return materialize(rows.mapInPandas(_fingerprints(shingle, seed), "rid long, doc_id long, fp long"), "simhash")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Planes x words: bit i of word w of plane b is bit b of fingerprint 64 w + i."""
    n = -(-len(fps) // 64) * 64
    rows = np.zeros(n, "<u8")
    rows[:len(fps)] = fps
    bits = np.unpackbits(rows.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def within(planes: np.ndarray, lag: int, count: int, radius: int) -> np.ndarray:
    """Places i < count whose fingerprint differs from that at i + lag in ``radius`` bits or fewer.

    One saturating counter of two carry-save planes and an overflow plane serves 64 rows a word.
    """
    n_words = -(-count // 64)
    by, shift = divmod(lag, 64)
    alive = np.arange(n_words)
    c0, c1, over = (np.zeros(n_words, np.uint64) for _ in range(3))
    tail = np.uint64(count % 64)
    if tail:
        over[-1] = ~np.uint64(0) << tail
    s, back = np.uint64(shift), np.uint64(64 - shift)
    width = planes.shape[1]
    for plane in planes:
        lo = plane[np.minimum(alive + by, width - 1)]
        if shift:
            hi = np.where(alive + by + 1 < width, plane[np.minimum(alive + by + 1, width - 1)], np.uint64(0))
            lo = (lo >> s) | (hi << back)
        d = plane[alive] ^ lo
        carry = c0 & d
        c0 ^= d
        over |= c1 & carry
        c1 ^= carry
        if radius < 3:
            limit = {0: c0 | c1, 1: c1, 2: c1 & c0}[radius]
            over |= limit
        if (over == ~np.uint64(0)).any():
            keep = over != ~np.uint64(0)
            alive, c0, c1, over = alive[keep], c0[keep], c1[keep], over[keep]
            if not len(alive):
                return np.zeros(0, np.int64)
    ok = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    return (alive[:, None] * 64 + np.arange(64))[ok]


def bucket_stars(key: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(fingerprint, smallest one of its group)`` among rows of equal key."""
    order = np.lexsort((fps, key))
    key, fps = key[order], fps[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    by_size = np.argsort(-size, kind="stable")
    rows = np.concatenate([np.arange(first[g], first[g] + size[g]) for g in by_size]) if len(first) else first
    fps, sizes = fps[rows], size[by_size]
    ends = np.cumsum(sizes)
    in_group = np.repeat(np.arange(len(sizes)), sizes)
    planes = bit_planes(fps)
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for lag in range(1, int(sizes[0]) if len(sizes) else 0):
        groups = int(np.searchsorted(-sizes, -lag))            # those with more than lag rows
        if not groups:
            break
        count = max(0, int(ends[groups - 1]) - lag)
        at = within(planes, lag, count, radius)
        at = at[in_group[at] == in_group[at + lag]]
        while True:                                             # full path compression, then the open links
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        at = at[parent[at] != parent[at + lag]]
        for i in at.tolist():
            a, b = root(i), root(i + lag)
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(fps))], np.int64)
    linked = roots != np.arange(len(fps))
    return fps[linked], fps[roots[linked]]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None                        # the last bucket may go on in the next batch
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            cut = (pdf.key != pdf.key.iloc[-1]) | (pdf.part != pdf.part.iloc[-1]) if len(pdf) else None
            held, ready = (pdf[~cut], pdf[cut]) if cut is not None else (None, pdf)
            yield from stars(ready)
        if held is not None:
            yield from stars(held)

    def stars(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, one in pdf.groupby("part", sort=False):
            a, b = bucket_stars(one.key.to_numpy(np.int64), one.fp.to_numpy(np.int64).view(np.uint64), radius)
            if len(a):
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    return run


def links(fps: DataFrame, radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Star links ``a, b`` of distinct fingerprints (column ``fp``) within ``radius`` (0 to 2) bits."""
    if not 0 <= radius <= 2:
        raise ValueError("two of four blocks agree only up to a radius of 2")
    mask = (1 << BLOCK_BITS) - 1
    block = [F.shiftrightunsigned("fp", i * BLOCK_BITS).bitwiseAND(F.lit(mask)) for i in range(4)]
    pairs = list(combinations(range(4), 2))
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), F.shiftleft(block[i], BLOCK_BITS).bitwiseOR(block[j]).alias("key"))
        for k, (i, j) in enumerate(pairs)])).alias("s")).select("fp", "s.part", "s.key")
    keyed = materialize(keyed, "buckets")
    sizes = keyed.groupBy("part", "key").agg(F.count("*").alias("rows")).where("rows > 1").select(
        F.col("part").alias("p"), F.col("key").alias("k"), "rows")
    sized = keyed.join(sizes, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k"))).select(
        "part", "key", "fp", "rows")
    small = sized.where(F.col("rows") <= bucket_rows).drop("rows").repartition("part", "key").sortWithinPartitions("part", "key")
    found = small.mapInPandas(_compare(radius), "a long, b long")
    near = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
    rest = sized.where(F.col("rows") > bucket_rows).select("fp").distinct().select("fp", F.explode(F.array(*near)).alias("via"))
    if radius == 2:
        low = rest.groupBy("via").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
        more = rest.join(low, "via").where("fp <> b").select(F.col("fp").alias("a"), "b")
    else:      # one bit: a neighbour that is itself a member; zero bits: none among distinct rows
        member = rest.where("fp = via").select(F.col("fp").alias("b"))
        more = rest.join(member, F.col("via") == F.col("b")).where("fp <> b").select(F.col("fp").alias("a"), "b")
        more = more if radius == 1 else more.limit(0)
    return found.unionByName(more)


def groups(prints: DataFrame, radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fp, component_id, keep_rid`` per distinct fingerprint of ``fingerprints`` rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("w")
    distinct = materialize(prints.groupBy("fp").agg(first), "distinct-prints")
    hung = components(links(distinct.select("fp"), radius, bucket_rows), "a", "b")
    rooted = distinct.join(hung, F.col("fp") == F.col("node"), "left").select(
        "fp", "w", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("w").alias("best")).select(F.col("root").alias("r"), "best")
    return rooted.join(best, F.col("root") == F.col("r")).select(
        "fp", F.col("best.doc_id").alias("component_id"), F.col("best.rid").alias("keep_rid"))


def kept_rows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
              radius: int = MAX_BITS) -> DataFrame:
    """The ``row_col`` values (column ``rid``) of the rows that stay: one per component."""
    prints = fingerprints(docs, id_col, text_col, shingle, row_col=row_col)
    return groups(prints, radius).select(F.col("keep_rid").alias("rid")).distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` and whether it is kept."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    best = groups(prints, radius, bucket_rows).withColumnRenamed("fp", "f")
    return prints.join(best, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("rid") == F.col("keep_rid")).alias("kept"))
