"""Mixing sources to target weights (10): pivotal dependent rounding.

Every document of a source starts with the fractional copy count ``target / source size``. Its
whole part is taken at once; the rest is a probability that is rounded by pivots: two documents
exchange probability, weighted by their sizes so that the source's expected words stay fixed,
until one of the two is 0 or 1, and the other goes on. Each (source, salt) group of bounded size
does this on its own and leaves at most one open document; a reduction tree of fixed fan-in
combines these residuals until one per source remains, which is rounded by its probability. A
source's taken words therefore miss its target by less than one document.

Targets: weights repeat over the sources in code-point order (null last); the wanted total is
shared by weight, a source stops at ``max_copies`` times its size, and the excess is shared again
among the others until none is above.

Defined cases: null text has size 0 and is taken 0 words; null sources form one source; repeated
rows are rows of their own; with nothing to share every target is 0; an empty table gives an
empty result. Draws depend on ``doc_id``, size and place only, so reruns agree.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import WORD, materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2.0
GROUP_DOCS = 20_000      # documents that one task pairs up at a time, on average
FAN_IN = 64
SEED = 20_24


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_copies: float = MAX_COPIES) -> DataFrame:
    """``source, n_docs, source_size, target`` of ``(source, size)`` rows."""
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    # rank in code-point order without one global sort task: ranges, a rank inside each, offsets
    ranged = materialize(per.withColumn("last", F.col("source").isNull().cast("int"))
                         .repartitionByRange("last", "source").withColumn("part", F.spark_partition_id()), "sources")
    before, offsets = 0, {}
    for part, n in sorted(map(tuple, ranged.groupBy("part").count().collect())):    # one row per range
        offsets[part] = before
        before += n
    if not offsets:
        return ranged.select("source", "n_docs", "source_size", F.lit(0.0).alias("target"))
    start = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), F.col("part"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1 + start
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = materialize(ranged.select("source", "n_docs", "source_size", weight.alias("weight"),
                                       (F.lit(max_copies) * F.col("source_size")).alias("cap")), "weights")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:       # the sources at their cap only grow; each round is one aggregate
        is_full = F.col("cap") < F.col("weight") * level
        n, capped, open_weight = ranked.agg(
            F.count_if(is_full), F.sum(F.when(is_full, F.col("cap"))), F.sum(F.when(~is_full, F.col("weight")))).first()
        if n == full or not open_weight:
            break
        level, full = max(0.0, total - (capped or 0.0)) / open_weight, n
    return ranked.select("source", "n_docs", "source_size",
                         F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def _draws(doc_ids, sizes, seed: int) -> np.ndarray:
    """Uniform numbers that depend on the rows alone; repeats of a row get further draws."""
    seen: dict[bytes, int] = {}
    out = np.empty(len(doc_ids))
    for i, (d, s) in enumerate(zip(doc_ids, sizes)):
        row = f"{d}|{s}".encode()
        seen[row] = k = seen.get(row, -1) + 1
        out[i] = xxhash.xxh64_intdigest(row + b"|%d" % k, seed) / 2.0**64
    return out


def pivotal(sizes: np.ndarray, p: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds ``p`` pair by pair in the given order; the second value is the place left open, or -1.

    A step moves ``t`` words between the two documents: one probability rises by ``t / size``,
    the other falls by it, so ``sum(size * p)`` stays and each ``p`` keeps its expectation.
    """
    p, held = p.astype(float).copy(), -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, x, y = float(sizes[held]), float(sizes[i]), p[held], p[i]
        up, down = min((1 - x) * a, y * b), min(x * a, (1 - y) * b)
        if draws[i] * (up + down) < down:      # the first rises
            x, y = (1.0, y - up / b) if (1 - x) * a <= y * b else (x + up / a, 0.0)
        else:
            x, y = (0.0, y + down / b) if x * a <= (1 - y) * b else (x - down / a, 1.0)
        x, y = (0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x), (0.0 if y < 1e-12 else 1.0 if y > 1 - 1e-12 else y)
        p[held], p[i] = x, y
        held = held if 0.0 < x < 1.0 else i if 0.0 < y < 1.0 else -1
    return p, held


STATE = "source_key long, salt long, rid long, doc_id long, size long, p double, taken_p double, open boolean"


def _round(last: bool, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_nil=pdf.doc_id.isna()).sort_values(["_nil", "doc_id", "size", "rid"]).drop(columns="_nil")
        draws = _draws(pdf.doc_id, pdf["size"], seed)
        p, held = pivotal(pdf["size"].to_numpy(), pdf.p.to_numpy(), draws)
        is_open = np.zeros(len(p), bool)
        if held >= 0 and last:
            p[held] = float(xxhash.xxh64_intdigest(b"last|%d" % int(pdf["size"].iloc[held]), seed) / 2.0**64 < p[held])
        elif held >= 0:
            is_open[held] = True
        return pdf.assign(p=p, taken_p=np.where(is_open, np.nan, p), open=is_open)
    return run


def sizes_of(docs: DataFrame, text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``rid, doc_id, source, size``; the caller writes the rows before :func:`mix` reads them."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select((F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), size.alias("size"))


def mix(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES,
        group_docs: int = GROUP_DOCS, seed: int = SEED) -> DataFrame:
    """``rid, doc_id, size, source_size, target, copies, taken`` for written ``sizes_of`` rows."""
    per = materialize(source_targets(sized, weights, share, max_copies)
                      .withColumn("source_key", F.monotonically_increasing_id()), "targets")
    salts = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / group_docs)).cast("long")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "rid", "doc_id", "size", "source_size", "target", "source_key",
        F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("rid")).otherwise(F.xxhash64("doc_id", "size")), salts).alias("salt"),
        F.floor(ratio).cast("long").alias("base"), (ratio - F.floor(ratio)).alias("p0"))
    todo = materialize(joined, "fractions")
    whole = (F.col("size") == 0) | (F.col("p0") == 0.0)
    rows = todo.where(~whole).select("source_key", "salt", "rid", "doc_id", "size", F.col("p0").alias("p"),
                                     F.lit(float("nan")).alias("taken_p"), F.lit(True).alias("open"))
    groups = max(1, -(-(per.agg(F.max("n_docs")).first()[0] or 0) // group_docs))
    done = todo.where(whole).select("rid", F.lit(0).cast("long").alias("extra"))
    while True:       # the tree: group_docs rows at the leaves, FAN_IN residuals at each inner node
        step = materialize(rows.groupBy("source_key", "salt").applyInPandas(_round(groups <= 1, seed), STATE), "pivots")
        done = done.unionByName(step.where("not open").select("rid", F.round("taken_p").cast("long").alias("extra")))
        if groups <= 1:
            break
        groups = -(-groups // FAN_IN)
        rows = step.where("open").withColumn("salt", F.floor(F.col("salt") / FAN_IN))
    copies = F.col("base") + F.col("extra")
    return todo.join(done.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r")).select(
        "rid", "doc_id", "size", "source_size", "target", F.when(F.col("size") == 0, F.lit(0).cast("long"))
        .otherwise(copies).alias("copies"), (F.col("size") * copies).alias("taken"))


def copies_of(docs: DataFrame, row_col: str, text_col: str = "text", **options) -> DataFrame:
    """``rid`` (the ``row_col`` value) and ``copies`` of every row the mix takes at least once."""
    sized = materialize(sizes_of(docs, text_col, row_col), "sizes")
    return mix(sized, **options).where("copies > 0").select("rid", "copies")


def mix_sources(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """One row per document with its target and the words the mix takes of it."""
    return mix(materialize(sizes_of(docs, text_col), "sizes"), **options).drop("rid", "copies")
