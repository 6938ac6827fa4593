"""Exact top-k search (1): pivot-table elimination.

Vectors are rounded to integers (``floor(scale * x)``). A few pivots, spread out by farthest-first
choice on a bounded sample, are compared with every vector once; the table of distances travels
with the vector. For a query q and a candidate v the largest ``|d(q,p) - d(v,p)|`` over the
pivots is a lower bound of their distance and so bounds their inner product from above:
``(|q|^2 + |v|^2 - bound^2) / 2``. In each cell (a block of queries against a block of vectors)
a query's candidates are evaluated in bound order until the next bound is below its k-th score;
the pivots, rows themselves, give the first k-th score. The cells' best rows are merged.

Cells have bounded size, so nothing is broadcast but the pivots (at most ``pivots`` per vector
length, chosen from ``sample`` rows).

Defined cases: null vectors, vectors with null or non-finite components and null ids take no part;
rows repeated under one id are rows of their own (each is a candidate and, if the condition holds, a
query, and only the query's own row is no candidate); vectors of different length are not compared; scores beyond the 64-bit range are saturated; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import materialize

SCALE = 256
PIVOTS = 32
SAMPLE = 2_000
QUERY_BLOCK = 1_024
VECTOR_BLOCK = 4_096
EXACT = float(1 << 53)


def _ints(blobs) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<i8") for b in blobs])


def choose_pivots(ids: np.ndarray, vecs: np.ndarray, k: int) -> np.ndarray:
    """Places of farthest-first pivots, starting at the row of largest norm."""
    x = vecs.astype(np.float64)
    norm = (x * x).sum(axis=1)
    out, far = [int(np.argmax(norm))], np.full(len(x), np.inf)
    while len(out) < min(k, len(x)):
        p = out[-1]
        far = np.minimum(far, norm + norm[p] - 2 * (x @ x[p]))
        far[out] = -1
        out.append(int(np.argmax(far)))
    return np.array(out)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a, b = x.astype(np.float64), pivots.astype(np.float64)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def inner(vecs: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products, saturated to 64 bits."""
    top = float(np.abs(vecs).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(q))
    if top < EXACT:
        return (vecs.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(v, q)) for v in vecs]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in big], np.int64)


def _table(pivots: dict[int, tuple[np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vecs = [np.asarray(v, "<i8") for v in pdf.v]
            dist = [b""] * len(vecs)
            dims = np.array([len(v) for v in vecs], np.int64)
            for dim in np.unique(dims):
                if int(dim) in pivots and dim:
                    at = np.flatnonzero(dims == dim)
                    d = distances(np.stack([vecs[i] for i in at]), pivots[int(dim)][1])
                    for i, row in zip(at, d):
                        dist[i] = row.astype("<f8").tobytes()
            yield pd.DataFrame({"vec_id": pdf.vec_id, "rid": pdf.rid, "dim": dims, "is_query": pdf.is_query,
                                "vec": [v.tobytes() for v in vecs], "dist": dist})
    return run


def search_cell(q_rows, q, dq, v_rows, v_ids, v, dv, start: np.ndarray, k: int, chunk: int = 128):
    """Best k rows of the block for every query: ``(query row, place in the block, score)`` lists."""
    norm_q, norm_v = ((x.astype(np.float64) ** 2).sum(axis=1) for x in (q, v))
    slack = 1e-9 * (1.0 + max(float(norm_q.max(initial=0)), float(norm_v.max(initial=0))))
    out_q, out_v, out_s = [], [], []
    for c in range(0, len(q), chunk):
        part = slice(c, c + chunk)
        bound = np.zeros((len(q[part]), len(v)))
        for p in range(dq.shape[1]):
            np.maximum(bound, np.abs(dq[part, p][:, None] - dv[:, p]), out=bound)
        upper = (norm_q[part][:, None] + norm_v - bound * bound) / 2 + slack
        upper *= 1 + 1e-12
        for i in range(len(upper)):
            at, me, u = c + i, q_rows[c + i], upper[i]
            cand = np.flatnonzero((u >= start[at]) & (v_rows != me))
            cand = cand[np.argsort(-u[cand], kind="stable")]
            best_s, best_v, done, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 64
            while done < len(cand):
                if len(best_s) == k and u[cand[done]] < best_s[-1]:
                    break                                          # no later bound reaches the k-th score
                take = cand[done:done + step]
                s = np.concatenate([best_s, inner(v[take], q[at])])
                d = np.concatenate([best_v, take])
                top = np.lexsort((v_rows[d], v_ids[d], -s.astype(object) if s.min() == -(1 << 63) else -s))[:k]
                best_s, best_v, done, step = s[top], d[top], done + step, step * 2
            out_q += [me] * len(best_s)
            out_v += best_v.tolist()
            out_s += best_s.tolist()
    return out_q, out_v, out_s


def _search(pivots: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({c: [] for c in FOUND}, dtype="int64")
        dim = int(key[0])
        q, v = _ints(queries.vec), _ints(rows.vec)
        dq, dv = (np.stack([np.frombuffer(b, "<f8") for b in x.dist]) for x in (queries, rows))
        q_rows, v_rows = queries.rid.to_numpy(np.int64), rows.rid.to_numpy(np.int64)
        q_ids, v_ids = queries.vec_id.to_numpy(np.int64), rows.vec_id.to_numpy(np.int64)
        start = np.full(len(q), -np.inf)
        ids, vecs = pivots.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
        for i in range(len(q)):                                  # k-th best among the pivots
            s = np.sort(inner(vecs[ids != q_rows[i]], q[i]))
            if len(s) >= k:
                start[i] = s[-k]
        a, b, c = search_cell(q_rows, q, dq, v_rows, v_ids, v, dv, start, k)
        b, id_of = np.array(b, np.int64), dict(zip(q_rows.tolist(), q_ids.tolist()))
        return pd.DataFrame({"query_row": np.array(a, np.int64), "query_id": np.array([id_of[x] for x in a], np.int64),
                             "vec_id": v_ids[b], "rid": v_rows[b], "score": np.array(c, np.int64)})
    return run


FOUND = ("query_row", "query_id", "vec_id", "rid", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, pivots: int = PIVOTS, sample: int = SAMPLE, query_block: int = QUERY_BLOCK,
          vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows by integer inner product.

    ``is_query`` is a condition on ``vec_id``.
    """
    real = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    clean = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & real)
    ints = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = clean.select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
    rows = materialize(rows.withColumn("is_query", is_query).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, n_query = rows.agg(F.count("*"), F.count_if("is_query")).first()
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    drawn = rows.orderBy(F.xxhash64("vec_id"), "rid").limit(sample).select("rid", "v").toPandas()    # bounded
    for dim, g in drawn.groupby(drawn.v.map(len)):
        ids, vecs = g.rid.to_numpy(np.int64), np.array([list(x) for x in g.v], np.int64).reshape(len(g), int(dim))
        at = choose_pivots(ids, vecs, pivots)
        held[int(dim)] = (ids[at], vecs[at])
    known = materialize(rows.mapInPandas(_table(held), "vec_id long, rid long, dim long, is_query boolean, vec binary, dist binary"),
                        "pivot-table")
    blocks, q_blocks = max(1, -(-n // vector_block)), max(1, -(-n_query // query_block))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("rid"), F.lit(count))

    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    asked = known.where("is_query").select("vec_id", "rid", "dim", "vec", "dist", block(q_blocks).alias("qb"),
                                           every(blocks).alias("vb"))
    held_rows = known.select("vec_id", "rid", "dim", "vec", "dist", every(q_blocks).alias("qb"),
                             block(blocks).alias("vb"))
    cells = asked.groupBy("dim", "qb", "vb").cogroup(held_rows.groupBy("dim", "qb", "vb"))
    found = cells.applyInPandas(_search(held, k), ", ".join(f"{c} long" for c in FOUND))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "rid"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
