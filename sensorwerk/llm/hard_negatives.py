"""Hard-negative mining (11): Fagin's threshold algorithm over per-dimension sorted lists.

Vectors are rounded to integers (``floor(scale * x)``). The rows are dealt into blocks of bounded
size by a hash of their row number (a label that holds a third of all rows is spread like any
other); every block sorts its rows once per dimension. For an anchor, each list is walked from the
end that its sign calls for (largest values first where the anchor's component is positive, smallest
first where it is negative; components of zero add nothing and are not walked). A row met for the
first time in any list is scored by random access with an exact integer inner product. After a step
down all lists the threshold, the anchor's product with the values just passed, bounds every row not
met so far, and the walk ends once it lies strictly below each window's k-th score (or below the
window's lower limit): strictly, because a tie may still go to a smaller id.

Two searches run this way: the anchor's best rows of its own label (positives; one open window), and
for each of them the best rows of other labels whose score lies in ``[low %, high %]`` of the
positive's (negatives). Each (anchor block, row block) cell keeps k rows a window, which are merged.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite component
take no part; an empty table gives an empty result; of rows repeated under one id each is a row of
its own (candidate and, if the condition holds, anchor), and only the anchor's own row is no
candidate; ties go to the smaller id, then to the row read first; vectors of different length are not
compared; vectors without components score 0; scores beyond 64 bits are saturated before windows are
formed; a positive with a negative score has an empty window; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import materialize

SCALE = 256
ANCHOR_BLOCK = 512
ROW_BLOCK = 16_384
FIRST_STEP = 64           # entries read from every list before the first look at the threshold
TOGETHER = 32             # anchors whose thresholds are computed in one product
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Lists:
    """A block's rows with one sorted list per dimension, for exact scores and thresholds."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, rids: np.ndarray):
        self.rows, self.ids, self.rids = rows, ids, rids
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32).T.copy()     # a list a dimension
        self.values = np.take_along_axis(rows, self.order.T, axis=0).T.copy()
        self.top = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
        self.plain = rows.astype(np.float64), self.values.astype(np.float64)

    def product(self, left: np.ndarray, right: np.ndarray, exact: bool) -> np.ndarray:
        """Exact ``left @ right`` in 64 bits, saturated (doubles hold every partial sum where ``exact``)."""
        if exact:
            return (left @ right.astype(np.float64)).astype(np.int64)
        sums = left.astype(object) @ right.astype(object) if right.size else np.zeros(len(left), object)
        return np.array([max(LEAST, min(MOST, int(s))) for s in sums], np.int64)

    def limits(self, anchors: np.ndarray) -> np.ndarray:
        """The threshold of each anchor (row) after each depth: its product with the values passed there."""
        size = float(np.abs(anchors).max(initial=0)) * float(self.top) * max(1, anchors.shape[1])
        if size < EXACT:
            up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
            return (up @ self.plain[1][:, ::-1] + down @ self.plain[1]).astype(np.int64)
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        both = np.concatenate([self.values[:, ::-1], self.values]).T
        return np.stack([self.product(both, np.concatenate([x, y]), False) for x, y in zip(up, down)])

    def best(self, anchor: np.ndarray, fits: np.ndarray, windows: list[tuple[int, int]], k: int, limit: np.ndarray | None = None):
        """The k best fitting rows of each window ``(lowest, highest score)`` and the depth reached.

        Returns, per window, ``(scores, places)`` by score descending, then id, then row number.
        """
        n = len(self.rows)
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        if not n or not windows:
            return held, 0
        limit = self.limits(anchor[None, :])[0] if limit is None else limit
        exact = float(np.abs(anchor).max(initial=0)) * float(self.top) * max(1, len(anchor)) < EXACT
        rows = self.plain[0] if exact else self.rows
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        walked = len(up) + len(down) > 0                             # else every row scores 0
        left, depth, step = fits.copy(), 0, FIRST_STEP
        while depth < n:
            upto = min(n, depth + step)
            found = np.zeros(n, bool)
            if walked:
                found[self.order[up, n - upto:n - depth]] = True     # largest values first
                found[self.order[down, depth:upto]] = True
            else:
                found[depth:upto] = True
            new = np.flatnonzero(found & left)
            left[new] = False
            score = self.product(rows[new], anchor, exact)
            for w, (lowest, highest) in enumerate(windows):
                s, at = held[w]
                inside = (score >= (lowest if len(s) < k else max(lowest, int(s[-1])))) & (score <= highest)
                if inside.any():
                    s, at = np.concatenate([s, score[inside]]), np.concatenate([at, new[inside]])
                    if len(s) > 8 * k:                               # only those that can be among the first k
                        near = s >= np.partition(s, len(s) - k)[len(s) - k]
                        s, at = s[near], at[near]
                    first = np.lexsort((self.rids[at], self.ids[at], ~s))[:k]       # ~s falls as s rises
                    held[w] = s[first], at[first]
            depth, step = upto, step * 2
            ends = int(limit[depth - 1])
            if all(ends < lowest or (len(s) == k and ends < s[-1]) for (lowest, _), (s, _) in zip(windows, held)):
                break
        return held, depth


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with ``low * score <= 100 * s <= high * score``."""
    return max(LEAST, -((-low * score) // 100)), min(MOST, (high * score) // 100)


def _stack(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), dim)


def _cell(k: int, low: int | None, high: int | None):
    """Search of one cell; without limits the anchors' positives, else their windows' negatives."""
    def run(key, anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c: [] for c in ("anchor_rid", "place", "vec_id", "rid", "score")}
        if len(anchors) and len(rows):
            dim = int(key[0])
            ids, rids, labels = (rows[c].to_numpy(np.int64) for c in ("vec_id", "rid", "label"))
            block = Lists(_stack(rows.vec, dim), ids, rids)
            asked = _stack(anchors.vec, dim)
            for i, anchor in enumerate(asked):
                if i % TOGETHER == 0:
                    limits = block.limits(asked[i:i + TOGETHER])
                rid, label = int(anchors.rid.iat[i]), int(anchors.label.iat[i])
                if low is None:
                    fits, windows = (labels == label) & (rids != rid), [(LEAST, MOST)]
                else:
                    fits, windows = labels != label, [window_of(int(s), low, high) for s in anchors.scores.iat[i]]
                for place, (score, at) in enumerate(block.best(anchor, fits, windows, k, limits[i % TOGETHER])[0]):
                    out["anchor_rid"] += [rid] * len(at)
                    out["place"] += [place] * len(at)
                    out["vec_id"] += ids[at].tolist()
                    out["rid"] += rids[at].tolist()
                    out["score"] += score.tolist()
        return pd.DataFrame(out, dtype="int64")
    return run


def _as_blobs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["dim"] = pdf.vec.map(len).astype("int64")
        pdf["vec"] = [np.asarray(v, "<i8").tobytes() for v in pdf.vec]
        yield pdf


FOUND = "anchor_rid long, place long, vec_id long, rid long, score long"


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
         anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``is_anchor`` is a condition and ``label`` an expression over the table's columns. Returns
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    real = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & real).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), ints.alias("vec")).where("label IS NOT NULL")
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()).mapInPandas(
        _as_blobs, "vec_id long, label long, is_anchor boolean, vec binary, rid long, dim long"), "mining-rows")
    n, n_anchor = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    row_blocks, anchor_blocks = max(1, -(-n // row_block)), max(1, -(-n_anchor // anchor_block))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("rid"), F.lit(count))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    anchors = rows.where("is_anchor").select(*[F.col(c).alias(c) for c in ("rid", "label", "dim", "vec")],    # own names for the cogroup
                                             block(anchor_blocks).alias("ab"))
    held = rows.select("rid", "vec_id", "label", "dim", "vec", block(row_blocks).alias("rb"), every(anchor_blocks).alias("ab"))

    def search(asked: DataFrame, k: int, low: int | None = None, high: int | None = None) -> DataFrame:
        cells = asked.withColumn("rb", every(row_blocks)).groupBy("dim", "ab", "rb").cogroup(held.groupBy("dim", "ab", "rb"))
        found = cells.applyInPandas(_cell(k, low, high), FOUND)
        order = Window.partitionBy("anchor_rid", "place").orderBy(F.desc("score"), "vec_id", "rid")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    own = rows.where("is_anchor").select(F.col("rid").alias("anchor_rid"), F.col("vec_id").alias("anchor_id"))
    pos = materialize(search(anchors, positives).join(own, "anchor_rid").select(
        "anchor_rid", "anchor_id", (F.col("rank") - 1).cast("long").alias("place"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = pos.groupBy(F.col("anchor_rid").alias("rid")).agg(                 # at most ``positives`` a row
        F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))),
                    lambda x: x["positive_score"]).alias("scores"))
    neg = search(anchors.join(scores, "rid"), negatives, low, high)
    return neg.select("anchor_rid", "place", "rank", F.col("vec_id").alias("negative_id"),
                      F.col("score").alias("negative_score")).join(pos, ["anchor_rid", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
