"""Best-fit packing (8): configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits a sequence. The linear program (as few
configurations as cover the histogram) is solved by multiplicative weights: every length has a
weight, the dearest configurations under these weights come from a knapsack dynamic program over
the capacity, and the lengths they cover become cheaper, until the whole histogram is covered within
a gap of a lower bound. The fractional counts are rounded down, and what rounding leaves is packed
best-fit decreasing on the histogram, together with the pieces of sequences that are opened again for it. Only the histogram (at most
``capacity`` rows) and the plan in run-length form reach the driver; the pieces are numbered per
length and matched to the plan's ranges by Spark.

Defined cases: null and empty texts give one piece holding the end id; a document longer than the
capacity is cut into full pieces, the last may be shorter; repeated rows are packed each; an
empty table gives an empty result; columns other than id and text are not read.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorwerk.llm.common import materialize
from sensorwerk.llm.tokens import encoder, in_slices

CAPACITY = 2048
CACHE_WORDS = 300_000    # words in each cache generation of the encoder; the pipeline's executors hold other stages' rows besides
SLICE_CHARS = 1 << 22    # characters encoded at once, for the same reason
GAP = 0.002              # the linear program is solved to this share of its lower bound
ROUNDS = 700             # no new run of the prices begins after so many rounds and half a round a length
STEP = 0.5               # learning rate of the weights
FLOOR = 0.5              # starting prices are at least this share of those by length
MISSES = 20              # a round ends after so many configurations that share a length or are too cheap
SLACK = 0.005            # configurations this near to the dearest run in the same round
OPEN = ((0.01, 0.0), (0.0, 0.0), (0.0, 1 / 32))     # sequences that stay: free share at most, smallest piece at least
SALT_ROWS = 50_000       # pieces of one length that one task numbers, on average


class Knapsack:
    """Dynamic program over the capacity: ``value[c]`` is the most weight that fits in ``c``."""

    def __init__(self, lengths: np.ndarray, weights: np.ndarray, left: np.ndarray, capacity: int):
        self.lengths, self.left, self.capacity = lengths, left, capacity
        gain, index = np.full(capacity + 1, -np.inf), np.full(capacity + 1, -1, np.int64)
        use = np.flatnonzero((weights > 0) & (left > 0))
        gain[lengths[use]], index[lengths[use]] = weights[use], use
        back, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)      # back[capacity - c] is value[c]
        for c in range(1, capacity + 1):
            before = back[capacity - c + 1]
            got = back[capacity - c + 1:] + gain[1:c + 1]
            k = int(got.argmax())
            if got[k] > before:
                before, pick[c] = got[k], index[k + 1]
            back[capacity - c] = before
        self.value, self.pick = back[::-1], pick.tolist()

    def configuration(self, first: int | None = None) -> dict[int, int]:
        """The dearest configuration (with one of length ``first`` in it). ``left`` bounds a length's
        copies to its pieces; room that scarce lengths leave goes to the longest that fit."""
        lengths, left = self.lengths, self.left
        out: dict[int, int] = defaultdict(int)
        c = self.capacity
        if first is not None:
            out[first] = 1
            c -= int(lengths[first])
        while c > 0:
            i = self.pick[c]
            if i < 0:
                c -= 1
                continue
            out[i] += 1
            c -= int(lengths[i])
        out = {i: min(n, int(left[i])) for i, n in out.items()}
        room = self.capacity - sum(n * int(lengths[i]) for i, n in out.items())
        for i in np.flatnonzero((lengths <= room) & (left > 0))[::-1].tolist() if room else ():
            n = min(room // int(lengths[i]), int(left[i]) - out.get(i, 0))
            if n > 0:
                out[i] = out.get(i, 0) + n
                room -= n * int(lengths[i])
        return out


def best_configuration(lengths: np.ndarray, weights: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """The most weight in one sequence, as ``{index of length: copies}``."""
    return Knapsack(lengths, weights, left, capacity).configuration()


def cover(lengths: np.ndarray, counts: np.ndarray, capacity: int, prices: np.ndarray,
          share: float) -> tuple[dict[tuple, float], np.ndarray, int]:
    """One run of multiplicative weights until the whole histogram is covered: configurations with
    their fractional counts, the average prices and the number of rounds.

    A round prices the knapsack once and runs the dearest configurations that share no length, each
    for at most ``share`` of its scarcest length (one sequence at least). A length that is ahead of the covered volume
    becomes cheaper, one that lags dearer: ``exp(-STEP / share * (covered part - volume's part))``.
    """
    found: dict[tuple, float] = defaultdict(float)
    covered, mean, total, rounds = np.zeros(len(lengths)), np.zeros(len(lengths)), 0.0, 0
    volume = float((lengths * counts).sum())
    while True:
        open_ = counts - covered
        open_[open_ <= 1e-9 * counts] = 0.0
        left = np.ceil(open_).astype(np.int64)
        if not left.any():
            return found, mean / max(total, 1e-300), rounds
        rounds += 1
        ahead = covered / counts - float((lengths * covered).sum()) / volume
        weights = prices * np.exp(np.clip(-STEP / share * ahead, -30, 30))
        sack = Knapsack(lengths, weights, left, capacity)
        at_most = sack.value[capacity]
        holds = np.where(left > 0, weights + sack.value[capacity - lengths], 0.0)
        near = np.flatnonzero(holds >= (1 - SLACK) * at_most)
        taken, ran, misses = np.zeros(len(lengths), bool), 0.0, 0
        for i in [None, *near[np.argsort(ahead[near], kind="stable")].tolist()]:
            if i is not None and taken[i]:
                continue
            conf = sack.configuration(i)
            at = np.fromiter(conf, np.int64)
            n = np.fromiter(conf.values(), np.float64)
            if i is not None and (taken[at].any() or float(weights[at] @ n) < (1 - SLACK) * at_most):
                misses += 1
                if misses == MISSES:
                    break
                continue
            times = min(float((open_[at] / n).min()), max(1.0, share * float((counts[at] / n).min())))
            found[tuple(sorted(conf.items()))] += times
            covered[at] += times * n
            taken[at] = True
            ran += times
        mean += ran * weights / at_most
        total += ran


def solve_lp(lengths: np.ndarray, counts: np.ndarray, capacity: int,
             gap: float = GAP) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Fractional counts of configurations that cover all of ``counts``, and a lower bound of the
    linear program's value: prices under which no configuration is worth more than 1.

    Starts from the best prices of the dual feasible functions (1 above ``capacity - a``, 0 below
    ``a``, else proportional to length; ``a`` = 0 is the volume bound). Runs follow with the average
    prices of the run before and smaller shares until the cover is within ``gap`` (or a whole sequence)
    of the bound or the rounds (``ROUNDS`` and half a round a length) are used up.
    """
    volume, bound = lengths / capacity, 0.0
    prices = volume
    for a in range(capacity // 2 + 1):
        dual = np.where(lengths > capacity - a, 1.0, np.where(lengths < a, 0.0, volume))
        if float(counts @ dual) > bound:
            bound, prices = float(counts @ dual), dual
    prices, share, spent = np.maximum(prices, FLOOR * volume), 0.25, 0
    best, least = {}, np.inf
    while len(lengths):
        found, prices, rounds = cover(lengths, counts, capacity, prices, share)
        made = sum(found.values())
        if made < least:
            best, least = found, made
        top = Knapsack(lengths, prices, counts, capacity).value[capacity]
        bound = max(bound, float(counts @ prices) / top)
        spent += rounds
        if least <= max((1 + gap) * bound, np.ceil(bound)) or spent >= ROUNDS + len(lengths) // 2:
            break
        share = max(share / 2, 1 / 64)
    return [(dict(k), x) for k, x in best.items()], bound


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing on a histogram, equal steps taken many at a time."""
    left = counts.astype(np.int64).copy()
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)      # free room -> bins
    for i in np.argsort(-lengths, kind="stable"):
        size, n = int(lengths[i]), int(left[i])
        for room in sorted((r for r in open_bins if r >= size), reverse=False):
            if not n:
                break
            per = room // size
            still = []
            for conf, times in open_bins.pop(room):
                full = min(times, n // per)
                if full:
                    open_bins[room - per * size].append((conf | {int(i): conf.get(int(i), 0) + per}, full))
                    n, times = n - full * per, times - full
                if n and times:                                   # one bin takes the few that are left
                    open_bins[room - n * size].append((conf | {int(i): conf.get(int(i), 0) + n}, 1))
                    n, times = 0, times - 1
                if times:
                    still.append((conf, times))
            open_bins[room] += still
        per = capacity // size
        if n // per:
            open_bins[capacity - per * size].append(({int(i): per}, n // per))
        if n % per:
            open_bins[capacity - (n % per) * size].append(({int(i): n % per}, 1))
    return [b for bins in open_bins.values() for b in bins]


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole counts that use up the histogram exactly.

    What rounding leaves cannot fill sequences well alone, so some of the rounded ones are opened again
    for it: those with room to spare, and of the full ones those with pieces so small that they fill
    gaps elsewhere. Of the choices (open none, open by ``OPEN``) that keep a part of the linear program's
    sequences, the one with the fewest sequences stands, the one that opens least first.
    """
    whole, chosen = counts.astype(np.int64).copy(), []
    found, _ = solve_lp(lengths, counts.astype(float), capacity)
    for conf, x in found:
        times = min([int(x + 1e-9), *(int(whole[i] // n) for i, n in conf.items())])
        if times > 0:
            chosen.append((conf, times))
            for i, n in conf.items():
                whole[i] -= times * n
    best: list = []
    fewest = None
    for room, small in ((capacity, 0), *((int(r * capacity), int(s * capacity)) for r, s in OPEN)):
        kept, left = [], whole.copy()
        for conf, times in chosen:
            free = capacity - sum(n * int(lengths[i]) for i, n in conf.items())
            if free <= room and min(int(lengths[i]) for i in conf) >= small:
                kept.append((conf, times))
                continue
            for i, n in conf.items():
                left[i] += times * n
        made = kept + [c for c in best_fit(lengths, left, capacity) if c[0]]
        size = sum(times for _, times in made)
        if fewest is None or kept and size < fewest:
            best, fewest = made, size
    return best


def plan_ranges(lengths: np.ndarray, confs: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """The plan as ranges of piece numbers per length: number ``first + k`` (k < places) goes to
    sequence ``sequence + k // copies`` at ``offset + (k % copies) * length``."""
    taken = np.zeros(len(lengths), np.int64)
    rows, sequence = [], 0
    for conf, times in confs:
        offset = 0
        for i in sorted(conf, key=lambda j: -lengths[j]):
            n = conf[i]
            rows.append((int(lengths[i]), int(taken[i]), int(taken[i] + n * times), sequence, n, offset))
            taken[i] += n * times
            offset += n * int(lengths[i])
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "stop", "sequence", "copies", "offset"])


def _pieces(path: str, keeps_space: bool, end_id: int, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, keeps_space, CACHE_WORDS)
        for pdf in batches:
            rows = []
            rids, docs = pdf.rid.tolist(), [None if pd.isna(d) else int(d) for d in pdf.doc_id]
            for first, texts in in_slices(pdf.text, SLICE_CHARS):
                for k, got in enumerate(enc.encode(texts)):
                    ids = np.append(np.frombuffer(got, enc.dtype).astype("<u4"), np.array([end_id], "<u4"))
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s:s + capacity]
                        rows.append((rids[first + k], docs[first + k], p, s, len(part), zlib.crc32(part.tobytes())))
                pa.default_memory_pool().release_unused()          # Arrow keeps what a slice took otherwise
            out = pd.DataFrame(rows, columns=["rid", "doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
    return run


def pieces_of(docs: DataFrame, path: str, keeps_space: bool = False, end_id: int = 0, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document (``rid`` tells repeated rows apart), written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    schema = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return materialize(rows.mapInPandas(_pieces(path, keeps_space, end_id, capacity), schema), "pieces")


def _place(ranges: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            number, length = pdf.number.to_numpy(np.int64), pdf.length.to_numpy(np.int64)
            seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                r = ranges[int(size)]
                hit = r[np.searchsorted(r[:, 0], number[at], side="right") - 1]
                k = number[at] - hit[:, 0]
                seq[at] = hit[:, 1] + k // hit[:, 2]
                off[at] = hit[:, 3] + (k % hit[:, 2]) * size
            yield pdf.drop(columns=["number"]).assign(sequence_id=seq, offset=off)
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``rid, piece, length``."""
    hist = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}       # <= capacity rows
    if any(not 0 < n <= capacity for n in hist):
        raise ValueError("a piece is longer than the capacity or empty")
    lengths = np.array(sorted(hist), np.int64)
    counts = np.array([hist[int(n)] for n in lengths], np.int64)
    table = plan_ranges(lengths, plan(lengths, counts, capacity))
    ranges = {int(n): g.sort_values("first")[["first", "sequence", "copies", "offset"]].to_numpy(np.int64)
              for n, g in table.groupby("length")}
    # numbers per length: a row number inside (length, salt), after the counts of the salts before
    salts = max(1, -(-int(counts.max() if len(counts) else 0) // salt_rows))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("rid", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").count()
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("length").alias("l"), F.col("salt").alias("s"),
                          F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("rid", "piece")) - 1
    numbered = salted.withColumn("inside", inside).join(
        before, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s"))).withColumn(
        "number", F.col("inside") + F.col("before")).select(*pieces.columns, "number")
    schema = StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return numbered.mapInPandas(_place(ranges), schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces_of(docs, path, capacity=capacity, **options), capacity).drop("rid")
