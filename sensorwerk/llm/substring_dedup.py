"""Substring dedup (3): prefix-partitioned suffix trees.

A window of ``WINDOW`` words is the prefix of a suffix of its document. Suffixes are split by
prefixes: each window holds ``REACH`` sub-sequences of ``ANCHOR`` words and is filed under the one
of smallest hash, its anchor, so equal windows meet under equal anchors while only one position in
about ``REACH / 2`` is shuffled. Anchors that only one document has are dropped. The others' text
around the anchor (its context: every window that holds the anchor) is fetched once per distinct
context and the suffixes of one prefix form one subtree; subtrees are batched to the memory of a
task. Each is built as a suffix array by prefix doubling; the nodes at depth ``WINDOW`` or more are
the repeats, and each keeps the smallest document of its leaves. A prefix with more than
``subtree_rows`` contexts is extended to the window's whole length, where a node is one group and
needs an aggregate only, so no prefix can outgrow a task. A prefix with a single context is a
single edge and needs no text.

Words and windows are compared by 64-bit hashes, windows always together with their anchor's.

Defined cases: null and empty texts have no words; documents below ``WINDOW`` words lose none; a
null ``doc_id`` ranks after all others; rows of one id never remove each other's words; windows are
judged on the input; repeated rows get the same result each; an empty table gives an empty one.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.llm.common import discard, materialize

WINDOW = 50
ANCHOR = 17
REACH = WINDOW - ANCHOR + 1           # places of an anchor in a window
SUBTREE_ROWS = 512                    # contexts of one subtree
BATCH_ROWS = 8_192                    # contexts whose subtrees are built at a time
LAST = (1 << 63) - 1                  # rank of a null doc_id
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, b in enumerate((BASE, BASE_INV)):
            _POWERS[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, b, np.uint64))])
    return _POWERS[0][:n], _POWERS[1][:n]


class Rolling:
    """Hashes of any span of a word sequence."""

    def __init__(self, words: np.ndarray):
        up, self.down = _powers(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[:-1])])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()          # bytes part at ASCII white space only


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every run of ``width`` by doubling."""
    have, cur = 1, x
    while 2 * have <= width:
        cur = op(cur[:-have], cur[have:])
        have *= 2
    return op(cur[:len(cur) - (width - have)], cur[width - have:]) if width > have else cur


def anchors(roll: Rolling, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the sub-sequences that are the smallest of some window."""
    at = np.arange(n - ANCHOR + 1)
    gram = mixed(roll.spans(at, at + ANCHOR))
    least = _slide(gram, REACH, np.minimum)
    pad = np.zeros(REACH - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), REACH, np.maximum)
    place = np.flatnonzero(most == gram)
    return place, gram[place]


def context(roll: Rolling, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of the words that the windows around an anchor can hold."""
    begin, end = np.maximum(place - (REACH - 1), 0), np.minimum(place + WINDOW, n)
    shape = ((place - begin) * 64 + (end - place)).astype(np.uint64)
    return begin, end, mixed(roll.spans(begin, end) + mixed(shape))


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        parts = []
        for rank, th, text in zip(pdf.rank_id.tolist(), pdf.th.tolist(), pdf.text):
            words = split_words(text)
            if len(words) < WINDOW:
                continue
            roll = Rolling(hashes(words))
            place, gram = anchors(roll, len(words))
            parts.append(pd.DataFrame({"h": gram.view(np.int64), "ctx": context(roll, place, len(words))[2].view(np.int64),
                                       "rank_id": rank, "th": th, "p": place.astype(np.int32)}))
        if parts:
            yield pd.concat(parts, ignore_index=True)


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of the asked contexts; for wide prefixes the hashes of their windows instead."""
    for pdf in batches:
        rows = []
        for text, asked in zip(pdf.text, pdf.asked):
            words = hashes(split_words(text))
            n = len(words)
            roll = Rolling(words)
            for a in asked:
                p = a["p"]
                begin, end = max(p - REACH + 1, 0), min(p + WINDOW, n)
                if not a["wide"]:
                    rows.append((a["h"], a["ctx"], a["lo"], -1, 0, p - begin, words[begin:end].tobytes()))
                    continue
                s = np.arange(begin, end - WINDOW + 1)
                for o, w in zip((s - (p - REACH + 1)).tolist(), roll.spans(s, s + WINDOW).view(np.int64).tolist()):
                    rows.append((a["h"], a["ctx"], a["lo"], o, w, 0, None))
        yield pd.DataFrame(rows, columns=["h", "ctx", "lo", "place", "window", "left", "words"])


CONTENT = "h long, ctx long, lo long, place int, window long, left int, words binary"


def repeats(group: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix trees of all groups at once: row, begin and node at depth ``WINDOW`` of every window.

    Prefix doubling: the rank of a suffix by its first 2d words comes from its ranks by the first d
    words here and d places on; equal ranks at depth ``WINDOW`` are the leaves below one node.
    """
    size = np.array([len(r) for r in rows], np.int64)
    text = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(rows)), size)
    begin = np.cumsum(size) - size
    left = np.repeat(begin + size, size) - np.arange(len(text))          # words up to the end of the row
    _, rank = np.unique(text, return_inverse=True)
    _, rank = np.unique(group[row] * (int(rank.max(initial=0)) + 1) + rank, return_inverse=True)   # a tree per prefix
    at, depth = np.arange(len(text)), 1
    while depth < WINDOW:
        step = min(depth, WINDOW - depth)
        keep = left[at] >= depth + step
        at, here = at[keep], rank[at[keep]].astype(np.int64)
        there = rank[at + step].astype(np.int64)
        _, new = np.unique(here * (int(rank.max(initial=0)) + 1) + there, return_inverse=True)
        rank = np.zeros(len(text), np.int64)
        rank[at] = new
        depth += step
    return row[at], at - begin[row[at]], rank[at]


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) < BATCH_ROWS:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows.h == rows.h.iloc[-1]                                  # its prefix may go on
        if not last.all():
            yield _nodes(rows[~last])
        held = [rows[last]]
    if held and sum(map(len, held)):
        yield _nodes(pd.concat(held, ignore_index=True))


def _nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """Per context and node the place bits of its windows, and the smallest document where that is
    smaller than the context's own."""
    _, group = np.unique(rows.h.to_numpy(), return_inverse=True)
    row, begin, node = repeats(group, [np.frombuffer(w, "<u8") for w in rows.words])
    lo = rows.lo.to_numpy(np.int64)
    least = np.full(int(node.max(initial=-1)) + 1, LAST, np.int64)
    np.minimum.at(least, node, lo[row])
    place = begin + REACH - 1 - rows.left.to_numpy(np.int64)[row]
    earlier = least[node] < lo[row]                                       # its own first document is known
    row, node, place = row[earlier], node[earlier], place[earlier]
    out = pd.DataFrame({"row": row, "lo": least[node], "bits": np.left_shift(np.int64(1), place)})
    out = out.groupby(["row", "lo"], as_index=False).bits.sum()
    i = out.row.to_numpy()
    return pd.DataFrame({"h": rows.h.to_numpy()[i], "ctx": rows.ctx.to_numpy()[i], "lo": out.lo, "bits": out.bits})


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text, marks in zip(pdf.text, pdf.marks):
            words = split_words(text)
            n, gone = len(words), 0
            if marks is not None and len(marks) and n >= WINDOW:
                p = np.array([m["p"] for m in marks], np.int64)
                bits = np.array([m["bits"] for m in marks], np.int64)
                hit = (bits[:, None] >> np.arange(REACH)) & 1
                s = (p[:, None] - (REACH - 1) + np.arange(REACH))[hit == 1]
                s = np.unique(s[(s >= 0) & (s + WINDOW <= n)])
                edge = np.zeros(n + 1, np.int64)
                edge[s] += 1
                edge[s + WINDOW] -= 1
                cover = np.cumsum(edge[:-1]) > 0
                gone = int(cover.sum())
                words = [w for w, c in zip(words, cover.tolist()) if not c]
            rows.append((n, gone, b" ".join(words)))
        yield pd.DataFrame({
            "doc_id": pdf.doc_id, "n_words": np.array([r[0] for r in rows], np.int64),
            "n_removed": np.array([r[1] for r in rows], np.int64),
            "kept_text": [r[2].decode("utf-8", "surrogatepass") for r in rows],
            "kept_sha256": [hashlib.sha256(r[2]).hexdigest() for r in rows]})


RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256`` of every document."""
    doc = F.col(id_col).cast("long")
    base = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(LAST)).alias("rank_id"),
                       F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    long_enough = base.where(F.length("text") >= 2 * WINDOW - 1)
    occ = materialize(long_enough.drop("doc_id").mapInPandas(_anchors, "h long, ctx long, rank_id long, th long, p int"), "anchors")

    # prefixes of two documents or more; one context: one edge, its windows' first document is known
    shared = materialize(occ.groupBy("h").agg(F.min("rank_id").alias("lo"), F.max("rank_id").alias("hi"),
                                              (F.min("ctx") == F.max("ctx")).alias("edge")).where("lo < hi").select(
        F.col("h").alias("sh"), F.col("lo").alias("first"), "edge"), "shared-prefixes")     # written: the join may split a hot prefix
    both = materialize(occ.join(shared, F.col("h") == F.col("sh")).drop("sh"), "shared-anchors")
    discard(occ)
    every = (1 << REACH) - 1
    edges = both.where("edge and rank_id > first").select("rank_id", "th", "p", F.lit(every).cast("long").alias("bits"))

    # branching prefixes: the text of one occurrence of each distinct context
    first = F.min(F.struct("rank_id", "th", "p")).alias("w")
    ctxs = materialize(both.where("not edge").groupBy("h", "ctx").agg(first), "contexts")
    width = materialize(ctxs.groupBy("h").count().where(F.col("count") > subtree_rows).select(F.col("h").alias("wh")), "wide")
    asked = ctxs.join(width, F.col("h") == F.col("wh"), "left").select(
        F.col("w.rank_id").alias("r"), F.col("w.th").alias("t"),
        F.struct("h", "ctx", F.col("w.rank_id").alias("lo"), F.col("w.p").alias("p"),
                 F.col("wh").isNotNull().alias("wide")).alias("one"))
    asked = asked.groupBy("r", "t").agg(F.collect_list("one").alias("asked"))          # the places of one text
    one_text = long_enough.select("rank_id", "th", "text")
    found = one_text.join(asked, (F.col("rank_id") == F.col("r")) & (F.col("th") == F.col("t"))).select("text", "asked")
    content = materialize(found.mapInPandas(_contents, CONTENT), "context-words")
    trees = content.where("place < 0").select("h", "ctx", "lo", "left", "words").repartition("h").sortWithinPartitions("h")
    nodes = trees.mapInPandas(_subtrees, "h long, ctx long, lo long, bits long")
    wide = content.where("place >= 0").select("h", "ctx", "place", "window", "lo")
    low = materialize(wide.groupBy("h", "place", "window").agg(F.min("lo").alias("least"), F.max("lo").alias("most")).where(
        "least < most").select(F.col("h").alias("lh"), F.col("place").alias("lp"), F.col("window").alias("lw"), "least"), "wide-nodes")
    leaves = wide.join(low, (F.col("h") == F.col("lh")) & (F.col("place") == F.col("lp")) & (F.col("window") == F.col("lw"))
                       & (F.col("least") < F.col("lo"))) \
        .select("h", "ctx", F.col("least").alias("lo"), F.expr("shiftleft(1L, place)").alias("bits"))
    node = nodes.unionByName(leaves).groupBy("h", "ctx", "lo").agg(F.bit_or("bits").alias("bits"))
    nodes = node.groupBy("h", "ctx").agg(F.collect_list(F.struct("lo", "bits")).alias("nodes"))   # at most REACH a context
    # later occurrences of a context lose all its windows to the first, which may lose some to other contexts
    own = ctxs.select("h", "ctx", F.col("w.rank_id").alias("own"))
    per_ctx = materialize(own.join(nodes, ["h", "ctx"], "left").select(
        F.col("h").alias("nh"), F.col("ctx").alias("nc"), "own", "nodes"), "nodes")
    to_others = F.aggregate("nodes", F.lit(0).cast("long"), lambda m, e: F.when(
        e["lo"] < F.col("rank_id"), m.bitwiseOR(e["bits"])).otherwise(m))
    hit = F.when(F.col("rank_id") > F.col("own"), F.lit(every).cast("long")).otherwise(F.coalesce(to_others, F.lit(0).cast("long")))
    branch = both.where("not edge").join(per_ctx, (F.col("h") == F.col("nh")) & (F.col("ctx") == F.col("nc"))).select(
        "rank_id", "th", "p", hit.alias("bits")).where("bits <> 0")
    marks = edges.unionByName(branch).groupBy("rank_id", "th").agg(
        F.collect_set(F.struct("p", "bits")).alias("marks")).select(F.col("rank_id").alias("r"), F.col("th").alias("t"), "marks")
    joined = base.join(marks, (F.col("rank_id") == F.col("r")) & (F.col("th") == F.col("t")), "left")
    return joined.select("doc_id", "text", "marks").mapInPandas(_kept, RESULT)
