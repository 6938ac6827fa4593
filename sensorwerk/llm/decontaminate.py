"""Benchmark decontamination (12): an FM-index per training shard, searched for all test phrases.

Each task cuts its documents into shards of at most ``shard_words`` words. A shard's words become
whole numbers (0 ends a document), its suffixes are sorted by prefix doubling, and the index keeps
the Burrows-Wheeler column as a wavelet matrix with rank blocks, the word counts, and the text
positions of sampled rows. All phrases are searched backwards at once: a step takes the row ranges
of the phrases still alive through two wavelet ranks. The rows found are walked by last-to-first
steps to a sampled row, which gives their position; the spans of a document are merged.

Every document goes through an index; nothing is shuffled. Test phrases are collected on the driver
only in blocks of bounded size (``block_words`` words of items); with more than one block the texts
are indexed and searched once a block, and the blocks' spans are merged per document.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. Defined
cases: null and empty texts have no words and are never contaminated; an item without words (or with
a null text) occurs nowhere; items of equal id count once; a null item id is named by the empty text;
an item of fewer than ``window`` words is one phrase; repeated rows and null ids of documents give a
row each; documents beyond ``shard_words`` are cut into overlapping pieces, so texts of any length
are searched whole; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.llm.common import materialize

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE_EVERY = 16
BLOCK_WORDS = 500_000            # words of test items that are held in memory at once
SLICE_BYTES = 16 << 20           # text that is cut into words at once

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a blank.
_AS_WORDS = np.full(256, 32, np.uint8)
_AS_WORDS[128:] = np.arange(128, 256)
_AS_WORDS[48:58] = np.arange(48, 58)
_AS_WORDS[97:123] = _AS_WORDS[65:91] = np.arange(97, 123)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the number of words of each text (null: 0)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets, data = texts.buffers()[1], texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    clean = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(_AS_WORDS[raw])], 0, texts.offset)
    parts = pc.ascii_split_whitespace(clean)
    words = parts.flatten()
    real = pc.not_equal(words, "")
    held = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = parts.offsets.to_numpy()
    return words.filter(real), np.diff(held[ends - ends[0]])


# ---- the index ---------------------------------------------------------------------------------
class Bits:
    """A bit row with ranks: 64-bit words and the ones before each."""

    def __init__(self, words: np.ndarray, before: np.ndarray):
        self.words, self.before = words, before

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(words).astype(np.int32)
        return cls(words, np.cumsum(ones, dtype=np.int32) - ones)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def sort_suffixes(symbols: np.ndarray, n_ends: int) -> np.ndarray:
    """Suffix array of a text whose document ends are the distinct smallest symbols (prefix doubling).

    ``symbols``: ends are 0 .. n_ends - 1 in order of their places, words follow. Each round sorts
    only the suffixes that are not yet alone under their rank.
    """
    n = len(symbols)
    width = int(symbols.max(initial=0) + 1).bit_length()
    taken = max(1, min(63 // max(width, 1), 4, n))
    key, reach = np.zeros(n, np.int64), taken
    for j in range(taken):                                # the first words of every suffix in one number
        key <<= width
        key[:n - j] |= symbols[j:] + 1 if j else symbols + 1
    order = np.argsort(key)
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = head                                    # first place of the suffix's group
    alone = fresh & np.append(fresh[1:], True)
    open_at = np.flatnonzero(~alone)                      # places in ``order`` still in a larger group
    while len(open_at):
        at = order[open_at]
        after = at + reach
        nxt = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[at]
        by = np.argsort(group * (n + 1) + nxt)
        at, nxt, group = at[by], nxt[by], group[by]
        order[open_at] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        rank[at] = open_at[head]
        alone = fresh & np.append(fresh[1:], True)
        open_at, reach = open_at[~alone], reach * 2
    return order


class FmIndex:
    """FM-index of a shard: word ids 1 .. n_words, 0 where a document ends."""

    def __init__(self, text: np.ndarray, n_words: int, every: int = SAMPLE_EVERY):
        closes = text == 0
        n_ends = int(closes.sum())
        symbols = text.astype(np.int64) + (n_ends - 1)
        symbols[closes] = np.arange(n_ends)
        order = sort_suffixes(symbols, n_ends)
        column = text[order - 1]                                     # the word before each suffix
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_words + 1))])   # first row of each word
        take = (order % every == 0) | (column == 0)                  # a document's first word is sampled, too
        self.sampled, self.positions = Bits.of(take), order[take].astype(np.int32 if len(text) < 1 << 31 else np.int64)
        self.levels, self.zeros = [], []
        for bit in reversed(range(max(1, int(n_words).bit_length()))):
            one = (column >> bit) & 1 != 0
            self.levels.append(Bits.of(one))
            column = np.concatenate([column[~one], column[one]])     # stable: zeros first
            self.zeros.append(int(len(one) - one.sum()))

    def rank(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each word stands in the column before each row."""
        low = np.zeros_like(at)
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (word >> (len(self.levels) - 1 - k)) & 1 != 0
            a, b = bits.rank(low), bits.rank(at)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
        return at - low

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one word longer, of rows whose column holds a word."""
        word, at = np.zeros_like(row), row
        low = np.zeros_like(row)
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.get(at)
            a, b = bits.rank(low), bits.rank(at)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
            word = word * 2 + one
        return self.starts[word] + at - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases; row i holds its ``lengths[i]`` word ids from the right end of the row."""
        width = phrases.shape[1]
        last = phrases[:, -1]
        low, high = self.starts[last].copy(), self.starts[last + 1].copy()
        for j in range(1, width):
            live = np.flatnonzero((lengths > j) & (high > low))
            if not len(live):
                break
            word = phrases[live, width - 1 - j]
            first = self.starts[word]
            ranks = self.rank(np.concatenate([word, word]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = first + ranks[:len(live)], first + ranks[len(live):]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        out, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_at = np.arange(len(rows))
        rows = rows.copy()
        while len(open_at):
            at = rows[open_at]
            hit = self.sampled.get(at)
            done = open_at[hit]
            out[done] = self.positions[self.sampled.rank(rows[done])] + steps[done]
            open_at = open_at[~hit]
            rows[open_at] = self.back(rows[open_at])
            steps[open_at] += 1
        return out


# ---- test phrases -------------------------------------------------------------------------------
class Phrases:
    """Distinct phrases over their own vocabulary, and the items that hold each."""

    def __init__(self, items: list[str], texts: list, window: int):
        words, counts = words_of(pa.array(texts, pa.string()))
        coded = words.dictionary_encode() if len(words) else None
        self.vocabulary = coded.dictionary if coded is not None else pa.array([], pa.large_string())
        ids = coded.indices.to_numpy().astype(np.int64) if coded is not None else np.zeros(0, np.int64)
        self.items = sorted(set(items))
        place = {x: i for i, x in enumerate(self.items)}
        item = np.repeat(np.array([place[x] for x in items], np.int64), counts)
        starts = np.cumsum(counts) - counts
        length = np.repeat(np.minimum(counts, window), counts)
        left = np.repeat(starts + counts, counts) - np.arange(len(ids))
        begin = np.flatnonzero(left >= length)                       # where a whole phrase starts
        length = length[begin]
        rows = np.full((len(begin), window), -1, np.int32)
        for j in range(window):
            has = length > j
            rows[has, window - 1 - j] = ids[begin[has] + length[has] - 1 - j]
        self.rows, which = (np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64)))
        self.lengths = (self.rows >= 0).sum(axis=1)
        pairs = np.unique(np.stack([which.ravel(), item[begin]], axis=1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
        self.of_item = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))


def occurrences(index: FmIndex, vocabulary: pa.Array, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Text position and phrase number of every occurrence in the shard."""
    known = pc.index_in(phrases.vocabulary, value_set=vocabulary)
    ids = np.append(pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1, 0)    # 0: not in the shard
    rows = ids[phrases.rows]
    able = np.flatnonzero(((rows > 0) | (phrases.rows < 0)).all(axis=1))
    if not len(able):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = index.search(rows[able], phrases.lengths[able])
    found = np.flatnonzero(high > low)
    n = (high - low)[found]
    which = np.repeat(able[found], n)
    at = np.repeat(low[found] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return index.locate(at), which


# ---- shards of a task ---------------------------------------------------------------------------
class Shard:
    """Pieces of documents: their number in the task, first word and words."""

    def __init__(self):
        self.words, self.docs, self.starts, self.sizes, self.size = [], [], [], [], 0

    def add(self, words: pa.Array, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.words.append(words)
        self.docs.append(doc)
        self.starts.append(start)
        self.sizes.append(size)
        self.size += len(words)

    def index(self) -> tuple[FmIndex, pa.Array, np.ndarray]:
        """Index, vocabulary and the pieces ``(doc, start, size, place in the text)``."""
        coded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        doc, start, size = (np.concatenate(x) for x in (self.docs, self.starts, self.sizes))
        place = np.cumsum(size + 1) - (size + 1)
        text = np.zeros(int(size.sum()) + len(size), np.int64)
        is_word = np.ones(len(text), bool)
        is_word[place + size] = False
        text[is_word] = coded.indices.to_numpy().astype(np.int64) + 1
        return FmIndex(text, len(coded.dictionary)), coded.dictionary, np.stack([doc, start, size, place])


def in_slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def shards_of(batches: Iterator[pa.RecordBatch], shard_words: int, overlap: int, seen):
    """Fills shards; ``seen(ids, counts)`` takes the rows' ids and word counts as they come."""
    shard, no = Shard(), 0
    for batch in batches:
        for part in in_slices(batch, SLICE_BYTES):
            words, counts = words_of(part["text"])
            seen(part["doc_id"].to_pylist(), counts)
            step = shard_words - overlap
            pieces = np.maximum(1, -(-np.maximum(counts - overlap, 0) // step))
            doc = np.repeat(np.arange(no, no + len(counts)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * step
            size = np.minimum(np.repeat(counts, pieces) - start, shard_words)
            begin = np.repeat(np.cumsum(counts) - counts, pieces) + start
            no += len(counts)
            real = np.flatnonzero(size > 0)
            doc, start, size, begin = doc[real], start[real], size[real], begin[real]
            i = 0
            while i < len(doc):
                total = np.cumsum(size[i:])
                k = int(np.searchsorted(total, shard_words - shard.size, "right"))
                if not k and shard.size:
                    yield shard
                    shard = Shard()
                    continue
                j = i + max(1, k)
                taken = [words.slice(int(begin[x]), int(size[x])) for x in range(i, j)] if (nth > 0).any() else \
                    [words.slice(int(begin[i]), int(size[i:j].sum()))]
                shard.add(pa.concat_arrays(taken), doc[i:j], start[i:j], size[i:j])
                i = j
    if shard.size:
        yield shard


def spans_in(index: FmIndex, vocabulary: pa.Array, pieces: np.ndarray, phrases: Phrases) -> tuple[dict, dict]:
    """Merged spans and items per document number of the shard's task."""
    at, which = occurrences(index, vocabulary, phrases)
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    if not len(at):
        return spans, items
    doc, start, _, place = pieces
    k = np.searchsorted(place, at, "right") - 1
    begin = at - place[k] + start[k]
    number, end = doc[k], begin + phrases.lengths[which]
    for a, b, c in np.unique(np.stack([number, begin, end], axis=1), axis=0).tolist():
        have = spans.setdefault(a, [])
        if have and b <= have[-1][1]:
            have[-1][1] = max(c, have[-1][1])
        else:
            have.append([b, c])
    for a, w in np.unique(np.stack([number, which], axis=1), axis=0).tolist():
        items.setdefault(a, set()).update(phrases.of_item[phrases.first[w]:phrases.first[w + 1]].tolist())
    return spans, items


def merged(spans: list) -> list[dict]:
    out: list[list] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


RESULT = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                          ("items", pa.list_(pa.string()))])


def _scan(phrases: Phrases, shard_words: int, window: int):
    """Builds, searches and forgets the indexes of a task's shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, spans, items, sent = [], [], {}, {}, 0

        def seen(new_ids, new_counts):
            ids.extend(new_ids)
            counts.extend(new_counts.tolist())

        def rows(upto: int) -> pa.RecordBatch:
            nonlocal sent
            numbers = range(sent, upto)
            out = [ids[:upto - sent], counts[:upto - sent], [merged(spans.pop(x, [])) for x in numbers],
                   [[phrases.items[i] for i in sorted(items.pop(x, ()))] for x in numbers]]
            del ids[:upto - sent], counts[:upto - sent]
            sent = upto
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, RESULT_ARROW)], schema=RESULT_ARROW)

        for shard in shards_of(batches, shard_words, window - 1, seen):
            index, vocabulary, pieces = shard.index()
            got_spans, got_items = spans_in(index, vocabulary, pieces, phrases)
            for x, s in got_spans.items():
                spans.setdefault(x, []).extend(s)
            for x, s in got_items.items():
                items.setdefault(x, set()).update(s)
            last = int(pieces[0, -1])                                # its other pieces may follow
            if last > sent:
                yield rows(last)
        if ids:
            yield rows(sent + len(ids))
    return run


def phrase_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> list[DataFrame]:
    """The benchmark as ``item, text`` in blocks of about ``block_words`` words."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    most = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0       # a word has a letter and a gap at least
    n = max(1, -(-int(most) // block_words))
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) for b in range(n)] if n > 1 else [items]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [merged([(x["start"], x["end"]) for x in row]) for row in batch["spans"].to_pylist()]
        columns = [batch["doc_id"], batch["n_words"], pa.array(spans, RESULT_ARROW.field("spans").type), batch["items"]]
        yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, RESULT_ARROW)], schema=RESULT_ARROW)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", shard_words: int = SHARD_WORDS,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, spans, items``: merged word spans ``[start, end)`` and sorted items of every document."""
    if window < 1 or shard_words < 2 * window:
        raise ValueError("a shard must hold two windows")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(rows: DataFrame, block: DataFrame) -> DataFrame:
        held = block.collect()                                              # about block_words words
        phrases = Phrases([r.item for r in held], [r.text for r in held], window)
        return rows.mapInArrow(_scan(phrases, shard_words, window), RESULT)

    blocks = phrase_blocks(benchmark, item_col, item_text_col, block_words)
    if len(blocks) == 1:
        return scan(texts, blocks[0])
    texts = materialize(texts.withColumn("row_no", F.monotonically_increasing_id()), "decontaminate-rows")
    by_row = texts.select(F.col("row_no").alias("doc_id"), "text")
    found = [materialize(scan(by_row, block), "decontaminate-block").withColumnRenamed("doc_id", "row_no") for block in blocks]
    rows = reduce(DataFrame.unionByName, found).groupBy("row_no").agg(      # a row a block
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.join(texts.select("row_no", "doc_id"), "row_no").select("doc_id", "n_words", "spans", "items").mapInArrow(_merge, RESULT)


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`contamination` rows."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def remove_spans(texts: list, spans: list) -> list:
    """Each text's words without those inside its spans, joined by one blank (None stays None)."""
    words, counts = words_of(pa.array(texts, pa.string()))
    out, at, flat = [], 0, words.to_pylist()
    for text, n, holes in zip(texts, counts.tolist(), spans):
        own, at = flat[at:at + n], at + n
        for x in reversed(holes):
            del own[x["start"]:x["end"]]
        out.append(None if text is None else " ".join(own))
    return out
