"""Phrase collocation mining (13): double-array tries of Apriori-safe candidates, advanced by numpy.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at blanks and
tabs into words; everything is per language. Candidates grow level by level. A pass over the texts
hashes the k-word phrases whose first and last k-1 words passed the level before, Spark sums the
shards' counts per hash bucket, and the buckets that reach the least count are kept. Phrases in one
bucket only add to each other and a phrase is never more frequent than its parts, so no phrase that
reaches the least count is lost. The kept buckets become a sieve, a bit row sized by their number
(``KEY_BITS`` bits and ``PROBES`` probes a bucket), and the next pass names the phrases that pass it.
False passes are harmless: they are counted and dropped.

The named phrases are dealt into blocks of bounded size by the hash of their first two words (single
words by their own). Each block becomes one double-array trie, built by a Spark task: a word is two
digits, and a state's child by a digit is at ``base[state] + digit`` if ``check`` there names the state.
One pass over the texts deals every position to the block of its first two words, as a window of the
words that can be a phrase; equal windows of a shard are one with a count. A block's task advances
the states of all its windows together, word by word, and bincounts the accepting states, so that each
position meets one trie however many there are. Scores are taken in 38-digit decimals.

Memory: a task holds one shard of text (``SHARD_BYTES``, or one piece if that is longer) and the sieves
(at most 64 MB each), or one trie of about ``block_phrases`` phrases and ``HELD_WINDOWS`` windows. Groups of the
bucket step are hash ranges sized by the corpus, so a common word or phrase gives one number a shard.

Defined cases: null texts and texts without words count nothing; a null language is ``und``; repeated
rows and null ids count like any other row; ties go by count, then by the phrase's UTF-8 bytes; an
empty table gives an empty result; only the text and language columns are read. Counts up to 10^15
are exact.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import discard, materialize

LEAST = 10
LONGEST = 3
TOP = 2_000
CONTAINED = 50                  # per cent of the shorter phrase's count
SHARD_BYTES = 3 << 20
HELD_KEYS = 1 << 20             # distinct keys that a task holds before it passes them on
SIEVE_BITS = 29                 # of a sieve, as a power of two, at most
KEY_BITS = 12                   # bits of a sieve for each kept bucket
PROBES = 3                      # bits that a kept bucket sets
BATCH_ROWS = 1_000              # texts that Spark hands to Python at once
WINDOW_ROWS = 32                # rows of windows that Spark hands to Python at once
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
RANGE_BYTES = 12 << 20          # bytes of text per hash range of the bucket step
BLOCK_PHRASES = 500_000
TRIES = 3                       # blocks that a task counts, one after another
BLOCK_BYTES = 16 << 20          # bytes of text per block, so that small vocabularies are counted in several tasks, too
SPREAD_BLOCKS = 256             # blocks that BLOCK_BYTES asks for at most
HELD_WINDOWS = 1 << 20          # windows that a block's task counts at once

_WORD, _BLANK, _CUT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _CUT
_AS_WORDS = np.arange(256, dtype=np.uint8)
_AS_WORDS[65:91] += 32
_AS_WORDS[_KIND != _WORD] = 32


# ---- words of a shard ---------------------------------------------------------------------------
class Words:
    """The words of some texts of one language: number of each place's word, and where pieces end."""

    def __init__(self, texts: pa.Array):
        """``texts``: large_string without nulls."""
        data, offsets = texts.buffers()[2], np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
        kind = _KIND[raw]
        kind_before = np.empty_like(kind)
        kind_before[:1], kind_before[1:] = _CUT, kind[:-1]
        at_text = np.zeros(len(raw) + 1, bool)
        at_text[offsets[:-1] - offsets[0]] = True                    # a text's first byte begins a word, too
        begins = np.flatnonzero((kind == _WORD) & ((kind_before != _WORD) | at_text[:-1]))
        #: number of cuts up to each word: words of one piece share it
        self.piece = np.cumsum((kind == _CUT) | at_text[:-1], dtype=np.int32)[begins]
        clean = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_AS_WORDS[raw])])
        words = pc.ascii_split_whitespace(clean).flatten()
        coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
        self.names, self.ids = coded.dictionary, coded.indices.to_numpy()
        if len(self.ids) != len(begins):
            raise AssertionError("words and places differ")

    def joined(self, k: int) -> np.ndarray:
        """Places whose word and the next k - 1 lie in one piece."""
        n = len(self.ids) - k + 1
        return np.flatnonzero(self.piece[:n] == self.piece[k - 1:]) if n > 0 else np.zeros(0, np.int64)

    def hashes(self, lang: str) -> np.ndarray:
        """64-bit hash of each distinct word under its language (a polynomial of its bytes, mixed)."""
        names = self.names
        ends = np.frombuffer(names.buffers()[1], np.int64)[names.offset:names.offset + len(names) + 1]
        data = np.frombuffer(names.buffers()[2], np.uint8)[:ends[-1]] if len(names) else np.zeros(0, np.uint8)
        up, down = powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])])
        own = (sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]]
        return mix(own + mix(np.full(1, xxhash.xxh64_intdigest(lang), np.uint64) + np.diff(ends).astype(np.uint64)))


_ODD = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for i, b in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            _POWERS[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n + (n >> 1), b, np.uint64))])
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of(word_hash: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place (``word_hash`` is per place)."""
    key = mix(word_hash[places] + np.uint64(k))
    for j in range(1, k):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + word_hash[places + j])
    return key


def _pieces(text: str, limit: int) -> list[str]:
    """A long text in parts of about ``limit`` characters, cut where a piece ends."""
    parts, at = [], 0
    while len(text) - at > limit:
        cut = max(text.rfind(c, at, at + limit) for c in ".,;:!?\n\x0b\x0c\r")
        if cut < at:                                                 # a piece longer than the limit stays whole
            ends = [x for x in (text.find(c, at + limit) for c in ".,;:!?\n\x0b\x0c\r") if x >= 0]
            if not ends:
                break
            cut = min(ends)
        parts.append(text[at:cut + 1])
        at = cut + 1
    return [*parts, text[at:]]


def in_slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text, so that copies stay small."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)


def shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, Words]]:
    """The rows' words, language by language, from shards of about ``limit`` bytes."""
    held: dict[str, list] = {}
    size: dict[str, int] = {}
    total = 0

    def release(lang: str) -> Words:
        size.pop(lang)
        return Words(pa.concat_arrays(held.pop(lang)))

    for batch in (part for whole in batches for part in in_slices(whole, limit)):
        texts = pc.fill_null(batch["text"], "").cast(pa.large_string())
        coded = pc.fill_null(batch["lang"], "und").dictionary_encode()
        lang_of, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        sizes = pc.binary_length(texts).to_numpy()
        for i, lang in enumerate(names):
            at = np.flatnonzero((lang_of == i) & (sizes > 0))
            part = (np.cumsum(sizes[at]) - 1) // limit
            for rows in np.split(at, np.flatnonzero(np.diff(part)) + 1) if len(at) else []:
                own = texts.take(pa.array(rows))
                if sizes[rows].max() > limit:
                    own = pa.array([p for t in own.to_pylist() for p in _pieces(t, limit)], pa.large_string())
                for one in ([own.slice(j, 1) for j in range(len(own))] if sizes[rows].max() > limit else [own]):
                    n = int(pc.sum(pc.binary_length(one)).as_py() or 0)
                    held.setdefault(lang, []).append(one)
                    size[lang] = size.get(lang, 0) + n
                    total += n
                    if size[lang] >= limit:
                        total -= size[lang]
                        yield lang, release(lang)
                while total >= 2 * limit:                            # many languages: the largest goes first
                    most = max(size, key=size.get)
                    total -= size[most]
                    yield most, release(most)
    for lang in list(held):
        yield lang, release(lang)


# ---- sieves ------------------------------------------------------------------------------------
def probes(at: np.ndarray, low_bits: int) -> Iterator[np.ndarray]:
    """The bits of 32-bit buckets in their hash range's part of the sieve, which has ``1 << low_bits`` bits."""
    for odd in (1, 0x9E3779B1, 0x85EBCA77)[:PROBES]:
        yield ((at * np.uint32(odd)) >> np.uint32(32 - low_bits)).astype(np.int64)


class Sieve:
    """Bit row over the buckets of the keys, hash range by hash range; the kept buckets' bits are set. At most ``1 << SIEVE_BITS`` of them."""

    def __init__(self, bits: np.ndarray, width: int, part_bits: int):
        self.bits, self.width, self.part_bits = bits, width, part_bits          # uint8, packed

    def has(self, keys: np.ndarray) -> np.ndarray:
        part = (keys >> np.uint64(64 - self.part_bits)).astype(np.int64) << (self.width - self.part_bits)
        bucket = (keys >> np.uint64(32 - self.part_bits)).astype(np.uint32)
        out = np.ones(len(keys), bool)
        for low in probes(bucket, self.width - self.part_bits):
            at = part + low
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0
        return out


class Sieves(list):
    """Broadcasts of packed sieves; a task unpacks them."""

    def add(self, spark, bits: np.ndarray, width: int, part_bits: int) -> None:
        self.append(spark.sparkContext.broadcast((zlib.compress(bits.tobytes(), 1), width, part_bits)))

    def unpack(self) -> list[Sieve]:
        return [Sieve(np.frombuffer(zlib.decompress(b.value[0]), np.uint8), *b.value[1:]) for b in self]


def passing(words: Words, hashes: np.ndarray, k: int, sieves: list[Sieve], shorter: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the k-word phrases whose two parts of k - 1 words pass (``sieves[j - 1]`` is for j words).

    ``shorter``: this function's result for k - 1, if it is known."""
    places = words.joined(k)
    each = hashes[words.ids]
    if k > 1 and len(places):
        if k == 2:
            ok = sieves[0].has(keys_of(hashes, np.arange(len(hashes)), 1))[words.ids]
        else:
            ok = np.zeros(len(words.ids), bool)
            inner, keys = shorter or passing(words, hashes, k - 1, sieves)
            ok[inner] = sieves[k - 2].has(keys)
        places = places[ok[places] & ok[places + 1]]
    return places, keys_of(each, places, k)


PASS = "lang string, k int, phrase string, deal long, part int, at binary, n binary, n_words long"
PASS_ARROW = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("deal", pa.int64()), ("part", pa.int32()),
                        ("at", pa.binary()), ("n", pa.binary()), ("n_words", pa.int64())])


def _rows(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in PASS_ARROW], schema=PASS_ARROW)


class Buckets:
    """Counts per 32-bit bucket and hash range over a task's shards."""

    def __init__(self, part_bits: int):
        self.part_bits, self.found, self.counts, self.size = part_bits, [], [], 0

    def add(self, keys: np.ndarray) -> None:
        found, n = np.unique(keys >> np.uint64(64 - self.part_bits - 32), return_counts=True)
        self.found.append(found)
        self.counts.append(n.astype(np.int32))
        self.size += len(found)

    def release(self) -> pa.RecordBatch:
        """A row per hash range: its buckets and their counts (255 stands for more)."""
        found, n = np.concatenate([*self.found, np.zeros(0, np.uint64)]), np.concatenate([*self.counts, np.zeros(0, np.int32)])
        order = np.argsort(found)
        found, n = found[order], n[order]
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
        found, n = found[first], np.minimum(np.add.reduceat(n, first), 255).astype(np.uint8) if len(first) else n.astype(np.uint8)
        part, at = (found >> np.uint64(32)).astype(np.int64), found.astype("<u4")
        ends = np.searchsorted(part, np.arange((1 << self.part_bits) + 1))
        real = [(p, a, b) for p, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())) if b > a]
        self.found, self.counts, self.size = [], [], 0
        return _rows(len(real), part=pa.array([p for p, _, _ in real], pa.int32()),
                     at=pa.array([at[a:b].tobytes() for _, a, b in real], pa.binary()),
                     n=pa.array([n[a:b].tobytes() for _, a, b in real], pa.binary()))


def deals(word_hash: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """What deals the k-word phrases at the places to blocks: 31 bits of the hash of their first two words, or of the only one."""
    return (keys_of(word_hash, places, min(k, 2)) >> np.uint64(33)).astype(np.int64)


def name_rows(lang: str, words: Words, hashes: np.ndarray, places: np.ndarray, k: int) -> pa.RecordBatch:
    parts = [words.names.take(pa.array(words.ids[places + j])) for j in range(k)]
    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if k > 1 else parts[0]
    return _rows(len(places), lang=pa.array([lang] * len(places), pa.string()), k=pa.array(np.full(len(places), k, np.int32)),
                 phrase=phrase.cast(pa.string()), deal=pa.array(deals(hashes[words.ids], places, k)))


def unseen(keys: np.ndarray, places: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key that is not in ``seen`` (sorted), and the new ``seen``."""
    order = np.argsort(keys)
    keys, places = keys[order], places[order]
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    if len(seen):
        new &= seen[np.minimum(np.searchsorted(seen, keys), len(seen) - 1)] != keys
    return places[new], np.sort(np.concatenate([seen, keys[new]]))


def _pass(k: int, longest: int, packed: Sieves, part_bits: int, shard_bytes: int):
    """One reading of the texts: names the k-word phrases that pass the k-th sieve, once a task, and counts the
    longer ones made of them by bucket. The first also counts each language's words (``n_words``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves, buckets, seen, total = packed.unpack(), Buckets(part_bits), np.zeros(0, np.uint64), {}
        for lang, words in shards(batches, shard_bytes):
            hashes, found = words.hashes(lang), None
            total[lang] = total.get(lang, 0) + len(words.ids)
            if k:
                found = places, keys = passing(words, hashes, k, sieves)
                ok = sieves[k - 1].has(keys)
                new, seen = unseen(keys[ok], places[ok], seen)
                yield name_rows(lang, words, hashes, new, k)
                if len(seen) >= HELD_KEYS:                           # names may come again from here
                    seen = np.zeros(0, np.uint64)
            if k < longest:
                buckets.add(passing(words, hashes, k + 1, sieves, found)[1])
                if buckets.size >= HELD_KEYS:
                    yield buckets.release()
        if k < longest:
            yield buckets.release()
        if not k:
            yield _rows(len(total), lang=pa.array(list(total), pa.string()), n_words=pa.array(list(total.values()), pa.int64()))
    return run


def _keep(least: int):
    """A hash range's buckets that reach the least count, and their number."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.concatenate([np.frombuffer(b, "<u4") for b in pdf["at"]])
        n = np.concatenate([np.frombuffer(b, np.uint8) for b in pdf.n]).astype(np.int64)
        order = np.argsort(at)
        at, n = at[order], n[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        kept = at[first[np.add.reduceat(n, first) >= least]]
        return pd.DataFrame({"part": [int(pdf.part.iat[0])], "kept": [kept.tobytes()], "many": [len(kept)]})
    return run


def _bits(part_bits: int, width: int):
    """The hash ranges' bits of the sieve."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, kept in zip(pdf.part, pdf.kept):
                bits = np.zeros(1 << (width - part_bits), bool)
                for low in probes(np.frombuffer(kept, "<u4"), width - part_bits):
                    bits[low] = True
                yield pd.DataFrame({"part": [part], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    return run


# ---- double-array tries ------------------------------------------------------------------------
class Trie:
    """Double array over word pairs of digits. State 0 is dead, state 1 the root."""

    def __init__(self, langs: list[str], vocabularies: list[pa.Array], digit_bits: int, base, check, accept):
        self.langs, self.vocabularies, self.digit_bits = langs, vocabularies, digit_bits
        self.base, self.check, self.accept = base, check, accept     # int32; accept: phrase number or -1
        self.first_id = np.cumsum([0] + [len(v) for v in vocabularies])
        self.roots = self.step(np.ones(int(self.first_id[-1]), np.int64), np.arange(int(self.first_id[-1])))

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """States after one more word (two digits), 0 where the trie has none."""
        for digit in (word >> self.digit_bits, word & ((1 << self.digit_bits) - 1)):
            to = self.base[state] + digit
            state = np.where(self.check[to] == state, to, 0)
        return state

    def count(self, lang: str, names: pa.Array, windows: np.ndarray, n: np.ndarray, into: np.ndarray) -> None:
        """Adds ``n`` for every phrase that a window begins with; windows are rows of places in ``names``, -1 after their end.

        Windows of several words stand for phrases of two words or more, those of one word for that word."""
        if lang not in self.langs:
            return
        v = self.langs.index(lang)
        known = pc.fill_null(pc.index_in(names, value_set=self.vocabularies[v]), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.append(np.where(known >= 0, known + self.first_id[v], -1), -1)[windows]         # -1: past the end
        lone = windows[:, 1] < 0 if windows.shape[1] > 1 else np.ones(len(windows), bool)
        rows = np.flatnonzero(ids[:, 0] >= 0)
        state = self.roots[ids[rows, 0]]
        for k in range(1, windows.shape[1] + 1):
            live = state > 0
            rows, state = rows[live], state[live]
            hit = self.accept[state]
            at = np.flatnonzero((hit >= 0) & (lone[rows] if k == 1 else True))
            np.add.at(into, hit[at], n[rows[at]])
            if k == windows.shape[1]:
                break
            more = ids[rows, k] >= 0
            rows, state = rows[more], state[more]
            state = self.step(state, ids[rows, k])


def place_families(family: np.ndarray, digit: np.ndarray, n_families: int, span: int) -> tuple[np.ndarray, int]:
    """A base for each family of children so that no two children share a slot.

    Families are placed by falling size, sizes of one power of two together: all draw bases, those
    whose slots are free and claimed by no earlier family stay, the rest draw again; where fewer than a
    tenth find a place, the array grows. Only children then take the free slots in turn.
    """
    rng = np.random.default_rng(0)
    size = np.bincount(family, minlength=n_families)
    order = np.argsort(family, kind="stable")
    family, digit = family[order], digit[order]
    begin = np.cumsum(size) - size
    base = np.zeros(n_families, np.int64)
    reach = max(2 * span, len(family) * 3 // 2)
    used = np.zeros(reach + span, bool)
    used[:2] = True
    claim = np.full(reach + span, n_families, np.int64)
    level = np.zeros(n_families, np.int64)
    level[size > 1] = np.floor(np.log2(size[size > 1])).astype(np.int64) + 1
    for step in range(int(level.max(initial=0)), 0, -1):
        open_ = np.flatnonzero(level == step)
        low = 0
        while len(open_):
            n = size[open_]
            who = np.repeat(np.arange(len(open_)), n)
            kid = np.repeat(begin[open_] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            at = rng.integers(low, reach, len(open_))
            slot = at[who] + digit[kid]
            claim[slot[::-1]] = who[::-1]                            # the first claim stays
            good = np.ones(len(open_), bool)
            good[who[used[slot] | (claim[slot] != who)]] = False
            claim[slot] = n_families
            base[open_[good]] = at[good]
            used[slot[good[who]]] = True
            open_, low = open_[~good], 0
            if len(open_) and good.mean() < 0.1:                     # crowded: fresh slots for those left
                more = max(span, 2 * int(size[open_].sum()))
                used, claim = np.append(used, np.zeros(more, bool)), np.append(claim, np.full(more, n_families, np.int64))
                low, reach = reach - 1, reach + more
    lone = np.flatnonzero(size == 1)
    free = np.flatnonzero(~used[span:]) + span                       # bases stay above zero
    if len(free) < len(lone):
        free = np.append(free, np.arange(len(used), len(used) + len(lone) - len(free)))
    base[lone] = free[:len(lone)] - digit[begin[lone]]
    top = int((base[family] + digit).max(initial=1))
    return base, top + 1


def build_trie(words: np.ndarray, n_words: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digit bits, base, check, accept of the phrases, rows of word numbers that end in -1."""
    bits = max(1, -(-max(1, int(n_words - 1).bit_length()) // 2))
    digits = np.stack([words >> bits, words & ((1 << bits) - 1)], axis=2).reshape(len(words), -1)
    digits[np.repeat(words < 0, 2, axis=1)] = -1
    node = np.zeros(len(words), np.int64)                            # 0: the root
    parents, labels, n_nodes = [], [], 1
    ends = np.zeros(len(words), np.int64)
    live = np.arange(len(words))
    for d in range(digits.shape[1]):
        live = live[digits[live, d] >= 0]
        if not len(live):
            break
        edge, which = np.unique(node[live] * (1 << bits) + digits[live, d], return_inverse=True)
        parents.append(edge >> bits)
        labels.append(edge & ((1 << bits) - 1))
        node[live] = n_nodes + which
        n_nodes += len(edge)
        ends[live] = node[live]
    parent, label = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, labels))
    base_of, top = place_families(parent, label, n_nodes, 1 << bits)
    slot = np.empty(n_nodes, np.int64)
    slot[0] = 1
    slot[1:] = base_of[parent] + label
    base = np.zeros(top, np.int32)
    check = np.full(top + (1 << bits), -1, np.int32)                 # room for any digit of the last base
    accept = np.full(top, -1, np.int32)
    base[slot] = base_of
    base[0] = top                                                    # dead: every digit leads to a free slot
    childless = np.bincount(parent, minlength=n_nodes) == 0
    base[slot[childless]] = top
    check[slot[1:]] = slot[parent]
    accept[slot[ends]] = np.arange(len(words))
    return bits, base, check, accept, ends


TRIE_SCHEMA = "block long, langs array<string>, words array<binary>, bits int, base binary, check binary, accept binary, phrases long"

TRIE_ARROW = pa.schema([("block", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.binary())), ("bits", pa.int32()),
                        ("base", pa.binary()), ("check", pa.binary()), ("accept", pa.binary()), ("phrases", pa.int64())])


def _build(table: pa.Table) -> pa.Table:
    """One block's trie; ``no`` numbers its phrases from 0."""
    table = table.sort_by("no").combine_chunks()
    lang_of = table["lang"].combine_chunks().dictionary_encode()
    names, codes = lang_of.dictionary.to_pylist(), lang_of.indices.to_numpy()
    k = table["k"].to_numpy().astype(np.int64)
    phrases = table["phrase"].cast(pa.large_string()).combine_chunks()
    vocabularies, first, rows = [], 0, np.full((len(k), int(k.max())), -1, np.int64)
    for i in range(len(names)):
        at = np.flatnonzero(codes == i)
        flat = pc.split_pattern(phrases.take(pa.array(at)), " ").flatten().dictionary_encode()
        place = np.arange(int(k[at].sum())) - np.repeat(np.cumsum(k[at]) - k[at], k[at])
        rows[np.repeat(at, k[at]), place] = flat.indices.to_numpy().astype(np.int64) + first
        vocabularies.append(flat.dictionary)
        first += len(flat.dictionary)
    bits, base, check, accept, _ = build_trie(rows, first)
    out = {"block": [table["block"][0].as_py()], "langs": [names], "words": [[_to_ipc(v) for v in vocabularies]], "bits": [bits],
           "base": [_pack(base)], "check": [_pack(check)], "accept": [_pack(accept)], "phrases": [len(k)]}
    return pa.table({f.name: pa.array(out[f.name], f.type) for f in TRIE_ARROW}, schema=TRIE_ARROW)


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _to_ipc(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([values], names=["w"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(blob: bytes) -> pa.Array:
    return pa.ipc.open_stream(blob).read_all()["w"].combine_chunks()


def _trie(row) -> Trie:
    base, check, accept = (np.frombuffer(zlib.decompress(row[c]), np.int32) for c in ("base", "check", "accept"))
    vocabularies = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in map(_from_ipc, row["words"])]
    return Trie(list(row["langs"]), vocabularies, row["bits"], base, check, accept)


# ---- windows -----------------------------------------------------------------------------------
#: A row per shard and block: the words of its windows, and the windows and their counts, packed.
DEALT = "block long, lang string, names binary, windows binary, times binary"
DEALT_ARROW = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("names", pa.binary()), ("windows", pa.binary()), ("times", pa.binary())])


def merged(windows: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct row, and how often it comes."""
    code, top = windows[:, 0].astype(np.int64), n_words
    for j in range(1, windows.shape[1]):
        if top > (1 << 62) // (n_words + 1):                        # numbers of what there is take less room
            found, code = np.unique(code, return_inverse=True)
            top = len(found)
        code, top = code * (n_words + 1) + (windows[:, j] + 1), top * (n_words + 1)
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def shard_windows(words: Words, hashes: np.ndarray, longest: int, sieves: list[Sieve]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (rows of word numbers, -1 after their end), their counts and their deals: each word by itself, and each place's
    longest run of ``longest`` words at most whose beginnings all pass the sieves, if that is two words or more."""
    ids, each = words.ids.astype(np.int32), hashes[words.ids]
    often = np.bincount(words.ids, minlength=len(hashes))
    ones = np.flatnonzero(sieves[0].has(keys_of(hashes, np.arange(len(hashes)), 1)) & (often > 0))
    alone = np.full((len(ones), longest), -1, np.int32)
    alone[:, 0] = ones
    if longest == 1:
        return alone, often[ones], deals(hashes, ones, 1)
    reach, found = np.zeros(len(ids), np.int8), None
    for k in range(2, longest + 1):
        found = places, keys = passing(words, hashes, k, sieves, found)
        places = places[sieves[k - 1].has(keys)]
        reach[places[reach[places] == (k - 1 if k > 2 else 0)]] = k
    places = np.flatnonzero(reach)
    many = np.full((len(places), longest), -1, np.int32)
    for j in range(longest):
        inside = reach[places] > j
        many[inside, j] = ids[places[inside] + j]
    first, n = merged(many, len(hashes))
    return (np.concatenate([alone, many[first]]), np.concatenate([often[ones], n]),
            np.concatenate([deals(hashes, ones, 1), deals(each, places[first], 2)]))


def _deal(packed: Sieves, blocks: int, longest: int, shard_bytes: int):
    """One reading of the texts: every shard's windows, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves = packed.unpack()
        for lang, words in shards(batches, shard_bytes):
            windows, n, deal = shard_windows(words, words.hashes(lang), longest, sieves)
            block = deal % blocks
            order = np.argsort(block, kind="stable")
            windows, n, block = windows[order], n[order], block[order]
            cuts = np.flatnonzero(np.diff(block)) + 1
            rows = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if b > a:
                    own, at = np.unique(windows[a:b], return_inverse=True)
                    at = at.reshape(windows[a:b].shape).astype("<i4")
                    if own[0] < 0:
                        own, at = own[1:], at - 1
                    rows.append((int(block[a]), lang, _to_ipc(words.names.take(pa.array(own))), _pack(at.T), _pack(n[a:b].astype("<i4"))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), DEALT_ARROW)], schema=DEALT_ARROW)
    return run


COUNTS = "block long, no long, a long"
COUNTS_ARROW = pa.schema([("block", pa.int64()), ("no", pa.int64()), ("a", pa.int64())])


def _count(longest: int, least: int, held: int):
    """The counts of a block's phrases that reach ``least``. Comes sorted: a block's trie, then its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, trie, n, waiting, size = None, None, None, {}, 0

        def count() -> None:
            for lang, parts in waiting.items():
                first = np.cumsum([0] + [len(w) for w, _, _ in parts])
                windows = np.concatenate([np.where(x >= 0, x + a, -1) for (_, x, _), a in zip(parts, first)])
                trie.count(lang, pa.concat_arrays([w for w, _, _ in parts]), windows, np.concatenate([t for _, _, t in parts]).astype(np.int64), n)
            waiting.clear()

        def counts() -> pa.RecordBatch:
            met = np.flatnonzero(n >= least)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(met), block, np.int64)), pa.array(met), pa.array(n[met])], schema=COUNTS_ARROW)

        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            if row["base"] is not None:
                if trie is not None:
                    count()
                    yield counts()
                block, trie, n, size = row["block"], _trie(row), np.zeros(row["phrases"], np.int64), 0
            elif row["block"] == block:                              # else a block without phrases
                x = np.frombuffer(zlib.decompress(row["windows"]), "<i4").reshape(longest, -1).T
                waiting.setdefault(row["lang"], []).append((_from_ipc(row["names"]), x, np.frombuffer(zlib.decompress(row["times"]), "<i4")))
                size += len(x)
                if size >= held:
                    count()
                    size = 0
        if trie is not None:
            count()
            yield counts()
    return run


# ---- the operator ------------------------------------------------------------------------------
def phrase_counts(texts: DataFrame, longest: int = LONGEST, least: int = LEAST, shard_bytes: int = SHARD_BYTES,
                  block_phrases: int = BLOCK_PHRASES, tries: int = TRIES, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """:func:`_phrase_counts` with small Arrow batches: texts are long, and a batch is held by both sides of a task."""
    conf = texts.sparkSession.conf
    before = conf.get(BATCH_CONF)
    conf.set(BATCH_CONF, str(BATCH_ROWS))
    try:
        return _phrase_counts(texts, longest, least, shard_bytes, block_phrases, tries, range_bytes)
    finally:
        conf.set(BATCH_CONF, before)


def _phrase_counts(texts: DataFrame, longest: int, least: int, shard_bytes: int, block_phrases: int, tries: int,
                   range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all phrases of 1 to ``longest`` words that reach ``least`` and of all words of a language.

    ``texts`` has ``text, lang``. Returns ``lang, k, phrase, a`` and ``lang, n``, both written tables.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part_bits = min(16, max(4, int(size // range_bytes).bit_length()))
    sieves = Sieves()
    named = []
    for k in range(longest + 1):
        read = materialize(texts.mapInArrow(_pass(k, longest, sieves, part_bits, shard_bytes), PASS), f"phrases-pass-{k}")
        if not k:
            totals = materialize(read.where("n_words IS NOT NULL").groupBy("lang").agg(F.sum("n_words").alias("n")), "lang-words")
        else:
            found = read.where("phrase IS NOT NULL").select("lang", "k", "phrase", "deal").distinct()
            named.append(materialize(found, f"phrases-{k}"))
        if k < longest:
            kept = materialize(read.where("part IS NOT NULL").select("part", "at", "n").groupBy("part").applyInPandas(
                _keep(least), "part int, kept binary, many long"), "kept-buckets")
            many = kept.agg(F.sum("many")).first()[0] or 0
            width = min(SIEVE_BITS, max(part_bits + 3, int(KEY_BITS * many).bit_length()))
            wide = 1 << (width - part_bits - 3)
            bits = np.zeros(1 << (width - 3), np.uint8)
            for row in kept.select("part", "kept").mapInPandas(_bits(part_bits, width), "part int, bits binary").toLocalIterator():
                bits[row.part * wide:(row.part + 1) * wide] = np.frombuffer(row.bits, np.uint8)
            sieves.add(spark, bits, width, part_bits)
            discard(kept)
        discard(read)
    phrases = reduce(DataFrame.unionByName, named)
    blocks = max(1, -(-phrases.count() // block_phrases), min(SPREAD_BLOCKS, int(size // BLOCK_BYTES)))
    order = Window.partitionBy("block").orderBy("lang", "phrase")    # a block is bounded
    dealt = materialize(phrases.withColumn("block", F.pmod("deal", F.lit(blocks)))
                        .withColumn("no", (F.row_number().over(order) - 1).cast("long")).drop("deal"), "phrase-blocks")
    built = materialize(dealt.groupBy("block").applyInArrow(_build, TRIE_SCHEMA), "tries")
    windows = texts.mapInArrow(_deal(sieves, blocks, longest, shard_bytes), DEALT)
    met = built.unionByName(windows, allowMissingColumns=True).repartition(max(1, -(-blocks // tries)), "block") \
        .sortWithinPartitions("block", F.col("base").isNull())
    spark.conf.set(BATCH_CONF, str(WINDOW_ROWS))
    counted = materialize(met.mapInArrow(_count(longest, least, HELD_WINDOWS), COUNTS), "phrase-counts")
    spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    result = materialize(dealt.join(counted, ["block", "no"]).select("lang", "k", "phrase", "a"), "counted-phrases")
    for x in (*named, dealt, built, counted):
        discard(x)
    for x in sieves:
        x.destroy()
    return result, totals


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, contained: int = CONTAINED,
                 text_col: str = "text", lang_col: str = "lang", **sizes) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``longest`` words."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted, totals = phrase_counts(texts, longest, least, **sizes)
    return ranked(counted, totals, top, contained)


def ranked(counted: DataFrame, totals: DataFrame, top: int, contained: int) -> DataFrame:
    """Scores, drops contained phrases and ranks the rows of :func:`phrase_counts`."""
    words = F.split("phrase", " ")
    wide = lambda c: F.col(c).cast("decimal(19,0)")                  # noqa: E731
    f = counted.select(F.col("lang").alias("f_lang"), F.col("phrase").alias("f_phrase"), F.col("a").alias("f"))
    held = counted.where("k > 1").withColumn("w", words)
    cuts = held.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ")) \
        .withColumn("right", F.array_join(F.slice("w", F.col("cut") + 1, F.col("k")), " "))
    for side, out in (("left", "l"), ("right", "r")):
        cuts = cuts.join(f, (F.col("lang") == F.col("f_lang")) & (F.col(side) == F.col("f_phrase"))) \
            .withColumnRenamed("f", out).drop("f_lang", "f_phrase")
    cuts = cuts.withColumn("a2", (wide("a") * wide("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")) \
        .withColumn("lr", wide("l") * wide("r")).withColumn("score", F.expr("CAST(a2 div lr AS LONG)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "k")).alias("b")).select("lang", "phrase", "b.*")
    inner = held.where("k > 2").select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))).alias("phrase"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    first = left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
