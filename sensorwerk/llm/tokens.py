"""Whole-text encoding with the tokenizers library, and the ranked-id shard format (4).

:class:`TextEncoder` returns what ``encode`` of a whole text returns. Texts are cut where the
tokenizer's own splitter always cuts (a single space between two visible characters; a single
line feed before a word), and each distinct piece is encoded once and kept in a bounded cache.

Shard format (one row, one ``blob``): little-endian. ``RNK1``, n_docs u32, n_ids u64, n_ranks
u32, n_data u64; doc ids i64 and a null mask u8 per document, ids per document u64; the shard's
distinct ids u32 by falling frequency (ties: smaller id); control bytes, four 2-bit codes each
(code c: c + 1 data bytes); data bytes, the low bytes of each id's rank. Decoding looks the four
lengths of a control byte up in a table of 256 rows. Shards carry their own ranks, so each can
be read alone and a lost task rewrites only its own.

Defined cases: null and empty texts have the end id alone; null doc_ids come first in the file; rows of
one id follow each other by text; texts of any length are encoded whole; strings of the tokenizer's
special tokens get their ids, as the plain call gives them; an empty table gives no shard and an empty
result; other columns are not read.
"""
from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.llm.common import materialize

CACHE_WORDS = 400_000          # words in each of the two cache generations of a Python worker
SHARD_IDS = 1 << 20            # a shard is closed at the first document end past so many ids
GATHERED = 1 << 17             # pieces whose ids are put together at once
JOINED = 64                    # new words encoded in one call
MAGIC = b"RNK1"

MARKS = string.punctuation.replace("'", "")                # an apostrophe can start a contraction
_LATIN = "[A-Za-zÀ-ÖØ-öø-ɏ]+"                              # letters to every version of the character tables
_SPACE_RUN = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ENCODERS: dict[tuple[str, bool], "TextEncoder"] = {}


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


class TextEncoder:
    """``keeps_space``: the tokenizer joins a space to the word after it (byte-level), rather
    than dropping white space. ``word_edge``: tokens that start (or end) a word of letters."""

    def __init__(self, path: str, keeps_space: bool, cache_words: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.cache_words = cache_words or CACHE_WORDS
        # a text that may hold a special token's string is encoded whole: the library gives it its own id
        added = list(self.tok.get_added_tokens_decoder().values())
        self.marks, self.folded = {t.content[:2] for t in added}, {t.content[:2].lower() for t in added if t.normalized}
        vocab = self.tok.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.edge[i] = token.startswith("Ġ") if keeps_space else token.endswith("</w>")
        self.dtype = "<u2" if len(self.edge) <= 1 << 16 else "<u4"
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.line_feed = self._plain("\n")

    def _plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        for c in range(0, len(words), 1024):
            for e in self.tok.encode_batch_fast(words[c:c + 1024], add_special_tokens=False):
                yield np.array(e.ids, self.dtype).tobytes()

    def _stems(self, words: list[str]) -> dict[str, bytes]:
        """Words of Latin letters: encoded many at a time and parted at their edge tokens."""
        out: dict[str, bytes] = {}
        lead, alone = int(self.keeps_space), []
        chunks = [words[c:c + JOINED] for c in range(0, len(words), JOINED)]
        for c in range(0, len(chunks), 32):
            part = chunks[c:c + 32]
            texts = ["".join(x) if lead else " ".join(x) for x in part]
            for some, e in zip(part, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, self.dtype)
                at = np.flatnonzero(self.edge[ids])
                bounds = (np.append(at, len(ids)) if lead else np.append(0, at + 1)) * ids.itemsize
                if len(bounds) != len(some) + 1:               # not one edge a word: take them one by one
                    alone += some
                    continue
                raw, ends = ids.tobytes(), bounds.tolist()
                out.update(zip(some, [raw[a:b] for a, b in zip(ends, ends[1:])]))
        out.update(zip(alone, self._encoded(alone)))
        return out

    def _learn(self, keys: list[str]) -> list[bytes]:
        """Keys start with a space where the tokenizer keeps it and the piece follows one.

        Marks after a word of Latin letters are a token run of their own, so the word and its marks
        are encoded apart, each once."""
        young = self.young
        words = pa.array(keys, pa.large_string())
        bases = pc.utf8_rtrim(words, MARKS)
        latin = pc.match_substring_regex(bases, rf"\A{' ' * self.keeps_space}{_LATIN}\z")
        at = latin.to_numpy(zero_copy_only=False)
        stems = bases.filter(latin).dictionary_encode()
        names = _strings(stems.dictionary)
        new = [w for w in names if w not in young]
        young.update(self._stems(new))
        out = np.empty(len(keys), object)
        out[at] = np.array([young[w] for w in names], object)[stems.indices.to_numpy()]
        general = [keys[i] for i in np.flatnonzero(~at)]
        out[~at] = list(self._encoded(general))
        sizes = pc.utf8_length(bases).to_numpy()
        marked = np.flatnonzero(at & (sizes < pc.utf8_length(words).to_numpy())).tolist()
        marks = [keys[i][n:] for i, n in zip(marked, sizes[marked].tolist())]
        runs = list(set(marks))
        ids = dict(zip(runs, self._encoded(runs)))
        for i, run in zip(marked, marks):
            out[i] += ids[run]
        young.update(zip(keys, out))
        return out.tolist()

    def _units(self, text: str) -> str:
        """The text's pieces, parted by zeros."""
        if not self.keeps_space:
            return text.replace("\n", "\x00").replace(" ", "\x00")
        # only blanks and line feeds part words here: other white space is not printable
        if text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text \
                or "\n\n" in text or not text.replace("\n", "").isprintable() and _SPACE_RUN.search(text):
            return _LONE_SPACE.sub("\x00 ", text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")     # each word keeps the space before it

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, as little-endian bytes of ``dtype``.

        The pieces of all the texts are told apart first, so each distinct one is looked up once a call."""
        whole = {i: self._plain(t) for i, t in enumerate(texts) if t and self._is_whole(t)}
        units = pc.split_pattern(pa.array(["" if not t or i in whole else self._units(t) for i, t in enumerate(texts)],
                                          pa.large_string()), "\x00")
        pieces = units.flatten().dictionary_encode()
        keys = _strings(pieces.dictionary)
        young, old = self.young, self.old
        if len(young) > self.cache_words:
            self.old = old = young
            self.young = young = {}
        young[""], young["\n"] = b"", self.line_feed if self.keeps_space else b""
        known = list(map(young.get, keys))
        holes = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(holes, [old.get(keys[i]) for i in holes]):
            if ids is not None:
                known[i] = young[keys[i]] = ids
        holes = [i for i in holes if known[i] is None]
        for i, ids in zip(holes, self._learn([keys[i] for i in holes])):
            known[i] = ids
        bank = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // bank.itemsize
        at, offsets = pieces.indices.to_numpy(), units.offsets.to_numpy()
        first = np.cumsum(sizes) - sizes
        out: list[bytes] = []
        a = 0
        while a < len(texts):                                  # some texts at a time: an id's place takes eight bytes, thrice
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + GATHERED, side="right")) - 1)
            part = at[offsets[a]:offsets[b]]
            n = sizes[part]
            ends = np.append(0, np.cumsum(n))
            raw = bank[np.repeat(first[part] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
            cuts = (ends[offsets[a:b + 1] - offsets[a]] * bank.itemsize).tolist()
            out += [raw[c:d] for c, d in zip(cuts, cuts[1:])]
            a = b
        for i, ids in whole.items():
            out[i] = ids
        return out

    def _is_whole(self, text: str) -> bool:
        if "\x00" in text or any(m in text for m in self.marks):
            return True
        return bool(self.folded) and any(m in text.lower() for m in self.folded)


def encoder(path: str, keeps_space: bool, cache_words: int | None = None) -> TextEncoder:
    """One per Python worker, so its cache serves all tasks of the worker."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, keeps_space, cache_words)
    return _ENCODERS[key]


def in_slices(texts: pd.Series, chars: int = 1 << 23) -> Iterator[tuple[int, list[str]]]:
    """Runs of about ``chars`` characters, so that a batch of long texts stays small in memory."""
    part, start, size = [], 0, 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= chars:
            yield start, part
            part, start, size = [], i + 1, 0
    if part:
        yield start, part


# ---- the shard format --------------------------------------------------------------------------
_LENGTHS = np.array([[((c >> (2 * j)) & 3) + 1 for j in range(4)] for c in range(256)], np.uint8)


def pack_shard(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
    counts = np.bincount(flat)
    ranked = np.lexsort((np.arange(len(counts)), -counts))[:int((counts > 0).sum())]
    rank = np.zeros(len(counts), "<u4")
    rank[ranked] = np.arange(len(ranked))
    r = rank[flat]
    code = (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[:len(r)] = code
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([MAGIC, struct.pack("<IQIQ", len(doc_ids), len(flat), len(ranked), len(data)),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
                     np.array([len(x) for x in ids], "<u8").tobytes(), ranked.astype("<u4").tobytes(),
                     control.tobytes(), data.tobytes()])


def unpack_shard(blob: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Doc ids, ids per document and all ids (uint32) of a shard."""
    if blob[:4] != MAGIC:
        raise ValueError("not a shard")
    n_docs, n_ids, n_ranks, n_data = struct.unpack_from("<IQIQ", blob, 4)
    at = 4 + struct.calcsize("<IQIQ")

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, n, at)
        at += out.nbytes
        return out

    doc, null, sizes, ranked = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs), take("<u4", n_ranks)
    control, data = take("u1", -(-n_ids // 4)), take("u1", n_data)
    length = _LENGTHS[control].ravel()[:n_ids].astype(np.int64)
    begin = np.cumsum(length) - length
    rank = np.zeros(n_ids, np.uint32)
    for j in range(int(length.max()) if n_ids else 0):
        has = np.flatnonzero(length > j)
        rank[has] |= data[begin[has] + j].astype(np.uint32) << np.uint32(8 * j)
    return [None if z else int(d) for d, z in zip(doc, null)], sizes.astype(np.int64), ranked[rank]


SHARD_SCHEMA = "part int, seq int, part_start long, n_docs long, n_ids long, blob binary"


def _write(path: str, keeps_space: bool, end_id: int, shard_ids: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(path, keeps_space)
        docs, ids, size, start, seq = [], [], 0, 0, 0
        tail = np.array([end_id], enc.dtype).tobytes()

        def shard():
            return pd.DataFrame([{"part": part, "seq": seq, "part_start": start, "n_docs": len(docs), "n_ids": size,
                                  "blob": pack_shard(docs, [np.frombuffer(x, enc.dtype) for x in ids])}])

        for pdf in batches:
            doc_ids = [None if pd.isna(d) else int(d) for d in pdf.doc_id]
            for first, texts in in_slices(pdf.text):
                for k, got in enumerate(enc.encode(texts)):
                    docs.append(doc_ids[first + k])
                    ids.append(got + tail)
                    size += len(ids[-1]) // len(tail)
                    if size >= shard_ids:
                        yield shard()
                        docs, ids, size, start, seq = [], [], 0, start + size, seq + 1
        if docs:
            yield shard()
    return run


def write_shards(docs: DataFrame, path: str, keeps_space: bool = True, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes every document and writes the shards in ascending id order (null ids first).

    Ranges of ids are sorted apart; ``part`` follows the ranges, so (part, seq) is the file order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ranged.mapInPandas(_write(path, keeps_space, end_id, shard_ids), SHARD_SCHEMA), "shards")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for blob, base in zip(pdf.blob, pdf.base):
            doc_ids, sizes, ids = unpack_shard(bytes(blob))
            ends = np.cumsum(sizes)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": base + ends - sizes,
                                "n_tokens": sizes, "ids_crc32": np.array(crc, np.int64)})


def read_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards."""
    total, base = 0, {}
    for part, n in sorted(map(tuple, shards.groupBy("part").agg(F.sum("n_ids")).collect())):   # a row per partition
        base[part] = total
        total += n
    spark = shards.sparkSession      # two numbers per partition of the written file: broadcast
    starts = spark.createDataFrame(list(base.items()), "p int, before long")
    based = shards.join(F.broadcast(starts), shards.part == starts.p).select("blob", (F.col("part_start") + F.col("before")).alias("base"))
    return based.mapInPandas(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
