"""Line dedup (9), DataFrame functions only: exact set-similarity join of lines.

A line (between line feeds) is the set of its words; it is removed if an earlier line (smaller
doc_id, then smaller line number) has a Jaccard similarity of ``4/5`` or more. Judged on the input,
so a line counts as earlier whether or not it stays itself. Lines without words stay.

Equal sets are one row from the start. A set's words are ordered by rarity: their frequency class
(all words of the corpus counted in hash buckets, ``BUCKETS`` at most, so the table that each task gets
is bounded), then longer words first, then by hash. Two sets of that similarity share a word in
their first ``n - ceil(0.8 n) + 1`` words; pairs that meet on such a word pass the length filter, the
positional filter (words before, at and after the shared place) and the parity filter (64 parity
bits of the word hashes, 128 between sets of more than ``LONG`` words, differ in no more places than the
sets may differ). Shuffle files go at the end of each step. Texts that hold a candidate
are fetched again, once; 256 parity bits of each line's words leave few false pairs. These are verified
on the words themselves: per line the ``first_tries`` closest by parity, then, for lines without a
match so far, all others.

Defined cases: null text is empty; a null ``doc_id`` comes after all others; rows repeated with id
and text count as one document, listed each; different texts of one id are ordered by text hash;
an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import SPACE, discard, materialize

BUCKETS = 1 << 22               # of words, counted: a byte each in a task's table
ODD_SPACE = r"[\x09\x0B-\x0D]"   # white space inside a line, but for the blank
LONG = 64                      # words beyond which 64 parity bits tell little
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FIRST_TRIES = 4
LAST = (1 << 63) - 1


def _words(line: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(line, SPACE)), "")


def _split(line: Column) -> Column:
    """The words of a line, and empty ones; lines with blanks alone are split without a pattern."""
    return F.when(line.rlike(ODD_SPACE), F.split(line, SPACE)).otherwise(F.split(line, " "))


def _hash(w: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(w), 6)


def _marked(w: Column) -> Column:
    """63 - length of the word, then 58 bits of hash."""
    return F.shiftleft(F.lit(63).cast("long") - F.least(F.length(w), F.lit(63)), 58).bitwiseOR(_hash(w))


def frequency_classes(docs: DataFrame, text_col: str) -> bytes:
    """One byte per hash bucket: 1 + 4 log2 of its words' count, 127 at most. A power of two of buckets, at least four times as many as words or :data:`BUCKETS`."""
    word = F.explode(_split(F.replace(F.col(text_col), F.lit("\n"), F.lit(" ")))).alias("w")
    bucket = _hash(F.col("w")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")
    level = F.least(F.lit(127), F.floor(4 * F.log2(F.col("count") + 1)) + 1).cast("byte")
    found = docs.select(word).groupBy(bucket).count().select("b", level.alias("c")).toArrow()      # at most BUCKETS rows of 5 bytes
    size = min(BUCKETS, 1 << max(10, (4 * found.num_rows).bit_length()))
    table = np.ones(size, np.uint8)
    np.maximum.at(table, found["b"].to_numpy() & (size - 1), found["c"].to_numpy().astype(np.uint8))
    return table.tobytes()


def _rarity(classes: bytes):
    """Sort key of a :func:`_marked` word as a long: class, 63 - length, 50 bits of hash."""
    def key(h: Column) -> Column:
        at = h.bitwiseAND(F.lit(len(classes) - 1)).cast("int") + 1
        cls = F.ascii(F.substring(F.lit(classes), at, F.lit(1)).cast("string")).cast("long")
        return F.shiftleft(cls, 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    return key


def _keys(line: Column, classes: bytes) -> Column:
    """The sorted keys of a line's words; words are told apart by :func:`_marked`."""
    marked = F.array_distinct(F.transform(_split(line), _marked))
    return F.sort_array(F.transform(F.array_remove(marked, _marked(F.lit(""))), _rarity(classes)))


def _parity(keys: Column) -> Column:
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(keys, F.lit(0).cast("long"), lambda m, k: m.bitwiseXOR(bit(k)))


def _half_parity(keys: Column) -> Column:
    """64 parity bits of the keys whose bit 6 is set: with :func:`_parity`, 128 bits of which each key turns one."""
    bit = lambda k: F.call_function("shiftleft", F.shiftright(k, 6).bitwiseAND(F.lit(1).cast("long")), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(keys, F.lit(0).cast("long"), lambda m, k: m.bitwiseXOR(bit(k)))


def _needed(n: Column, m: Column) -> Column:
    """Shared words that a similarity of 4/5 needs: ``ceil(4/9 (n + m))``."""
    return F.floor((4 * (n + m) + 8) / F.lit(9))


def candidates(sets: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of sets (by ``sid``) that share a word of their prefixes (``keys``), with their parity distance; each pair may come more than once."""
    tokens = sets.select("sid", "n", "parity", "half", F.posexplode("keys").alias("pos", "tok"))
    columns = ("tok", "sid", "n", "parity", "half", "pos")
    a, b = (tokens.select(*[F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "ab")     # of one form: one exchange serves both
    n, m, i, j = (F.col(c) for c in ("a_n", "b_n", "a_pos", "b_pos"))
    lengths = (5 * F.least(n, m) >= 4 * F.greatest(n, m))
    positions = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1) >= _needed(n, m)
    all_ = F.col("a_parity").bitwiseXOR(F.col("b_parity"))
    one = F.col("a_half").bitwiseXOR(F.col("b_half"))                # keys with bit 6; the others are what is left of all
    apart = F.when(F.least(n, m) > LONG, F.bit_count(one) + F.bit_count(all_.bitwiseXOR(one))).otherwise(F.bit_count(all_))
    near = apart <= n + m - 2 * _needed(n, m)
    return a.join(b, (F.col("a_tok") == F.col("b_tok")) & (F.col("a_sid") < F.col("b_sid")) & lengths & positions & near).select(
        F.col("a_sid").alias("a"), F.col("b_sid").alias("b"), apart.alias("apart"))


def _marks(words: Column) -> Column:
    """Number of words and 256 parity bits of their hashes."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    lane = lambda i: F.filter(hashes, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(3)) == i)
    return F.struct(F.size(words).alias("n"), *[_parity(lane(i)).alias(f"p{i}") for i in range(4)])


def line_words(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``sid, place, words, marks`` of every set that is in a pair, written once (``place``: where it stands first)."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("q")).distinct()
    places = sets.join(asked, F.col("sid") == F.col("q")).groupBy("rank_id", "th").agg(
        F.collect_list(F.struct("sid", "line_no")).alias("asked")).select(       # lines of one text
        F.col("rank_id").alias("r"), F.col("th").alias("t"), "asked")
    held = texts.join(places, (F.col("rank_id") == F.col("r")) & (F.col("th") == F.col("t"))).groupBy("rank_id", "th").agg(
        F.first("text").alias("text"), F.first("asked").alias("asked"))          # dealt by the join already
    one = held.select("rank_id", F.split("text", "\n").alias("lines"), F.explode("asked").alias("q")).select(
        F.col("q.sid").alias("sid"), F.struct("rank_id", "q.line_no", "q.sid").alias("place"), _words(F.element_at("lines", F.col("q.line_no") + 1)).alias("words"))
    return materialize(one.select("sid", "place", "words", _marks(F.col("words")).alias("marks")), "line-words")


def close_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``a, b, apart`` (b later) of the pairs whose 256 parity bits differ in no more places than the sets may differ."""
    mine = words.select(F.col("sid").alias("b"), F.col("marks").alias("mb"), F.col("place").alias("pb"))
    theirs = words.select(F.col("sid").alias("a"), F.col("marks").alias("ma"), F.col("place").alias("pa"))
    side = lambda first, last: F.when(F.col("pa") < F.col("pb"), F.col(first)).otherwise(F.col(last))
    n, m = F.col("ma.n"), F.col("mb.n")
    apart = sum((F.bit_count(F.col(f"ma.p{i}").bitwiseXOR(F.col(f"mb.p{i}"))) for i in range(4)), F.lit(0))
    return pairs.select("a", "b").join(mine, "b").join(theirs, "a").where(apart <= n + m - 2 * _needed(n, m)).select(
        side("a", "b").alias("a"), side("b", "a").alias("b"), apart.alias("apart"))


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``b`` of the pairs whose words reach the similarity."""
    mine = words.select(F.col("sid").alias("b"), F.col("words").alias("wb"))
    theirs = words.select(F.col("sid").alias("a"), F.col("words").alias("wa"))
    both = pairs.select("a", "b").join(mine, "b").join(theirs, "a")
    shared = F.size(F.array_intersect("wa", "wb"))
    return both.where(5 * shared >= 4 * (F.size("wa") + F.size("wb") - shared)).select("b").distinct()


def _rewritten(new: DataFrame, old: DataFrame, label: str) -> DataFrame:
    """The rows of ``new``, written; the files of ``old`` (a written table) go."""
    new = materialize(new, label)
    discard(old)
    return new


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_tries: int = FIRST_TRIES) -> DataFrame:
    """:func:`_line_verdicts` whose steps leave no shuffle files behind: each writes its rows, and no later one reads them from a shuffle."""
    conf = docs.sparkSession.conf
    before = conf.get(CLEANUP_CONF, "false")
    conf.set(CLEANUP_CONF, "true")
    try:
        return _line_verdicts(docs, id_col, text_col, first_tries)
    finally:
        conf.set(CLEANUP_CONF, before)


def _line_verdicts(docs: DataFrame, id_col: str, text_col: str, first_tries: int) -> DataFrame:
    """``rank_id, th, line_no, removed`` of every line (``rank_id``: doc_id, null last; ``th``: text hash)."""
    doc = F.col(id_col).cast("long")
    texts = docs.select(F.coalesce(doc, F.lit(LAST)).alias("rank_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("th", F.xxhash64("text"))
    keys = _keys(F.col("line"), frequency_classes(docs, text_col))
    lines = texts.select("rank_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).select(
        "rank_id", "th", "line_no", keys.alias("keys")).withColumns({
            "n": F.size("keys"), "parity": _parity(F.col("keys")), "half": F.when(F.size("keys") > LONG, _half_parity(F.col("keys"))).otherwise(F.lit(0).cast("long")), "sh": F.xxhash64("keys")})
    prefix = F.slice("keys", 1, F.expr("int(n - (4L * n + 4) div 5 + 1)"))
    lines = materialize(lines.withColumn("keys", prefix), "lines")
    first = F.min(F.struct("rank_id", "line_no", "th")).alias("f")
    sets = materialize(lines.where("n > 0").groupBy("sh", "n", "parity").agg(first, F.first("half").alias("half"), F.first("keys").alias("keys")).select(
        F.monotonically_increasing_id().alias("sid"), "sh", "n", "parity", "half", "f.rank_id", "f.line_no", "f.th", "keys"), "sets")
    lines = _rewritten(lines.drop("keys", "half"), lines, "lines")               # the prefixes are held by the sets alone
    pairs = materialize(candidates(sets).select("a", "b").distinct(), "pairs")
    words = line_words(pairs, sets, texts)
    pairs = _rewritten(close_pairs(pairs, words), pairs, "close-pairs")
    nth = F.row_number().over(Window.partitionBy("b").orderBy("apart", "a"))
    tried = pairs.withColumn("nth", nth)
    found = materialize(_verified(tried.where(F.col("nth") <= first_tries), words), "matched")
    rest = materialize(tried.where(F.col("nth") > first_tries).select("a", "b").join(found, "b", "left_anti"), "open-pairs")
    if not rest.isEmpty():
        found = found.unionByName(_verified(rest, words)).distinct()
    judged = sets.join(found, F.col("sid") == F.col("b"), "left").select(
        F.col("sh").alias("s"), F.col("n").alias("sn"), F.col("parity").alias("sp"), F.col("rank_id").alias("fr"),
        F.col("line_no").alias("fl"), F.col("th").alias("ft"), F.col("b").isNotNull().alias("matched"))
    own = (F.col("rank_id") == F.col("fr")) & (F.col("line_no") == F.col("fl")) & (F.col("th") == F.col("ft"))
    return lines.select("rank_id", "th", "line_no", "sh", "n", "parity").join(
        judged, (F.col("sh") == F.col("s")) & (F.col("n") == F.col("sn")) & (F.col("parity") == F.col("sp")), "left").select(
        "rank_id", "th", "line_no", F.coalesce(F.col("matched") | ~own, F.lit(False)).alias("removed"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed_lines`` (line numbers from 0, comma-joined) per document."""
    doc = F.col(id_col).cast("long")
    per = line_verdicts(docs, id_col, text_col, **options).distinct().groupBy("rank_id", "th").agg(
        F.count("*").alias("n_lines"), F.count_if("removed").alias("n_removed"),
        F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line_no")))).alias("gone")).select(
        F.col("rank_id").alias("r"), F.col("th").alias("t"), "n_lines", "n_removed",
        F.array_join(F.transform("gone", lambda x: x.cast("string")), ",").alias("removed_lines"))
    rows = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(LAST)).alias("rank_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"))
    return rows.join(per, (F.col("rank_id") == F.col("r")) & (F.col("th") == F.col("t"))).select(
        "doc_id", "n_lines", "n_removed", "removed_lines")


def kept_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, kept_text``: every document without its removed lines."""
    doc, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    gone = line_verdicts(docs, id_col, text_col, **options).where("removed").groupBy("rank_id", "th").agg(
        F.collect_set("line_no").alias("gone")).select(F.col("rank_id").alias("r"), F.col("th").alias("t"), "gone")
    rows = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(LAST)).alias("rank_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    joined = rows.join(gone, (F.col("rank_id") == F.col("r")) & (F.col("th") == F.col("t")), "left")
    stays = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return joined.select("doc_id", F.array_join(stays, "\n").alias("kept_text"))
