"""Exact, SimHash, substring and line dedup against plain Python."""
import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from sensorwerk.llm import exact_dedup, line_dedup, simhash, substring_dedup
from tests.llm.conftest import corpus

LAST = 1 << 63


def rank(d):
    return LAST if d is None else d


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


# ---- exact ------------------------------------------------------------------------------------
def norm_sha(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def test_exact_dedup_matches_brute_force(docs):
    groups = defaultdict(list)
    for r in corpus():
        groups[norm_sha(r[1])].append(r[0])
    want = []
    for r in corpus():
        ids = groups[norm_sha(r[1])]
        want.append((r[0], min((i for i in ids if i is not None), default=None), len(ids), norm_sha(r[1])))
    got = exact_dedup.exact_dedup(docs)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    kept = [r for r in got.collect() if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)     # one row of each group, repeats too


def test_exact_dedup_empty(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_buckets_follow_the_larger_side(spark, monkeypatch):
    rows = spark.createDataFrame([(None, f"text {i}") for i in range(500)], "doc_id long, text string")      # no history at all
    seen = []
    plain = exact_dedup.bucket_of
    monkeypatch.setattr(exact_dedup, "bucket_of", lambda c, n: (seen.append(n), plain(c, n))[1])
    assert exact_dedup.verdicts(exact_dedup.digests_of(rows), keys_per_bucket=50).count() == 500
    assert set(seen) == {10}


@pytest.mark.parametrize("n", [1, 2, 63, 1000, 20_000])
def test_mph_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 256, (n, 32), dtype=np.uint8)
    sizes, bits = exact_dedup.build_mph(keys)
    assert sorted(exact_dedup.lookup_mph(sizes, bits, keys)) == list(range(n))


def test_mph_nonmembers_are_told_by_their_bytes(spark):
    import pandas as pd

    keys = np.random.default_rng(1).integers(0, 256, (500, 32), dtype=np.uint8)
    frame = lambda k, ids: pd.DataFrame({"digest": [x.tobytes() for x in k], "id": ids, "no_id": 0, "rid": ids, "copies": 1})
    index = exact_dedup._build((0,), frame(keys[:300], np.arange(300)))
    out = exact_dedup._lookup(frame(keys[200:], np.arange(1000, 1300)), index)
    assert len(out) == 500                                          # no nonmember merged into a slot
    by = dict(zip(out.digest, zip(out.id, out.copies)))
    assert all(by[keys[i].tobytes()] == (i, 2 if i >= 200 else 1) for i in range(300))
    assert all(by[keys[i].tobytes()] == (800 + i, 1) for i in range(300, 500))


# ---- SimHash ----------------------------------------------------------------------------------
def slow_print(t, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, radius=2):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def expected_components(ids, prints):
    roots = slow_components(prints)
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(least.get(r, LAST), rank(i))
    return [None if least[r] == LAST else least[r] for r in roots]


@pytest.mark.parametrize("bucket_rows", [8192, 2])
def test_simhash_matches_brute_force(docs, bucket_rows):
    rows = corpus()
    prints = [slow_print(r[1]) for r in rows]
    comps = expected_components([r[0] for r in rows], prints)
    got = simhash.simhash_dedup(docs, bucket_rows=bucket_rows)
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, comps)]
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert sum(r.kept for r in got.collect()) == len(set(slow_components(prints)))


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("bucket_rows", [8192, 3])
def test_links_give_the_components_of_all_pairs(spark, radius, bucket_rows):
    rng = np.random.default_rng(7)
    seeds = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(s) for s in seeds} | {(1 << 64) - 1, 0}
    for s in seeds:                                                  # chains and clouds of near prints
        x = int(s)
        for _ in range(40):
            x ^= 1 << int(rng.integers(64))
            if rng.random() < 0.5:
                x ^= 1 << int(rng.integers(64))
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    prints = spark.createDataFrame([(i, i, s) for i, s in enumerate(signed)], "rid long, doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(prints, radius, bucket_rows).collect()}
    roots = slow_components(fps, radius)
    assert [got[s] for s in signed] == roots


def test_bit_sliced_comparison_counts_exactly():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps[100:200] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    planes = simhash.bit_planes(fps)
    for radius in (0, 1, 2):
        for lag in (1, 63, 64, 100, 250):
            n = len(fps) - lag
            want = [i for i in range(n) if bin(int(fps[i]) ^ int(fps[i + lag])).count("1") <= radius]
            assert simhash.within(planes, lag, n, radius).tolist() == want


def test_simhash_empty(no_docs):
    assert simhash.simhash_dedup(no_docs).count() == 0


# ---- substrings -------------------------------------------------------------------------------
def slow_substrings(rows, k=50):
    first = {}
    docs = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    for d, w in docs:
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, LAST), rank(d))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < rank(d):
                gone.update(range(i, i + k))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("subtree_rows", [4096, 1])
def test_substring_dedup_matches_brute_force(docs, subtree_rows):
    got = substring_dedup.deduplicate(docs, subtree_rows=subtree_rows)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == slow_substrings(corpus())


@pytest.mark.parametrize("subtree_rows", [4096, 2])
def test_substring_dedup_overlapping_passages(spark, subtree_rows):
    from tests.llm.conftest import prose
    import random

    rnd = random.Random(5)
    pool = prose(11, 400).split()
    rows = []
    for d in range(40):
        parts = []
        for _ in range(3):
            a = rnd.randrange(0, 300)
            parts += pool[a:a + rnd.randrange(20, 110)] + prose(1000 + d, rnd.randrange(0, 12)).split()
        rows.append((d, " ".join(parts)))
    rows += [(50, "z " * 130), (51, "z " * 60), (52, "z y " * 70)]
    got = substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), subtree_rows=subtree_rows)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == slow_substrings(rows)


def test_substring_dedup_empty(no_docs):
    assert substring_dedup.deduplicate(no_docs).count() == 0


# ---- lines ------------------------------------------------------------------------------------
def slow_lines(rows):
    """Repeated rows are one document; ids with several texts are not in the fixture."""
    lines = []
    for d, t in {(r[0], r[1] or "") for r in rows}:
        for k, line in enumerate(t.split("\n")):
            lines.append((rank(d), d, t, k, frozenset(re.findall(r"[^\x20\x09-\x0D]+", line))))
    gone = defaultdict(list)
    for r, d, t, k, s in lines:
        if s and any((r2, k2) < (r, k) and s2 and 5 * len(s & s2) >= 4 * len(s | s2) for r2, _, _, k2, s2 in lines):
            gone[(d, t)].append(k)
    out = []
    for row in rows:
        g = sorted(gone[(row[0], row[1] or "")])
        out.append((row[0], len((row[1] or "").split("\n")), len(g), ",".join(map(str, g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("first_tries", [4, 1, 0])
def test_line_dedup_matches_brute_force(spark, docs, first_tries):
    rows = [r for r in corpus() if r[0] is not None or r[1]]
    rows += [(200 + i, "one two three four five six seven eight nine " + x, None, None, 0, "", 0, "")
             for i, x in enumerate(["ten", "ten eleven", "eleven", "ten twelve thirteen", "ten", "a\nb\nb"])]
    from tests.llm.conftest import DOC_SCHEMA

    got = line_dedup.deduplicate(spark.createDataFrame(rows, DOC_SCHEMA), first_tries=first_tries)
    assert rows_of(got, "doc_id", "n_lines", "n_removed", "removed_lines") == slow_lines(rows)


def test_line_dedup_plan_is_native(docs):
    text = line_dedup.deduplicate(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_line_dedup_verifies_few_false_pairs(spark, monkeypatch):
    from tests.llm.conftest import DOC_SCHEMA

    rng = random.Random(3)
    new = lambda n: [f"w{rng.randrange(1 << 60):x}" for _ in range(n)]
    rows = []
    for k in range(300):                                  # six words of 40 differ on both sides: 34 / 46 is below 0.8
        words = new(40)
        rows += [(2 * k, " ".join(words), *[None] * 6), (2 * k + 1, " ".join(words[:34] + new(6)), *[None] * 6)]
    found, asked, tried = [], line_dedup.candidates, line_dedup._verified
    met = []
    monkeypatch.setattr(line_dedup, "candidates", lambda *a: met.append(asked(*a)) or met[0])
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *a: found.append(pairs.count()) or tried(pairs, *a))
    got = line_dedup.deduplicate(spark.createDataFrame(rows, DOC_SCHEMA)).collect()
    assert len(got) == 600 and not any(r.n_removed for r in got)
    pairs = met[0].select("a", "b").distinct().count()
    assert pairs >= 10 and 2 * sum(found) <= pairs


def test_line_dedup_keeps_prefixes_no_longer_than_needed(spark, monkeypatch):
    """The candidate join carries a set's number, not its place; once the sets are written, only they hold prefixes."""
    asked, write, joined, written = line_dedup.candidates, line_dedup.materialize, [], []
    monkeypatch.setattr(line_dedup, "candidates", lambda *a: joined.append(asked(*a)) or joined[0])
    monkeypatch.setattr(line_dedup, "materialize", lambda df, label: written.append((label, write(df, label))) or written[-1][1])
    line = "one two three four five six seven eight nine ten"
    rows = [(9, line), (3, line + " eleven\n" + line), (5, "x\n" + line + " twelve"), (None, line), (4, "y z")]
    got = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 99, r.removed_lines) for r in got.collect()) == [(3, "1"), (4, ""), (5, "1"), (9, "0"), (99, "0")]
    plan = joined[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "rank_id" not in plan.split("Relation")[0] and "line_no" not in plan.split("Relation")[0]
    left = [(label, df.columns) for label, df in written if any(os.path.exists(f.removeprefix("file://")) for f in df.inputFiles())]
    assert {label for label, _ in left} >= {"lines", "sets"} and {label for label, columns in left if "keys" in columns} == {"sets"}


def test_line_dedup_joins_few_false_pairs_of_long_lines(spark, monkeypatch):
    """Two lines of 150 words share 75 rare ones, the others are common; one line comes again with ten other words."""
    rng = random.Random(7)
    new = lambda n: [f"w{rng.randrange(1 << 60):x}" for _ in range(n)]
    rows, common = [], new(400)
    for k in range(100):
        words, other = ([*rng.sample(common, 75), *x] for x in [new(75)] * 2)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    rows.append((500, " ".join(words[:140] + new(10))))
    met, asked = [], line_dedup.candidates
    monkeypatch.setattr(line_dedup, "candidates", lambda *a: met.append(asked(*a)) or met[0])
    before = spark.conf.get(line_dedup.CLEANUP_CONF)
    got = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if r.n_removed] == [500] and len(got) == 201
    assert met[0].select("a", "b").distinct().count() <= 10
    assert spark.conf.get(line_dedup.CLEANUP_CONF) == before


def test_line_dedup_orders_rare_words_first(spark):
    """40,000 words come once and 500 twenty times: nearly all of those are told apart by their class."""
    rng = random.Random(8)
    rare, often = ([f"w{rng.randrange(1 << 60):x}" for _ in range(n)] for n in (40_000, 500))
    lines = [" ".join(rare[i::40] + often) for i in range(20)] + [" ".join(rare[i::40]) for i in range(20, 40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    table = line_dedup.frequency_classes(docs, "text")
    counted = [table[(xxhash.xxh64_intdigest(w, 42) >> 6) & (len(table) - 1)] for w in rare[:5000]]
    assert sum(c == 5 for c in counted) >= 3500                  # alone in their buckets: 1 + 4 log2 2


def test_line_dedup_kept_texts(spark):
    df = spark.createDataFrame([(1, "a b c\nd e f\n\na b c"), (2, "d e f\ng h i"), (3, None)], "doc_id long, text string")
    assert rows_of(line_dedup.kept_texts(df), "doc_id", "kept_text") == [(1, "a b c\nd e f\n"), (2, "g h i"), (3, "")]


def test_line_dedup_empty(no_docs):
    assert line_dedup.deduplicate(no_docs).count() == 0


def test_substring_many_repeated_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(90))
    rows = [(None, text)] * 4000 + [(3, "x " + text), (5, text + " y"), (7, "z " * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substring_dedup.deduplicate(df).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r["count"]) for r in got), key=repr) == sorted(
        [(None, 90, 90, 4000), (3, 91, 0, 1), (5, 91, 90, 1), (7, 10, 0, 1)], key=repr)
