"""Hard negatives, decontamination and collocations against plain Python."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorwerk.llm import collocations, decontaminate, hard_negatives
from tests.llm.conftest import corpus, prose


# ---- hard negatives ---------------------------------------------------------------------------
def slow_negatives(rows, k=5, every=100):
    ok = []
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        ok.append((i, q, (lab + 1) % 10 if i % 7 == 0 else lab))
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for n, (i, q, lab) in enumerate(ok):
        if i % every:
            continue
        s = [(clip(sum(a * b for a, b in zip(q, w))), j, other, m) for m, (j, w, other) in enumerate(ok) if m != n and len(w) == len(q)]
        s.sort(key=lambda x: (-x[0], x[1], x[3]))
        for score, j, _, _ in [x for x in s if x[2] == lab][:k]:
            neg = [x for x in s if x[2] != lab and 80 * score <= 100 * x[0] <= 100 * score][:k]
            out += [(i, j, r + 1, x[1], score, x[0]) for r, x in enumerate(neg)]
    return sorted(out)


def vectors(seed):
    rng = np.random.default_rng(seed)
    near = rng.normal(0, 0.3, 6)
    rows = [(i, (near + rng.normal(0, 0.1, 6) if i % 3 else rng.normal(0, 0.4, 6)).tolist(), int(rng.integers(0, 4))) for i in range(420)]
    rows += [(1000 + i, rows[i % 2][1], i % 3) for i in range(60)]                   # ties
    rows += [(600, [0.0] * 6, 1), (2000, [0.5, -0.25], 1), (2001, [0.5, -0.25], 1), (2002, [0.5, -0.3], 2), (2100, [], 1), (2101, [], 2),
             (2102, [], 1), (700, None, 1), (701, [0.1] * 6, None), (702, [float("nan")] * 6, 2), (703, [None] * 6, 2),
             (704, [float("inf")] * 6, 2), (None, [0.3] * 6, 1), (2300, [1e9] * 6, 1), (2301, [9e8] * 6, 1), (2302, [8e8] * 6, 2)]
    return rows


@pytest.mark.parametrize("blocks", [(512, 16_384), (2, 37)])
def test_hard_negatives_match_brute_force(spark, blocks):
    rows = vectors(3)
    rows.append((100, rows[100][1], 2))                                              # a repeated anchor id
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rank string, rid int, score int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label, anchor_block=blocks[0], row_block=blocks[1])
    want = slow_negatives(rows)
    assert len(want) > 100
    assert sorted(map(tuple, got.collect())) == want


def test_hard_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df, F.col("vec_id") % 100 == 0, F.col("label")).count() == 0


def test_threshold_stops_before_the_end_and_not_on_a_tie():
    rng = np.random.default_rng(0)
    rows = rng.integers(-50, 50, (5000, 4))
    rows[:20] = 400                                                                  # ties at the top
    lists = hard_negatives.Lists(rows, np.arange(5000)[::-1].copy(), np.arange(5000))
    anchor = np.array([9, 7, 8, 9])
    (held,), depth = lists.best(anchor, np.ones(5000, bool), [(hard_negatives.LEAST, hard_negatives.MOST)], 5)
    assert depth < 2500 and held[1].tolist() == [19, 18, 17, 16, 15]                 # smallest ids of all that tie


# ---- decontamination --------------------------------------------------------------------------
def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def slow_contamination(texts, items, window=10):
    phrases = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases[tuple(w[k:k + window])].add(i or "")
    out = []
    for t in texts:
        w, hit, named = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k:k + n])) in phrases:
                    hit.update(range(k, k + n))
                    named |= phrases[p]
        out.append((len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return out


def bench_items():
    rows = corpus()
    items = [(f"i{k}", " ".join(words(rows[k][1])[5:5 + n])) for k, n in enumerate([3, 10, 12, 25, 40, 9, 11])]
    return items + [("i1", prose(99, 70)), (None, rows[8][1][20:200]), ("e", ""), ("n", None), ("far", "never met anywhere at all"),
                    ("10", words(rows[9][1])[0].upper())]


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 40}, {"shard_words": 300, "block_words": 60}])
def test_contamination_matches_brute_force(spark, docs, sizes):
    rows, items = corpus(), bench_items()
    bench = spark.createDataFrame([(*x, "clash", 3) for x in items], "item_id string, text string, doc_id string, n_words int")
    got = decontaminate.report(decontaminate.contamination(docs, bench, **sizes))
    want = [(r[0], *x) for r, x in zip(rows, slow_contamination([r[1] for r in rows], items))]
    assert sum(x[-1] for x in want) > 10
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_contamination_of_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([("a", "x y z")], "item_id string, text string")
    assert decontaminate.contamination(no_docs, some).count() == 0
    got = decontaminate.report(decontaminate.contamination(docs, none)).collect()
    assert len(got) == len(corpus()) and not any(r.contaminated or r.n_hit or r.n_items for r in got)


def test_copies_of_one_text_and_repeats_inside_one(spark):
    text = "a b " * 4000                                                             # one text, very many equal suffixes
    df = spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([("q", "A b a B a b a b a b")], "item_id string, text string")
    got = decontaminate.report(decontaminate.contamination(df, bench)).collect()
    assert len(got) == 30 and all((r.n_words, r.n_hit, r.n_items) == (8000, 8000, 1) for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_index_counts_and_places_every_phrase(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, [2, 3, 50][seed % 3] + 1, 700)
    text[-1] = 0
    index = decontaminate.FmIndex(text, int(text.max()), every=int(rng.integers(1, 9)))
    for _ in range(200):
        n = int(rng.integers(1, 7))
        at = int(rng.integers(0, len(text) - n))
        p = text[at:at + n]
        if (p == 0).any():
            continue
        low, high = index.search(p[None, :].astype(np.int64), np.array([n]))
        where = index.locate(np.arange(low[0], high[0]))
        want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
        assert sorted(where.tolist()) == want


def test_spans_are_removed():
    spans = [[{"start": 1, "end": 3}], [], [{"start": 0, "end": 1}, {"start": 2, "end": 3}], []]
    assert decontaminate.remove_spans(["A b, c-d", "x y", "p q r s", None], spans) == ["a d", "x y", "q s", None]


# ---- collocations -----------------------------------------------------------------------------
def slow_collocations(rows, least, top, longest=3):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                gone |= {p[i:i + k] for i in range(len(p) - k + 1) if 100 * a >= 50 * cand[p[i:i + k]]}
        best = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


def chat(seed, n):
    """Few words, so that phrases repeat; odd white space and cuts between them."""
    rnd = random.Random(seed)
    return "".join("aBcdéǅ"[rnd.randrange(6)] + rnd.choice(["", "x", "Y"]) + rnd.choice([" "] * 8 + [",", "\n", "\t", " \t ", "; ", "\x1c", " ", "\r\n"])
                   for _ in range(n))


CHAT = [(chat(i, 40 + 9 * i), [None, "en", "en", "de", "und"][i % 5]) for i in range(40)] + [(None, "en"), ("", "fr"), ("...", "it"), ("one", "sv")]


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 64}, {"block_phrases": 50, "tries": 2, "range_bytes": 64}])
def test_collocations_match_brute_force(spark, sizes):
    df = spark.createDataFrame([(t, x, 1, "clash") for t, x in CHAT], "text string, lang string, a int, phrase string").repartition(3)
    want = slow_collocations(CHAT, 3, 40)
    assert len(want) > 60
    got = collocations.collocations(df, least=3, top=40, **sizes)
    assert sorted(map(tuple, got.collect())) == want


def test_longer_phrases_and_empty_tables(spark):
    df = spark.createDataFrame(CHAT, "text string, lang string")
    assert sorted(map(tuple, collocations.collocations(df, longest=4, least=3, top=50).collect())) == slow_collocations(CHAT, 3, 50, 4)
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0


def test_texts_are_read_once_for_all_tries(spark, monkeypatch):
    labels, write = [], collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, label: labels.append(label) or write(df, label))
    df = spark.createDataFrame(CHAT, "text string, lang string").repartition(3)
    got = collocations.collocations(df, least=3, top=40, block_phrases=8, tries=1)
    assert sorted(map(tuple, got.collect())) == slow_collocations(CHAT, 3, 40)
    assert labels.count("phrase-counts") == 1


def test_sieves_name_few_phrases_below_the_least_count(spark, monkeypatch):
    """Every word is frequent; as many pairs come once as twice."""
    rng = np.random.default_rng(5)
    words = [f"{i:x}" for i in range(200)]
    some = rng.permutation(200 * 200)
    pairs = lambda at: ".".join(f"{words[i // 200]} {words[i % 200]}" for i in at.tolist())
    df = spark.createDataFrame([(pairs(some[:8000]), "en"), (pairs(some[:16000]), "en")], "text string, lang string")
    named, write = {}, collocations.materialize

    def written(df, label):
        named[label] = write(df, label)
        if label == "phrases-2":
            named["found"] = named[label].count()
        return named[label]
    monkeypatch.setattr(collocations, "materialize", written)
    counted, _ = collocations.phrase_counts(df, longest=2, least=2)
    assert counted.where("k = 2").count() == 8000
    assert named["found"] <= 8100


def test_scores_are_exact_beyond_64_bits(spark):
    a, x, y = 3_000_000_019, 4_000_000_007, 5_000_000_029
    df = spark.createDataFrame([("en", 1, "p", x), ("en", 1, "q", y), ("en", 2, "p q", a)], "lang string, k int, phrase string, a long")
    n = spark.createDataFrame([("en", 10 ** 12)], "lang string, n long")
    got = collocations.ranked(df, n, 10, 50).collect()
    assert [tuple(r) for r in got] == [("en", 1, "p q", a, x, y, 10 ** 12, 1_000_000 * a * a // (x * y))]


@pytest.mark.parametrize("seed", range(8))
def test_double_array_holds_every_phrase_and_no_other(seed):
    rng = np.random.default_rng(seed)
    n = [1, 3, 40, 5000][seed % 4]
    phrases = sorted({tuple((n * rng.random(int(rng.integers(1, 4))) ** 3).astype(int).tolist()) for _ in range([5, 2000][seed // 4])})
    rows = np.full((len(phrases), 3), -1, np.int64)
    for i, p in enumerate(phrases):
        rows[i, :len(p)] = p
    bits, base, check, accept, _ = collocations.build_trie(rows, n)
    trie = collocations.Trie(["en"], [pa.array([str(i) for i in range(n)], pa.large_string())], bits, base, check, accept)
    number = {p: i for i, p in enumerate(phrases)}
    probes = [*phrases, *[tuple(rng.integers(0, n, int(rng.integers(1, 4))).tolist()) for _ in range(500)]]
    for p in probes:
        state = np.array([1])
        for w in p:
            state = trie.step(state, np.array([w]))
        assert trie.accept[state[0]] == number.get(p, -1)
