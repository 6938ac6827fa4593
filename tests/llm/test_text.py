"""HTML extraction, language ID, token shards, packing, mixing, search and the pipeline against plain Python."""
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorwerk.llm import html_extract, langid, mixing, packing, pivot_search, queries, tokens
from tests.llm.conftest import DOC_SCHEMA, corpus, prose

SF = "/root/testdata/sf0.001"


# ---- exact top-k ------------------------------------------------------------------------------
def slow_top(rows, k=5, every=50):
    ok = [(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(q, w)), j) for m, (j, w) in enumerate(ok) if m != n and len(w) == len(q)))[:k]
            out += [(i, r + 1, j, -n) for r, (n, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 7)])
def test_top_k_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8)]) for i in range(230)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(40)]                             # ties
    rows += [(400, None), (450, [1.0, None] * 4), (500, [float("nan")] * 8), (550, [float("inf")] * 8), (None, rows[0][1]),
             (600, [0.5, 0.25]), (601, [0.25, -0.5]), (650, []), (0, rows[0][1]), (50, rows[7][1]), (301, rows[1][1]), (700, [1e9] * 8), (702, [-3e9] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, label string, rank int")
    got = pivot_search.top_k(df, F.col("vec_id") % 50 == 0, query_block=blocks[0], vector_block=blocks[1], pivots=6, sample=40)
    assert sorted(map(tuple, got.collect())) == slow_top([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
                                                          for i, v in rows])


def test_top_k_stops_early_and_empty(spark):
    rng = np.random.default_rng(1)
    v = np.vstack([rng.integers(-5, 5, (2000, 16)) + 300 * rng.integers(0, 2, (1, 16)), rng.integers(-300, 300, (2000, 16))])
    piv = v[pivot_search.choose_pivots(np.arange(len(v)), v, 16)]
    d = pivot_search.distances(v, piv)
    seen, plain = [], pivot_search.inner
    pivot_search.inner = lambda a, q: (seen.append(len(a)), plain(a, q))[1]
    try:
        pivot_search.search_cell(np.arange(8), v[:8], d[:8], np.arange(len(v)), np.arange(len(v)), v, d, np.full(8, -np.inf), 5)
    finally:
        pivot_search.inner = plain
    assert sum(seen) < 8 * len(v)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_search.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


# ---- HTML -------------------------------------------------------------------------------------
PAGES = {
    "<html><body><nav><a href=x>Home</a></nav><article><h1>T &amp; t</h1><p>One\n  two &#233;</p><p>Three words here<br>more</article>"
    "<footer>&copy; me</footer></body></html>": "T & t\nOne two é\nThree words here more",
    "<div class='ad'>Buy</div><div><p>First long paragraph of the text.<p>Second long paragraph of it.</div><div id=comments><p>Nice!</div>":
        "First long paragraph of the text.\nSecond long paragraph of it.",
    "<body><header><h1>Site</h1></header><main><h2>Head</h2><ul><li>a b c<li>d e f</ul><script>if(a<b){x='</p>'}</script>"
    "<form><p>Mail<input></form><aside><p>Side</aside><p>Tail of the text</main>": "Head\na b c\nd e f\nTail of the text",
    "<article><p>cut off in the mid": "cut off in the mid",
    "plain text only": "plain text only", "": "", "<br><!-- x -->": "", "<p></p>": "",
    "<article><p><b>Bold start.<br><p>Next <i>one</i></p><!-- <p>no</p> --></article>": "Bold start.\nNext one",
}


def test_html_extract_cases(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(90, None, None), (0, "u0", list(PAGES)[0]), (None, "n", "<p>x</p>")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, html_extract.extract(df).collect()), key=repr)
    text = [*PAGES.values(), "", list(PAGES.values())[0], "x"]
    assert got == sorted([(r[0], r[1], t, len(t)) for r, t in zip(rows, text)], key=repr)


P10 = "".join(f"<p>Paragraph {n} of the story has some words.</p>" for n in range(10))
T10 = "\n".join(f"Paragraph {n} of the story has some words." for n in range(10))
MENU = "<nav><a href=x>Home</a> <a href=y>News</a></nav><footer>&copy; the site and its owners</footer>"


@pytest.mark.parametrize("page,text", [
    *((f"<body>{MENU}<div class='{c}'><article>{P10}</article></div></body>", T10)
      for c in ("has-sidebar", "no-sidebar", "content with-comments", "sidebar", "social wide")),
    *((f"<body>{MENU}<{t}><article>{P10}</article></{t}></body>", T10) for t in ("form", "aside", "div hidden")),
    (f"<body>{MENU}<div class='content comments'>{P10}</div></body>", T10),
    (f"<body>{MENU}<form action=x><div>{P10}</div></form></body>", T10),
    (f"<body>{MENU}<main><div class=notice>{P10}</div></main></body>", T10),
    (f"<body>{MENU}<div class=notice>Text without any element in it</div></body>", "Text without any element in it"),
    (f"<article><div class='post-header'><h1>Head</h1></div><p class='share-price'>Price 3</p>{P10}</article>", f"Head\nPrice 3\n{T10}"),
    (f"<article><div class='header'><h1>Head</h1></div><div class='share'>Tweet</div>{P10}</article>", f"Head\n{T10}"),
    # furniture beside the article stays out, also when it is longer or holds articles itself
    (f"<body>{MENU}<article><p>A short story of few words.</p></article><div id=comments>{P10}<article>{P10}</article></div></body>",
     "A short story of few words."),
    (f"<body>{MENU}<main><article>{P10}</article><section id=comments>{P10}{P10}</section></main></body>", T10),
])
def test_html_extract_furniture_names_do_not_hide_the_text(page, text):
    assert html_extract.main_text(page) == text


SECTIONS = ["".join(f"<p>Section {s} has a paragraph {n} with words.</p>" for n in range(k)) for s, k in enumerate((5, 2, 1))]
LINKS = "<div><ul>" + "".join(f"<li><a href={n}>Another page {n}</a></li>" for n in range(8)) + "</ul></div>"
lines = lambda html: "\n".join(x for x in re.split("<[^>]*>", html) if x)


@pytest.mark.parametrize("before,after", [("", ""), (MENU, ""), (LINKS, LINKS)])
@pytest.mark.parametrize("body,text", [
    (f"<div><h1>T</h1><p>Lead</p><div class=text>{P10}</div></div>", f"T\nLead\n{T10}"),
    (f"<h1>A title of the page</h1><p>And a <b>lead</b> to it.</p><div class=text>{P10}</div><p>The end.</p>",
     f"A title of the page\nAnd a lead to it.\n{T10}\nThe end."),
    (f"<div><div class=post-header><h1>Title</h1></div><div class=text>{P10}</div></div>", f"Title\n{T10}"),
    ("<div>" + "".join(f"<div>{s}</div>" for s in SECTIONS) + "</div>", lines("".join(SECTIONS))),
    ("".join(f"<section><h2>Head</h2>{s}</section>" for s in reversed(SECTIONS)),
     "\n".join("Head\n" + lines(s) for s in reversed(SECTIONS))),
    (f"<div>A lead of bare text, as long as any <i>paragraph</i> of the story is.<div>{P10}</div></div>",
     f"A lead of bare text, as long as any paragraph of the story is.\n{T10}"),
    (f"<div>A lead of bare text, as long as any paragraph of the story is. <span><b>{P10}</b></span></div>",
     f"A lead of bare text, as long as any paragraph of the story is.\n{T10}"),
    (f"<article>{SECTIONS[0]}</article><article>{SECTIONS[1]}</article>", lines(SECTIONS[0] + SECTIONS[1])),
])
def test_html_extract_keeps_what_reaches_the_body_path_threshold(before, body, after, text):
    assert html_extract.main_text(f"<body>{before}{body}{after}</body>") == text


def test_html_extract_whole_table_against_the_article_element(spark):
    from html import unescape

    for r in queries.op2_html_extract(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)[^>]*>", inner)]
        assert r.text == "\n".join(b for b in want if b) and r.n_chars == len(r.text)


def test_html_extract_deep_and_long():
    assert html_extract.main_text("<div>" * 5000 + "<p>deep words</p>" + "</div>" * 5000) == "deep words"
    assert len(html_extract.main_text("<article>" + "<p>some words of text</p>" * 20_000)) == 20_000 * 19 - 1


GONE = "<p>Some words that must go away now, as they are no text.</p>"
KEPT_NAMES = ("<p class=reply>{}</p>", "<section id=social><p>{}</p></section>", "<section id=menu><p>{}</p></section>", "<blockquote class=comment>{}</blockquote>")


@pytest.mark.parametrize("page,text", [
    ("<p class=x'>Hello</p><p>it's</p>", "Hello\nit's"),                                # a quote in a bare value
    ("<p>a<!-->b c</p><p>d --> e</p>", "ab c\nd --> e"), ("<p>a<!--->b</p>", "ab"), ("<p>a<!-- x --!>b</p>", "ab"),
    ("<p>1 < 2 and a<b> c</b></p><p>x <3 y</p>", "1 < 2 and a c\nx <3 y"), ("<p title=\"a>b\">c</p>", "c"), ("<p>a</>b<?php x ?>c</p>", "abc"),
    ("<article><p>AT&<i>copy</i> and &amp;lt; x &copy;</p></article>", "AT&copy and &lt; x \u00a9"),      # references end with their run
    *((f"<article>{P10}{c.format('Kept text here')}</article>", f"{T10}\nKept text here") for c in KEPT_NAMES),
    *((page.format(f"<div class={c}>{GONE}</div>"), T10) for c in ("site-footer", "related-posts", "cookie-banner", "ad-slot", "share-buttons", "comment-list")
      for page in (f"<body><article>{P10}</article>{{}}</body>", f"<body><article>{P10}{{}}</article></body>", f"<body><div class=content>{P10}</div>{{}}</body>")),
    (f"<article>{P10}<section id=comments>{GONE}</section></article>", T10),
    (f"<body><h1>Title of it</h1><p>Lead text.</p><article>{P10}</article></body>", f"Title of it\nLead text.\n{T10}"),
    (f"<body>{MENU}<h1>Title of it</h1><main>{P10}</main><p>Imprint</p></body>", f"Title of it\n{T10}"),
])
def test_html_extract_by_the_rules_of_html(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("part", ['<p class="a', " <a href='x", "<p title=\"'", "<!--", "<!-- -", '<p a=b"c>', "<", "</", "<script>x</scrip", "&amp"])
def test_html_extract_reads_broken_pages_in_proportion_to_their_length(part):
    import time

    def seconds(n):
        begin = time.process_time()
        html_extract.main_text(part * (n // len(part)))
        return time.process_time() - begin

    assert seconds(1_000_000) < 8 * max(0.25, seconds(250_000))


def test_html_extract_of_an_empty_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def slow_density(node, body):
    """Counts and composite density of an element, written again over its text alone."""
    import math

    def walk(x, link):
        c = t = lc = lt = 0
        for k in x.kids:
            if isinstance(k, str):
                n = len(re.sub(r"\s", "", k))
                c, lc = c + n, lc + n * link
            else:
                a = walk(k, link or k.tag == "a")
                c, t, lc, lt = c + a[0], t + a[1] + 1, lc + a[2], lt + a[3] + (k.tag == "a")
        return c, t, lc, lt

    bc, _, blc, _ = walk(body, False)
    c, t, lc, lt = walk(node, False)
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + blc / max(1, bc) * c + math.e)
    return c / max(1, t) * math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / (math.log(base) if base > 1 + 1e-9 else 1)


@pytest.mark.parametrize("seed", range(12))
def test_html_extract_densities_and_their_sums_against_brute_force(seed):
    rnd = random.Random(seed)

    def part(depth):
        if depth == 0 or rnd.random() < 0.3:
            return "".join(rnd.choice(["word ", "a ", "<a href=x>link</a> "]) for _ in range(rnd.randrange(1, 9)))
        return "".join(f"<{t}>{part(depth - 1)}</{t}>" for t in (rnd.choice(["div", "section", "p", "b", "span"]) for _ in range(rnd.randrange(1, 4))))

    root = html_extract.parse(f"<body>{part(5)}</body>")
    body = root.kids[0]
    html_extract.measure(body)
    for x in html_extract.densities(body):
        inside = [k for k in x.kids if not isinstance(k, str)]
        if x.tag != "a" and all(y.tag != "a" for y in ancestors(x)):
            assert x.density == pytest.approx(slow_density(x, body))
            if all(k.tag != "a" for k in inside):
                assert x.total == pytest.approx(sum(slow_density(k, body) for k in inside))


def ancestors(x):
    while x.parent is not None:
        x = x.parent
        yield x


# ---- language ID ------------------------------------------------------------------------------
def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got}
    assert all(r.held_out == fold[r.doc_id] for r in got)
    held = [r for r in got if r.held_out and r.lang is not None]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= {r.lang for r in got} | {"und"}


def test_language_id_odd_rows(docs, no_docs, spark):
    got = langid.identify(docs).collect()
    assert len(got) == len(corpus())
    no_letter = {r[0] for r in corpus() if not any(c.isalpha() for c in r[1] or "")}
    for r in (r for r in got if r.doc_id is not None):        # two rows of the fixture have no id
        assert (r.lang_pred == "und" and r.score == 0) == (r.doc_id in no_letter)
    assert langid.identify(no_docs).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_every_label_is_learned_and_small_ones_keep_their_ngrams(spark):
    rnd = random.Random(5)
    words = {f"l{i}": ["".join(chr(0x4E00 + 40 * i + rnd.randrange(40)) for _ in range(4)) for _ in range(6)] for i in range(250)}
    rows = [(1000 * i + j, " ".join(rnd.choice(ws) for _ in range(12)), lang) for i, (lang, ws) in enumerate(words.items())
            for j in range(9 if i else 400)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    true = {r[0]: r[2] for r in rows}
    assert len({r.lang_pred for r in got}) == 250 and sum(r.lang_pred == true[r.doc_id] for r in got) > 0.99 * len(got)


def test_pipeline_keeps_a_corpus_without_labels(spark, docs):
    import corpus_pipeline

    got = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), "")
    assert got.count() == sum(any(c.isalpha() for c in r[1] or "") for r in corpus())


def test_mixing_spreads_many_rows_without_an_id(spark):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("w").alias("text"), F.lit("s").alias("source"))
    sized = mixing.sizes_of(rows)
    got = mixing.mix(mixing.materialize(sized, "sizes"), group_docs=1_000)
    n, taken, target = got.agg(F.count("*"), F.sum("taken"), F.first("target")).first()
    assert n == 20_000 and abs(taken - target) <= 2


def test_mixture_proportions():
    rnd = random.Random(1)
    words = {"aa": ["kato", "mika", "tiko", "kota"], "bb": ["zub", "blug", "gruz", "zlub"]}
    codes, where = langid.word_grams([w for ws in words.values() for w in ws])
    code, at = np.unique(codes, return_inverse=True)
    n = np.zeros((len(code), 2))
    np.add.at(n, (at, (where >= 4).astype(int)), 1)
    size = n.sum(axis=0) + 0.5 * (len(code) + 1)
    model = langid.Mixture(["aa", "bb"], code, np.log((n + 0.5) / size), np.log(0.5 / size))
    for share in (0.0, 0.3, 0.7, 1.0):
        text = " ".join(rnd.choice(words["aa" if rnd.random() < share else "bb"]) for _ in range(400))
        (lang,), (score,) = model.predict([text])
        assert lang == ("aa" if share > 0.5 else "bb") and abs(score - max(share, 1 - share)) < 0.07


# ---- tokens -----------------------------------------------------------------------------------
def slow_ids(path, text, end):
    from tokenizers import Tokenizer

    tok = slow_ids.cache.setdefault(path, Tokenizer.from_file(path))
    return tok.encode(text or "", add_special_tokens=False).ids + [end]


slow_ids.cache = {}
ODD = ["", " ", "\n", "a\nb", "a \nb", " a", "a ", "a  b", "a\n\nb", "a\tb c", "don't we'll it's", "x., y.,. z,, w.", "\x00a b\x00", "a\x00 b",
       "naïve Ünïcode  x", "1234 56,78.", "日本語 テキスト", "<|endoftext|> <|startoftext|>", "a<|endoftext|>b c", "x <|ENDOFTEXT|> é<|endoftext|>\n y", "<|end oftext|> <| a", "é ö", "A B C 　D", "ΑΣ ΣΑΣ. İ", "\r\n x\r\n"]


@pytest.mark.parametrize("path,keeps", [(queries.BYTE_BPE, True), (queries.WORD_BPE, False)])
def test_encoder_equals_the_tokenizer(path, keeps):
    texts = ODD + [r[1] for r in corpus() if r[1]] + ["".join(random.Random(i).choice(" \n\t.,'ab1éΣ日") for _ in range(60)) for i in range(300)]
    enc = tokens.TextEncoder(path, keeps)
    for _ in range(2):                                    # cold and warm
        got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
        assert got == [slow_ids(path, t, 0)[:-1] for t in texts]


def test_encoder_cache_generations(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    enc = tokens.TextEncoder(queries.BYTE_BPE, True)
    for i in range(12):
        t = prose(i % 5, 80)
        assert np.frombuffer(enc.encode([t])[0], enc.dtype).tolist() == slow_ids(queries.BYTE_BPE, t, 0)[:-1]
        assert len(enc.young) < 500


@pytest.mark.parametrize("path,keeps", [(queries.BYTE_BPE, True), (queries.WORD_BPE, False)])
def test_encoder_looks_a_piece_up_once_a_call(path, keeps):
    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    enc = tokens.TextEncoder(path, keeps)
    enc.young = Counted()
    texts = ["one two. three\nfour &&& five&&& six###,!! don't'' a_b__ é*** *** x.'y &&&"] * 500
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
    assert got == [slow_ids(path, t, 0)[:-1] for t in texts]
    assert 0 < Counted.asked < 100


@pytest.mark.parametrize("path,keeps", [(queries.BYTE_BPE, True), (queries.WORD_BPE, False)])
def test_encoder_puts_ids_together_in_bounded_memory(path, keeps):
    enc = tokens.TextEncoder(path, keeps)
    texts = ["a bc " * 2000 + "d", "", "x\x00 y", "a"] * 200 + ["bc a " * 150_000 + "bc"]         # some above and some below the bound
    some = enc.encode(texts[:4])
    tracemalloc.start()
    got = enc.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[:-1] == some * 200 and got[-1] == enc.encode(texts[-1:])[0] and len(got) == len(texts)
    assert [np.frombuffer(b, enc.dtype).tolist() for b in some] == [slow_ids(path, t, 0)[:-1] for t in texts[:4]]
    assert peak < 25e6, peak


def test_packing_keeps_a_small_cache(monkeypatch):
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    pdf = pd.DataFrame({"rid": range(3), "doc_id": [1, None, 3], "text": [prose(1, 50), None, "x"]})
    list(packing._pieces(queries.WORD_BPE, False, 0, 8)(iter([pdf])))
    (enc,) = tokens._ENCODERS.values()
    assert enc.cache_words == packing.CACHE_WORDS < tokens.CACHE_WORDS


def test_shard_round_trip():
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, m, n).astype(np.uint32) for n, m in ((0, 1), (1, 9), (5000, 300), (70_000, 70_000), (3, 1 << 20))]
    docs, sizes, flat = tokens.unpack_shard(tokens.pack_shard([5, None, 7, -8, 9], ids))
    assert docs == [5, None, 7, -8, 9] and sizes.tolist() == [len(x) for x in ids]
    assert (flat == np.concatenate(ids)).all()
    assert tokens.unpack_shard(tokens.pack_shard([], []))[0] == []


@pytest.mark.parametrize("shard_ids", [1 << 20, 500])
def test_token_shards_match_brute_force(docs, shard_ids):
    got = tokens.read_shards(tokens.write_shards(docs, queries.BYTE_BPE, shard_ids=shard_ids)).collect()
    want, start = [], 0
    order = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    for r in order:
        ids = slow_ids(queries.BYTE_BPE, r[1], 2)
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_shards_empty(no_docs):
    assert tokens.read_shards(tokens.write_shards(no_docs, queries.BYTE_BPE)).count() == 0


# ---- packing ----------------------------------------------------------------------------------
def test_plan_reaches_the_volume_bound_where_best_fit_does():
    rng = np.random.default_rng(4)
    sizes = np.minimum(2048, (rng.lognormal(6, 0.9, 1200)).astype(np.int64) + 1)
    lengths, counts = np.unique(sizes, return_counts=True)
    made = packing.plan(lengths, counts, 2048)
    used = np.zeros(len(lengths), np.int64)
    for conf, times in made:
        assert sum(n * int(lengths[i]) for i, n in conf.items()) <= 2048
        for i, n in conf.items():
            used[i] += n * times
    fewest = sum(times for _, times in packing.best_fit(lengths, counts, 2048))
    assert (used == counts).all() and sum(times for _, times in made) <= fewest


def check_packed(rows, docs, capacity):
    """Pieces are the documents', sequences are gapless and within the capacity."""
    want = Counter()
    for d, t in docs:
        ids = slow_ids(queries.WORD_BPE, t, 0)
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[(d, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_packing_of_the_fixture(docs, no_docs):
    rows = packing.pack_documents(docs, queries.WORD_BPE, capacity=256).collect()
    n = check_packed(rows, [(r[0], r[1]) for r in corpus()], 256)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 256) * 1.05 + 1
    assert packing.pack_documents(no_docs, queries.WORD_BPE).count() == 0


def test_packing_numbers_across_salts(spark):
    df = spark.createDataFrame([(i, 0, 1 + i % 7) for i in range(2000)], "rid long, piece int, length long")
    rows = packing.pack(df, 20, salt_rows=30).collect()
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 20
    assert len(rows) == 2000 and len(seqs) == -(-sum(r.length for r in rows) // 20)


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_the_histogram_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    cap = 200
    lengths = np.unique(rng.integers(1, cap + 1, 40))
    counts = rng.integers(1, 400, len(lengths))
    confs = packing.plan(lengths, counts, cap)
    used = np.zeros(len(lengths), np.int64)
    for conf, times in confs:
        assert sum(int(lengths[i]) * n for i, n in conf.items()) <= cap and times > 0
        for i, n in conf.items():
            used[i] += n * times
    assert (used == counts).all()
    large = lengths * 2 > cap                                    # two of these never share a sequence
    bound = 0
    for a in range(cap // 2 + 1):
        small = (lengths >= a) & ~large
        beside = large & (lengths <= cap - a)
        room = int((counts[beside] * (cap - lengths[beside])).sum())
        bound = max(bound, int(counts[large].sum()) + max(0, -(-(int((counts[small] * lengths[small]).sum()) - room) // cap)))
    made = sum(t for _, t in confs)
    assert made <= 1.04 * bound + 2 and made <= sum(t for c, t in packing.best_fit(lengths, counts, cap) if c)


def test_plan_covers_many_lengths_by_the_linear_program(monkeypatch):
    rng = np.random.default_rng(7)
    cap = 1024
    lengths = np.unique(np.minimum(rng.lognormal(5.0, 1.0, 3000).astype(int) + 1, cap))
    counts = rng.integers(1, 40, len(lengths))
    rest, solved, plain, solve = [], [], packing.best_fit, packing.solve_lp
    monkeypatch.setattr(packing, "best_fit", lambda a, b, c: (rest.append(int((a * b).sum())), plain(a, b, c))[1])
    monkeypatch.setattr(packing, "solve_lp", lambda *a: solved.append(solve(*a)) or solved[0])
    made = sum(t for _, t in packing.plan(lengths, counts, cap))
    volume = int((lengths * counts).sum())
    assert len(lengths) > 500 and len(rest) == 1 and rest[0] <= 0.2 * volume
    found, bound = solved[0]
    covered = np.zeros(len(lengths))
    for conf, x in found:
        assert sum(int(lengths[i]) * n for i, n in conf.items()) <= cap
        covered[list(conf)] += x * np.array(list(conf.values()))
    assert np.allclose(covered, counts) and bound >= volume / cap - 1e-6
    assert sum(x for _, x in found) <= max((1 + packing.GAP) * bound, np.ceil(bound) + 1) and made <= 1.005 * bound + 2


def test_knapsack_prices_the_best_configuration():
    rng = np.random.default_rng(4)
    lengths, weights = np.array([3, 5, 7, 11]), rng.random(4)
    conf = packing.best_configuration(lengths, weights, np.full(4, 99), 30)
    best = max(a * weights[0] + b * weights[1] + c * weights[2] + d * weights[3]
               for a in range(11) for b in range(7) for c in range(5) for d in range(3) if 3 * a + 5 * b + 7 * c + 11 * d <= 30)
    assert sum(weights[i] * n for i, n in conf.items()) >= best - 1e-9


# ---- mixing -----------------------------------------------------------------------------------
def slow_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = sum(w[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else rest * w[s] / open_ for s in names}
        more = {s for s in names if s not in full and out[s] > cap * sizes[s] + 1e-9}
        if not more:
            return out
        full |= more


@pytest.mark.parametrize("group_docs", [20_000, 3])
def test_mixing_targets_and_totals(docs, group_docs):
    got = mixing.mix_sources(docs, group_docs=group_docs).collect()
    again = mixing.mix_sources(docs.repartition(5), group_docs=group_docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = defaultdict(int)
    for r in corpus():
        per[r[3]] += size(r[1])
    want = slow_targets(per)
    by_total = {round(per[s], 6): want[s] for s in per}
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size(r[1])) for r in corpus())
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in got:
        assert abs(r.target - by_total[r.source_size]) < 1e-6 * max(1, r.target)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source_size] += r.taken
        biggest[r.source_size] = max(biggest[r.source_size], r.size)
    for s, t in taken.items():
        assert abs(t - by_total[s]) <= biggest[s]


def test_pivotal_keeps_the_weighted_sum_and_the_expectation():
    rng = np.random.default_rng(0)
    sizes, mean = np.array([5, 900, 30, 30, 1, 77, 400]), np.zeros(7)
    p0 = np.array([0.2, 0.7, 0.5, 0.5, 0.9, 0.1, 0.33])
    for _ in range(4000):
        p, held = mixing.pivotal(sizes, p0, rng.random(7))
        assert abs((sizes * p).sum() - (sizes * p0).sum()) < 1e-6
        assert all(x in (0.0, 1.0) for i, x in enumerate(p) if i != held)
        mean += p
    assert np.abs(mean / 4000 - p0).max() < 0.03


def test_mixing_without_words(spark, no_docs):
    assert mixing.mix_sources(no_docs).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix_sources(df).collect()] == [(0, 0.0)] * 2


# ---- pipeline ---------------------------------------------------------------------------------
def test_pipeline_stages_and_whole_run(spark, docs):
    import corpus_pipeline as P
    from tests.llm.test_dedup import norm_sha, slow_components, slow_print

    now, rows = docs, [tuple(r) for r in docs.collect()]
    for name, stage in P.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), DOC_SCHEMA)
        assert now.columns == docs.columns
        got = [tuple(r) for r in now.collect()]
        assert not Counter({r: 1 for r in got}) - Counter({r: 1 for r in rows})
        if name == "language_id":
            want = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
            assert Counter(got) == Counter(want)
        elif name == "exact_dedup":
            assert len(got) == len({norm_sha(r[1]) for r in rows}) == len({norm_sha(r[1]) for r in got})
            least = {}
            for r in rows:
                k = norm_sha(r[1])
                least[k] = min(least.get(k, 1 << 63), 1 << 63 if r[0] is None else r[0])
            assert all(least[norm_sha(r[1])] == (1 << 63 if r[0] is None else r[0]) for r in got)
        elif name == "simhash_dedup":
            assert len(got) == len(set(slow_components([slow_print(r[1]) for r in rows])))
        elif name == "mix_sources":
            words = lambda rs: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rs)
            assert max(Counter(got).values()) <= 2
            assert abs(words(got) - 1.5 * words(rows)) <= sum(sorted(len(r[1].split()) for r in rows)[-5:])
        rows = got
    check_packed(P.STAGES[-1][1](spark, now, SF).collect(), [(r[0], r[1]) for r in rows], 2048)
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mix_sources", "packing"]


def test_pipeline_empty(spark, no_docs):
    import corpus_pipeline as P

    now = no_docs
    for _, stage in P.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0
