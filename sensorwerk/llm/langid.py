"""Language ID (7): multilingual mixture inference.

Every language is a smoothed n-gram model (1 to 3 characters of the lower-cased words with edge
marks). A document is a mixture: each of its words comes from one language, with the word's
likelihood taken from its n-grams, and expectation-maximisation estimates the proportions. The
language set starts from the best single language and grows while the log-likelihood gains more
than the penalty ``0.5 * log(words) + log(languages)``; the prediction is the language with the
largest proportion in the set, which is the score.

The models are fitted on a bounded sample: about ``train_docs`` labelled documents per language,
chosen by id hash among those the fold leaves to training. Every label is learned, and each brings its
own most frequent n-grams of that sample (``max_grams`` in equal shares, ``LEAST_GRAMS`` at least), so a
small language keeps its own beside a large one. Whole texts are read in fitting and prediction; exact
word counts enter.

Defined cases: null texts and texts without a letter get ``und`` with score 0, as does every text
when nothing can be learned; letters that no model knows give the score 1/languages; null ids fall
outside the held-out fold; repeated rows are predicted alike; of languages that explain a text equally
well the first by name wins; n-grams of equal frequency go by code; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.llm.common import materialize

TRAIN_DOCS = 1_500       # labelled documents per language that the models are fitted on, about
MAX_GRAMS = 60_000       # n-grams of all models together, in equal shares ...
LEAST_GRAMS = 1_000      # ... but of each language no fewer than these
BROADCAST_LABELS = 100_000
CACHE_CELLS = 16_000_000 # word likelihoods that a Python worker keeps
SMOOTH = 0.5
FLOOR = 30.0             # a word's log-likelihoods differ by no more than this
CACHE_WORDS = 250_000
EM_ROUNDS = 50
BITS = np.uint64(21)     # a code point


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all 1- to 3-grams of the marked words, and the place of the word of each."""
    text = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    start = np.cumsum(c == 2) - 1
    two = (c[:-1] << BITS) | c[1:]
    three = (two[:-1] << BITS) | c[2:]
    ok1 = c > 3
    ok2, ok3 = start[:-1] == start[1:], start[:-2] == start[2:]
    return np.concatenate([c[ok1], two[ok2], three[ok3]]), np.concatenate([start[ok1], start[:-1][ok2], start[:-2][ok3]])


def letters_only(token: str) -> str:
    """The token's letters; other characters part it."""
    return "".join(ch if ch.isalpha() else "\x03\x02" for ch in token).strip("\x02\x03")


class Mixture:
    """The models of all languages, and a bounded cache of word likelihoods."""

    def __init__(self, langs: list[str], codes: np.ndarray, logp: np.ndarray, unseen: np.ndarray):
        self.langs, self.codes, self.logp, self.unseen = langs, codes, logp, unseen
        self.place: dict[str, int] = {}
        self.like = np.zeros((0, len(langs)), np.float64)

    def __reduce__(self):
        return Mixture, (self.langs, self.codes, self.logp, self.unseen)

    def _words(self, words: list[str]) -> np.ndarray:
        """Likelihoods under each language, the best being 1; zero rows have no letter."""
        clean = [letters_only(w) for w in words]
        out = np.zeros((len(words), len(self.langs)))
        has = [i for i, w in enumerate(clean) if w]
        if has and len(self.codes):
            grams, word = word_grams([w for w in (clean[i].replace("\x03\x02", "") for i in has)])
            at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
            score = np.where((self.codes[at] == grams)[:, None], self.logp[at], self.unseen)
            total = np.zeros((len(has), len(self.langs)))
            for j in range(len(self.langs)):
                total[:, j] = np.bincount(word, score[:, j], minlength=len(has))
            total -= total.max(axis=1, keepdims=True)
            out[has] = np.exp(np.maximum(total, -FLOOR))
        return out

    def _places(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self.place) > min(CACHE_WORDS, CACHE_CELLS // max(1, len(self.langs))):
            self.place, self.like = {}, self.like[:0]
        new = sorted(set().union(*docs) - self.place.keys()) if docs else []
        for c in range(0, len(new), 50_000):
            part = new[c:c + 50_000]
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part))))
            self.like = np.concatenate([self.like, self._words(part)])
        get = self.place.__getitem__
        return [np.fromiter(map(get, d), np.int64, len(d)) for d in docs]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        docs = [t.lower().split() if t else [] for t in texts]
        names, scores = [], []
        for at in self._places(docs):
            word, n = np.unique(at, return_counts=True)
            like = self.like[word]
            known = like.any(axis=1)
            if not known.any():
                names.append("und")
                scores.append(0.0)
                continue
            best, share = best_set(like[known], n[known].astype(float))
            names.append(self.langs[best])
            scores.append(share)
        return names, scores


def em(like: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and the log-likelihood they reach."""
    total, before = n.sum(), -np.inf
    for _ in range(EM_ROUNDS):
        joint = like * share
        mass = joint.sum(axis=1)
        ll = float(n @ np.log(mass))
        share = (n / mass) @ joint / total
        if ll - before < 1e-4 * (1 + abs(ll)) * 1e-2:
            break
        before = ll
    return share, ll


def best_set(like: np.ndarray, n: np.ndarray) -> tuple[int, float]:
    """The main language and its proportion in the set that the penalised likelihood selects."""
    langs = like.shape[1]
    single = n @ np.log(like)
    chosen, ll = [int(np.argmax(single))], float(single.max())
    share = np.ones(1)
    penalty = 0.5 * np.log(max(2.0, n.sum())) + np.log(max(2, langs))
    while len(chosen) < langs:
        mix = (like[:, chosen] * share).sum(axis=1)
        rest = [j for j in range(langs) if j not in chosen]
        gain = [float(n @ np.maximum(0.0, np.log(like[:, j] / mix))) for j in rest]      # no set with j gains more
        j = rest[int(np.argmax(gain))]
        if max(gain) <= penalty:
            break
        start = np.append(share * 0.9, 0.1)
        new, reached = em(like[:, [*chosen, j]], n, start)
        if reached - ll <= penalty:
            break
        chosen, share, ll = [*chosen, j], new, reached
    if np.ptp(single) < 1e-9 and langs > 1:
        return chosen[0], 1.0 / langs
    top = int(np.argmax(share))
    return chosen[top], float(min(1.0, share[top]))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for lang, g in pdf.groupby("lang"):
            words: dict[str, int] = {}
            for t in g.text:
                for w in t.lower().split():
                    words[w] = words.get(w, 0) + 1
            pairs = [(letters_only(w).replace("\x03\x02", ""), n) for w, n in words.items()]
            pairs = [(w, n) for w, n in pairs if w]
            if not pairs:
                continue
            grams, word = word_grams([w for w, _ in pairs])
            code, at = np.unique(grams, return_inverse=True)
            n = np.bincount(at, np.array([n for _, n in pairs], float)[word])
            yield pd.DataFrame({"lang": lang, "code": code.astype(np.int64), "n": n.astype(np.int64)})


def fit(docs: DataFrame, is_training: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        train_docs: int = TRAIN_DOCS, max_grams: int = MAX_GRAMS) -> Mixture:
    """Fits the models on about ``train_docs`` documents of each label."""
    labelled = docs.where(is_training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    share = materialize(labelled.groupBy(F.col("lang").alias("of")).agg(
        F.least(F.lit(1.0), F.lit(float(train_docs)) / F.count("*")).alias("keep")), "labels")
    if share.count() <= BROADCAST_LABELS:
        share = F.broadcast(share)
    draw = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.withColumn("draw", draw).join(share, (F.col("lang") == F.col("of")) & (F.col("draw") < F.col("keep"))).select("text", "lang")
    grams = materialize(sample.mapInPandas(_count, "lang string, code long, n long")
                        .groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")
    langs_held = grams.select("lang").distinct().count()
    if not langs_held:
        return Mixture([], np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    each = max(LEAST_GRAMS, max_grams // langs_held)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = grams.withColumn("nth", nth).where(F.col("nth") <= each).select("code").distinct()
    table = grams.join(top, "code").toPandas()                                  # at most ``each`` n-grams a label x labels
    total = dict(map(tuple, grams.groupBy("lang").agg(F.sum("n")).collect()))
    langs = sorted(total)
    codes = np.unique(table.code.to_numpy(np.int64))
    n = np.zeros((len(codes), len(langs)))
    n[np.searchsorted(codes, table.code.to_numpy(np.int64)), [langs.index(x) for x in table.lang]] = table.n
    size = np.array([total[x] for x in langs], float) + SMOOTH * (len(codes) + 1)
    return Mixture(langs, codes.astype(np.uint64), np.log((n + SMOOTH) / size), np.log(SMOOTH / size))


def _predict(model: Mixture):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c in range(0, len(pdf), 512):
                part = pdf.iloc[c:c + 512]
                lang, score = model.predict(part.text.tolist())
                yield part.drop(columns=["text"]).assign(lang_pred=lang, score=np.array(score, float))
    return run


def language_column(model: Mixture, text_col: str = "text") -> Column:
    """``struct<lang_pred, score>`` of a text column; the other columns stay in the JVM."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        got = [model.predict(text.iloc[c:c + 512].tolist()) for c in range(0, len(text), 512)]
        return pd.DataFrame({"lang_pred": [x for a, _ in got for x in a], "score": [x for _, b in got for x in b]},
                            columns=["lang_pred", "score"]).astype({"lang_pred": object, "score": float})
    return predict(F.col(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document."""
    model = fit(docs, ~held_out(id_col), text_col, lang_col, id_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInPandas(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
