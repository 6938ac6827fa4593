"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept; all but the last
return the columns of ``documents``. :func:`run` writes every stage's rows to the shared folder and
reads them again. The language models are fitted once, on the stage's own input.

Defined cases: null and letterless texts go in the first stage; of equal texts, and of near ones, one row
stays (smallest doc_id, null ids last, repeated rows by their place); an empty table passes as one; other
columns of the documents are carried along; ties are those of the operators called.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwerk.llm import exact_dedup, langid, mixing, packing, simhash
from sensorwerk.llm.common import materialize, numbered, table
from sensorwerk.llm.queries import WORD_BPE

#: SQL has neither the fitted language models nor the tokenizer; tests hold run() against plain Python.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language can be told: null texts and texts without a letter.

    Without any label there is no model to tell languages by, and the letters alone decide."""
    model = langid.fit(docs, ~langid.held_out())
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(langid.language_column(model)["lang_pred"] != "und")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, no = numbered(docs)
    kept = exact_dedup.kept_rows(rows, no)
    return rows.join(kept, rows[no] == kept.rid, "left_semi").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, no = numbered(docs)
    kept = simhash.kept_rows(rows, no)
    return rows.join(kept, rows[no] == kept.rid, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times)."""
    rows, no = numbered(docs)
    taken = mixing.copies_of(rows, no)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    taken = taken.select("rid", each.alias("copy_no"))            # a row per copy, before the texts join
    return rows.join(taken, rows[no] == taken.rid).select(*[rows[c] for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, WORD_BPE, keeps_space=False, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
