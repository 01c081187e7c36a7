"""A training corpus in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last keep the columns
of documents; the last returns the pieces of packed sequences.

1. toxicity: documents whose grade is above clean go.
2. language: documents without letters, and those whose predicted language is
   not one of LANGUAGES or less likely than LEAST_LANGUAGE_SCORE, go.
3. near_duplicates: of each group of near copies (five words, 0.8) the smallest
   doc_id stays.
4. mixing: domains, languages and sources to their weights, within one epoch.
5. packing: sequences of at most 2048 tokens, sources dealt to their weights.

Edge cases. Stages keep the rows and columns of their input as they are, extra
columns too, whatever their names; those that an operator would add are not among
the results. Null or empty texts: not toxic; without letters, so the language
stage takes them out. Null doc_id: never a copy of another, and ordered as the
word null in mixing. Null language or source: a leaf of its own in mixing, a queue
of its own in packing. No labels, or none of toxic texts: nothing is rejected.
Repeated rows: of equal ids each row is kept or goes with the others. Empty
tables: no rows. Ties: of a group of copies the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import drop_tables, table, table_mark, without_ids, written

LANGUAGES = ("en", "de", "fr", "es")
LEAST_LANGUAGE_SCORE = 0.35
MIX_FRACTION = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tallyspan.llm.toxicity import clean_rows, fit

    return clean_rows(docs, fit(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tallyspan.llm.langid import fit, rows_in

    return rows_in(docs, fit(docs), LANGUAGES, LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tallyspan.llm.minhash import near_duplicates as components

    found = components(docs, words=5, percent=80)
    return without_ids(docs, found.where("not kept").select("doc_id"), "doc_id")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tallyspan.llm.mixing import mix
    from tallyspan.llm.queries import domain_of_source, mixture_weights

    # The row travels as one column, so none of its columns is replaced.
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "lang", "source")
    return mix(rows, domain=domain_of_source(), weights=mixture_weights(), fraction=MIX_FRACTION, epochs=1).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tallyspan.llm.packing import pack
    from tallyspan.llm.queries import source_weight

    return pack(docs, targets=source_weight)


STAGES = [(f.__name__, f) for f in (toxicity, language, near_duplicates, mixing, packing)]

#: Classifiers, tokenizers and components aren't SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. Each result but the last is written to the
    shared folder, and only then the tables that it was made from are deleted;
    the last is returned."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        start = table_mark(spark)
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
            drop_tables(spark, start - (i > 0), table_mark(spark) - 1)
    return docs
