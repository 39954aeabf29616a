"""From raw documents to token ids: the stages of the training-data pipeline, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutline.llm import language
from debutline.llm.decontaminate import remove_contaminated
from debutline.llm.mix import mixed
from debutline.llm.queries import tokenizer_path
from debutline.llm.shared import cut_lineage, table
from debutline.llm.simhash import keep_one
from debutline.llm.token_file import token_table


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those in which the kernel classifier finds none that stands out go, and so do null texts and texts without any letter.

    Without any label no language is learned; the rule of letters holds all the same.
    """
    model = language.fit(docs.where(language.learnable("doc_id")))
    if not model.languages:
        return language.with_letters(docs)
    return language.predict(docs, model).where(language.determined("_lang", "_score")).drop("_lang", "_score")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints link."""
    return keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is inside a 13-word window of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: sources weigh 1, 2, 3 by turns, none more than three times its size."""
    return mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as token ids, written as coded files and read back: doc_id, start, n_tokens, ids_crc32."""
    return token_table(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", in_known_languages),
    ("simhash_near_dedup", distinct),
    ("benchmark_decontamination", decontaminated),
    ("source_mixture", mixture),
    ("token_id_output", token_ids),
]

# tokenisation and balanced sampling have no SQL form; tests/llm compares the rows that stages keep, and the token table, with brute force;
# of the mixture only sources with a forced result and totals can be compared
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written in the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
