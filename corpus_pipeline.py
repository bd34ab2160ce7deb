"""A corpus pipeline over ``documents``: five stages, each an operator of ``vocabmill.llm`` at its production settings.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Stages after the first read no results of
earlier ones but their rows. Labels and benchmark items come from the tables beside the documents.

Defined results, for every stage: columns beyond ``COLUMNS`` are dropped, whatever their names; an empty table gives an empty table; a
null or empty text has no words, so nothing marks it and its row stays; rows that repeat each other meet the same fate, except that two lines
or documents of one doc_id tie and both stay; a null doc_id stays a row of its own and, in the line stage, comes first; a text of any
length is taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vocabmill.llm import decontaminate, jaccard, lines, pieces, toxicity
from vocabmill.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents of the input table, then drop every document of ``docs`` that is predicted toxic."""
    machine = toxicity.train(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), machine)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within one word edit of an earlier line go; documents left without words go with them."""
    return lines.dedup(docs.select(*COLUMNS), "pipeline-lines", **lines.WHOLE)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicate documents the first one stays."""
    return jaccard.one_of_each(docs.select(*COLUMNS), name="pipeline-jaccard")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every whole text, and whether decoding them gives the text (a null text: the empty one) again."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs.select(*COLUMNS), model, name="pipeline-pieces", merges=pieces.by_merges(model), check=True).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL expresses neither the fitted model nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
