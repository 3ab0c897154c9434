"""Corpus pipeline: documents to training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows
are written and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.

1. toxicity: documents scored 0.5 or more go;
2. near_dedup: of documents linked by SimHash fingerprints, one stays;
3. decontamination: documents of which a twentieth or more of the words lie
   in benchmark windows go;
4. pii: personal numbers, dates and e-mail names become keyed pseudonyms;
5. packing: the documents are tokenised and packed into sequences.

Null, empty and repeated rows are treated as the operators say: a null text
is an empty one, and all documents without words count as near-duplicates of
each other (fingerprint zero). Columns besides the ids and texts pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import decontaminate, packing, pii, simhash, toxicity
from rivulet.llm.common import save
from rivulet.llm.queries import vocabulary
from rivulet.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, *vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("packing", pack),
]

#: Trees, fingerprints and tokens have no SQL form; the tests hold each stage
#: against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
