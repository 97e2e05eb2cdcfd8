"""The corpus pipeline: stages that each apply one operator to all that the one before kept.

Every stage reads whole texts, however long, and all but the last return the columns of documents, with whatever other
columns the table has, whatever their names. An empty table passes through all stages as an empty one.

| Stage | Null or empty text | Null id, language, source | Repeated rows and ties |
|---|---|---|---|
| language | goes: it has no letter | stays by its text; such rows are not learned from | each stays by its text |
| exact copies | one empty text stays | null ids come last among equal texts | one of each group stays |
| near copies | has no n-grams: links to nothing | rows of null id stay | rows that repeat the id and words of the one that stays, stay |
| mixture | scheduled like any other | a null source is a source of its own | scheduled as often as they come; small sources come again |
| sequences | its end id alone | packed like any other | packed as often as they come |

Quality rules, pseudonyms, licences and language-model scores are in no stage: the order of the stages is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tidemark.llm import exact_dedup, langid, minhash_join, mixing, packing
from tidemark.llm.base import freed, staged, table
from tidemark.llm.queries import PACK_VOCABULARY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.keep_known(docs, langid.fit(langid.training_rows(docs)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return minhash_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mixed stream, those of small sources in several epochs."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, a row for each piece."""
    return packing.packed(docs, public_tokenizers.path(PACK_VOCABULARY))


STAGES = [("language", language), ("exact copies", exact_copies), ("near copies", near_copies), ("mixture", mixture), ("sequences", sequences)]

#: Language profiles, banding, scheduling and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        freed(*before)  # only what the next stage reads stays
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
