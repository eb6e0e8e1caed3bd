"""Stages of the corpus pipeline: each applies one operator to the documents it is given.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns that ``docs`` has. Rows without an id go through
every stage like others; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bitmap_join, bpe, entropy_balance, lang_viterbi, pii_crf
from .batches import free_name, row_key


#: A document stays if words in scripts that some learned language uses hold this share of its letters.
LEAST_CLAIMED = 0.5


def language_id(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without text or a letter go, and those mostly in scripts that none uses."""
    model = lang_viterbi.learn_from_documents(docs)
    columns = docs.columns
    prefix = free_name(columns, "stage_")
    found = lang_viterbi.predict(docs, model, keep=tuple(columns), add=("lang_pred", "claimed"), prefix=prefix)
    kept = (F.col(f"`{prefix}lang_pred`") != "und") & (F.col(f"`{prefix}claimed`") >= LEAST_CLAIMED)
    return found.where(kept).select(*[F.col(f"`{c}`") for c in columns])


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies; documents without words are no one's copy and stay.

    Rows go by id and text together: of an id with several texts, only the copies go.
    """
    found = bitmap_join.near_components(docs)
    prefix = free_name(docs.columns, "near_")
    key = [f"{prefix}key_", f"{prefix}key2_"]
    own_id = f"{prefix}id_"
    names = [F.col("key").alias(key[0]), F.col("key2").alias(key[1])]
    gone = found.where("not is_first").select(*names).distinct()
    named = docs.withColumn(own_id, F.col("doc_id").cast("long"))
    named = named.withColumns(dict(zip(key, row_key(own_id, "text")))).drop(own_id)
    # keys of copies grow with the documents: no broadcast at any size
    kept = named.join(gone.hint("merge"), key, "left_anti")
    # repeated rows of one id and text are copies too; without words, only those that have an id
    first = found.where("is_first and (doc_id is not null or n_shingles > 0)")
    repeated = first.groupBy(*names).count().where("count > 1").select(*key)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, key, "left_semi").dropDuplicates(key)
    return kept.join(repeated, key, "left_anti").unionByName(once).select(*docs.columns)


def personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return pii_crf.redact(docs, pii_crf.learn(docs))


def source_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix of sources takes it."""
    return entropy_balance.mixed(docs)


def byte_bpe(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text with their number; copies stay separate rows."""
    coded = bpe.encode(docs, keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", bpe.n_ids("ids").alias("n_tokens"), "ids")
