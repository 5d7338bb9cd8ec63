"""A training corpus from raw documents: identify languages, drop near copies, remove secrets, mix sources, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it wrote. All but the last
return the columns of the documents, the caller's own ones with their values too, whatever their names; the last returns
the packed pieces of the corpus. A document that the mix takes twice is packed twice. Every stage reads whole texts, very
long ones too, and gives an empty table for an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpanel.llm import jaccard, langid, mixing, packing, secrets
from textpanel.llm.common import fresh_path, held_out, own_name, table


#: Pieces that a worker remembers while it tokenizes; workers of all stages share an executor's memory here.
KNOWN = 50_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is unknown or ambiguous go.

    Null and empty texts and texts without a letter have no language and go; a null language label teaches nothing;
    repeated rows are judged alike, each on its own.
    """
    return langid.identified(docs, langid.train(docs, ~held_out(F.col("doc_id"))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    It is the one with the smallest id, null before all others, and of several texts under that id the one whose hash
    comes first; of repeated rows one stays. Texts without a word, null ones too, are no copies of anything and stay all.
    """
    return jaccard.one_of_each(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific secrets are replaced by their kind, and n_chars tells the new length.

    Null and empty texts stay as they are (n_chars null and 0); a null source is an owner of its own; of overlapping spans
    the one that begins first, then the longest, gives its kind; repeated rows change alike.
    """
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Null and empty texts have no words and may be taken as any other; a null source is one of its own; a source without
    words goes; repeated rows count each on their own; ties are taken in order of a hash of id and size.
    """
    *names, copy = own_name(docs, *mixing.OUTPUTS, "copy")
    return mixing.repeat_rows(mixing.mix(docs, store=False, names=tuple(names)), names[-1], copy).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    A null or empty text is a piece of its end id alone; repeated rows are packed each; a text longer than a sequence is
    cut, its first piece the shorter one; columns of the documents other than the id and the text don't come along.
    """
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), known=KNOWN)


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scan", remove_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Trained models, tokenizers and MinHash aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
