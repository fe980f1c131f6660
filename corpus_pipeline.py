"""Corpus pipeline over documents: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.llm.common import materialise, table
from innsight.llm.jaccard import drop_near_duplicates
from innsight.llm.langid import UNDETERMINED, fit, least_known, predict
from innsight.llm.packing import pack
from innsight.llm.quality import clean_documents
from innsight.llm.queries import byte_vocabulary, held_out

#: A language that gets less than this share of the score is not taken for identified.
LEAST_SCORE = 0.5
#: A language in which less than this share of a document's words was met is not taken for identified either; less is asked
#: where the language's own held-out documents hold many unseen words (``least_known``).
LEAST_KNOWN = 0.3
#: Id that ends a document.
END_ID = 1


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns under names that no operator adds, and the new name of each."""
    names = {c: f"in{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(n).alias(c) for c, n in names.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no identified language; learn it from labelled documents that are not held out.

    Nothing is relabelled: ``lang`` stays as it came. Null and empty texts have no language. The score only tells
    learnt languages apart; texts in others, and noise, go because few of their words were met. How few is
    settled for each language by its held-out documents.
    """
    held = F.coalesce(held_out(), F.lit(False))
    model = fit(docs.where(~held), "text", "lang", F.col("doc_id"), with_pairs=True)
    least = least_known(docs.where(held), model, "text", "lang", F.col("doc_id"), LEAST_KNOWN)
    rows, at = _numbered(docs)
    judged = predict(rows, model, at["text"], with_known=True)
    # one row for each language of the model at most: the hint is bounded
    bounds = F.broadcast(spark.createDataFrame(list(least.items()), "lang_pred string, least double"))
    identified = ((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
                  & (F.col("known") >= F.coalesce("least", F.lit(LEAST_KNOWN))))
    return _named(judged.join(bounds, "lang_pred", "left").where(identified), at)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rejected documents; of the others, drop lines that break a rule, and count characters anew where lines went."""
    rows, at = _numbered(docs)
    judged = clean_documents(rows, at["text"]).where("kept")
    changed = F.col("removed_chars") > 0
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(F.col(at["text"])).alias(at["text"])}
    if "n_chars" in at:
        count = F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col(at["n_chars"]))
        new["n_chars"] = count.alias(at["n_chars"])
    return _named(judged.select(*[new.get(c, F.col(n)) for c, n in at.items()]), at)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of copies and near copies: that of the least doc_id."""
    return drop_near_duplicates(docs, "doc_id", "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most 2048."""
    return pack(docs.select("doc_id", "text"), byte_vocabulary(), END_ID, "text", ["doc_id"])


STAGES = [("language_id", identify_language), ("quality_rules", apply_quality_rules),
          ("jaccard_join", join_near_duplicates), ("packing", pack_sequences)]

#: Neither the language model, the join nor the tokens can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
