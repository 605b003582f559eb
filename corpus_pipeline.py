"""The corpus pipeline: language ID, quality, near copies, personal data, packing; each stage is written and reread.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns they were given.  Rules:

* ``language_id`` drops texts without a letter and texts whose best language
  is less likely than ``LEAST_LANGUAGE``; without a labelled row to learn from, only the former.
* ``quality`` drops texts that score below the classifier's threshold; it
  learns from the labels in ``sf_dir`` that belong to its own input, and
  keeps all if these aren't of both kinds.
* ``near_copies`` keeps the document with the smallest id of each group of
  linked documents, a null id being the largest.  Rows with null or repeated
  ids are told apart; only of rows with equal id and text one is kept.
* ``personal_data`` replaces spans by their kind in brackets and sets
  ``n_chars``, where there is such a column, to the new length.
* ``packing`` returns the pieces of all documents and their sequences.

Edge cases: a null text has no letter and goes in the first stage; columns
with other names, also those that an operator would add, pass unchanged; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import jaccard, langid, packing, pii, quality
from riskloom.llm.common import staged
from riskloom.llm.queries import vocabulary
from riskloom.sources.tables import read_table

LEAST_LANGUAGE = 0.3

#: Two trained classifiers decide stages, which SQL can't express.
ORACLE_SQL = None


def _kept(docs: DataFrame, predict, condition: Column) -> DataFrame:
    """The rows of ``docs`` whose prediction meets the condition, with their own columns, whatever these are called."""
    names = docs.columns
    bare = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    found = predict(bare, f"c{names.index('text')}").where(condition)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = langid.train(langid.learnable(docs))
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return _kept(docs, lambda df, text: langid.predict(df, net, text),
                 (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    if not model.learned:
        return docs
    return _kept(docs, lambda df, text: quality.predict(df, model, text), F.col("predicted") == 1)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if jaccard.own_ids(docs):
        first = jaccard.components_by_key(docs, "text", "doc_id").where("doc_id = component_id").select("doc_id")
        return docs.join(first, "doc_id", "left_semi").select(*docs.columns)
    names = docs.columns
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"),
                              *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), "rows")
    doc_id, text = F.col(f"c{names.index('doc_id')}"), F.col(f"c{names.index('text')}")
    groups = jaccard.components_by_key(rows, f"c{names.index('text')}", "row").withColumnRenamed("doc_id", "row")
    ids = rows.select("row", doc_id.alias("id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("sha"), text.isNull().alias("none"))
    # texts without shingles are linked with nothing: only those of the same id are copies
    alone = F.when((F.col("n_shingles") == 0) & F.col("id").isNotNull(), F.struct("id", "sha", "none"))
    group = F.when(alone.isNull(), F.col("component_id"))
    first = groups.join(ids.hint("merge"), "row").groupBy(group, alone).agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))["row"].alias("row"))
    return rows.join(first.hint("merge"), "row", "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("quality", quality_filter),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``: the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
