"""A training corpus from documents: filter, deduplicate, pack.

Each stage is (name, function of (spark, docs, sf_dir)). All but the last return
the columns of docs; a stage's rows are written as Parquet in the shared folder
and read again as the next one's docs. Rows are kept or dropped whole.

Null and empty texts: the quality classifier scores them like any text; language
identification rejects what has no letter. Repeated rows of one document, and
rows without a doc_id, are judged each on its own by the two filters; of a
group's rows deduplication keeps one, one without a doc_id only if none has one.
Other columns are carried, whatever their names. Very long texts are read whole.
An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import jaccard_join, language_id, packing, quality_classifier
from freshet.llm.queries import WORD_TOKENIZER
from freshet.llm.shared import fresh, table, written

#: A language prediction below this is none.
LEAST_LANGUAGE_SCORE = 0.4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or over it, by a model of the labelled
    documents among docs that are not held out."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    scored = quality_classifier.with_score(docs, model, score)
    return scored.filter(F.col(score) >= quality_classifier.THRESHOLD).select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; `und` and unsure ones go."""
    lang, score = fresh(docs, "lang_pred", "score")
    found = language_id.with_language(docs, language_id.fit(docs), lang, score)
    sure = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)
    return found.filter(sure).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of the smallest id, then class.

    Rows without an id come last; of a group in which none has one, one row of the
    smallest class stays. Rows without words stay.
    """
    groups = written(jaccard_join.grouped(docs.withColumn("doc_id", F.col("doc_id").cast("long"))))
    full = groups.filter("n_shingles > 0")
    last = F.col("doc_id").isNull().alias("last")
    first = full.groupBy(F.col("component").alias("_c")).agg(F.min(F.struct(last, "doc_id", "key")).alias("_s"))
    ranked = full.join(first, F.col("component") == F.col("_c"))
    stays = F.col("doc_id").eqNullSafe(F.col("_s.doc_id")) & (F.col("key") == F.col("_s.key"))
    judged = written(ranked.select("doc_id", "key", stays.alias("stays")))
    key, name = fresh(docs, "copy", "class")
    per_id = groups.filter("doc_id is not null").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("_n"))
    again = written(per_id.filter("_n > 1").select(key))
    gone = judged.filter(~F.col("stays"))
    copies = written(gone.filter("doc_id is not null").select(F.col("doc_id").alias(key)).union(again).distinct())
    # What an id alone does not tell, rows without one and of repeated ones, is told by the text's class.
    nameless = not judged.filter("doc_id is null").isEmpty()
    by_id = docs.filter("doc_id is not null") if nameless else docs
    parts = [by_id.join(jaccard_join.sized(copies), F.col("doc_id") == F.col(key), "left_anti")]
    if nameless:
        rows = jaccard_join.with_class(docs.filter("doc_id is null"), name)
        one = written(judged.filter("stays and doc_id is null").select(F.col("key").alias(key)).distinct())
        found = rows.join(jaccard_join.sized(one), F.col(name) == F.col(key), "left_semi")
        parts.append(found.dropDuplicates([name]).select(*docs.columns))
        parts.append(rows.filter(F.col(name).isNull()).select(*docs.columns))
    if not again.isEmpty():
        side = jaccard_join.sized(again)
        rows = jaccard_join.with_class(docs.join(side, F.col("doc_id") == F.col(key), "left_semi"), name)
        left = judged.filter("stays and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("key").alias(key))
        left = written(left.join(again.select(F.col(key).alias("_again")), F.col("_id") == F.col("_again"), "left_semi").distinct())
        found = rows.join(jaccard_join.sized(left), (F.col("doc_id") == F.col("_id")) & (F.col(name) == F.col(key)), "left_semi")
        parts.append(found.dropDuplicates(["doc_id", name]).select(*docs.columns))
        parts.append(rows.filter(F.col(name).isNull()).select(*docs.columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", deduplicated),
    ("best-fit packing", packed),
]

#: The models and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
