"""Documents to training tokens: five stages, each written and read again as the next one's documents.

1. language ID: documents without a letter, or long ones whose language stays ambiguous, go;
2. toxicity: documents more likely toxic than not go;
3. n-gram Jaccard join: of the documents that link by five-word shingles at 0.8 the one with the
   smallest id stays, whether ids are unique or not;
4. mixing: documents are repeated (0 to 3 times) so that sources come near their target weights;
5. byte-level BPE: every row that is left becomes token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm import bpe, langid, mixing, ngramjoin, toxicity
from barframe.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LONG = 200  # characters from which ambiguity speaks against a text


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language can be told; short texts may be ambiguous. The model learns
    from the ``lang`` of its own input; where that names no language, every document with a letter stays."""
    lettered, model = docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}")), langid.fit_languages(docs)
    if not model.labels:
        return lettered
    return langid.identify(lettered, model).where(~(F.col("ambiguous") & (F.length("text") >= LONG))).select(*COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not call toxic. It learns from the table of labels. A null or
    empty text is not toxic; repeated rows go or stay together. Only the columns of documents go on."""
    model = toxicity.fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), group="lang")
    return toxicity.severity(docs.select(*COLUMNS), model).where(~F.col("toxic")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id, null ids last, and of equal ids
    the first one read. Every row is a document of its own, so ids may be missing or used twice (rows
    then get stored tags, and the groups are of tags); rows without a word are in no group and all
    stay. Only the columns of documents go on."""
    like, rows = ngramjoin.Likeness(words=5, num=80, den=100), docs.select(*COLUMNS)
    if rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        groups = ngramjoin.jaccard_groups(rows.select("doc_id", "text"), like=like)
        return rows.join(groups.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*COLUMNS)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "join-rows")
    groups = ngramjoin.jaccard_groups(rows.select("row", "text"), doc_id="row", like=like)
    members = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = members.groupBy("component_id").agg(F.min(place).alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, 0 to 3 times. Every row is a document of its
    own, so ids may be missing or used twice; a null source is a source, and a text without words, which
    weighs nothing, is taken as its source is. Only the columns of documents go on."""
    rows = stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    copies = mixing.mix_sources(rows, tag="row").where("copies > 0").select(F.col("tag").alias("row"), "copies")
    repeated = rows.join(copies, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document row, packed as little-endian unsigned 32-bit integers. A null or empty
    text has none; repeated rows come out alike, and ids may be missing or used twice."""
    tokens = bpe.encode_texts(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tokens.select("doc_id", "lang", "source", F.expr("length(ids) div 4").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("ngram_join", one_of_each),
    ("mixing", to_target_weights),
    ("byte_bpe", encode),
]

#: SQL has no words for the learned stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
