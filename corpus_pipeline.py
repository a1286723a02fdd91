"""A training-data pipeline over ``documents``, in stages.

Each stage takes what the one before it kept, as documents; the last returns
token ids' digests. The order: documents rejected by the quality classifier go;
of equal texts and of near duplicates one document stays; sources are mixed to
target weights, where a document may be taken in several epochs, and the last
one of a source in part; texts are encoded.

Nulls, empty tables, repeated rows and extra columns are as the operators in
``lakeforge.llm`` state; columns beyond those of documents are not kept. A
document is its doc_id, null included, with its text: a stage decides on each
such pair. Rows that repeat both are one document from exact dedup on (the
smallest by lang, source and n_chars); a null text is an empty one there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import exact, minhash, mixing, quality, queries, store
from lakeforge.llm.rules import words_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _key(docs: DataFrame) -> DataFrame:
    """The documents' columns, with the digest of the text as ``text_sha256``."""
    return docs.select(*COLUMNS, F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def _same(id_col: str, sha_col: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(id_col)) & (F.col("text_sha256") == F.col(sha_col))


def _keep(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows whose doc_id, null included, and text are among ``decided``
    (doc_id, text_sha256)."""
    decided = decided.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    return _key(docs).join(decided, _same("kept_id", "kept_sha"), "left_semi").select(*COLUMNS)


def _once(docs: DataFrame) -> DataFrame:
    """One row of each doc_id and text: the smallest by the other columns. Only
    rows that are repeated are grouped with their texts."""
    keyed = _key(docs)
    groups = keyed.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("times")).where("times > 1")
    groups = store.save(groups.select(F.col("doc_id").alias("again_id"), F.col("text_sha256").alias("again_sha")), "repeated")
    if groups.isEmpty():
        return docs.select(*COLUMNS)
    single = keyed.join(groups, _same("again_id", "again_sha"), "left_anti").select(*COLUMNS)
    rows = keyed.join(groups, _same("again_id", "again_sha"), "left_semi")
    first = rows.groupBy("doc_id", "text_sha256").agg(F.min(F.struct("lang", "source", "n_chars", F.coalesce("text", F.lit("")).alias("text"))).alias("row"))
    return single.unionByName(first.select("doc_id", "row.*").select(*COLUMNS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below the classifier's threshold."""
    queries.ship(spark)
    docs = docs.select(*COLUMNS)
    model = quality.train(quality.features(docs), store.read_table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).where(F.col("score") >= model.cut).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays, as one row."""
    docs = _once(docs)
    return _keep(docs, exact.exact_groups(docs).where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8), the smallest id stays."""
    queries.ship(spark)
    return _keep(docs, minhash.near_groups(docs, k=5, percent=80).where("kept"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document and epoch in which it is taken; a document taken
    in part is cut to its first words, joined by single spaces."""
    docs = _key(_once(docs))
    taken = mixing.mix_documents(docs, queries.domain_of_source(), queries.MIX, also=("text_sha256",))
    taken = taken.select(F.col("doc_id").alias("of"), F.col("text_sha256").alias("of_sha"), "n_tokens", "take_tokens")
    rows = docs.join(taken, _same("of", "of_sha")).select(*COLUMNS, "n_tokens", "take_tokens")
    part = F.array_join(F.slice(words_of(F.col("text")), F.lit(1), F.col("take_tokens").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("take_tokens") < F.col("n_tokens"), part).otherwise(F.col("text")))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row. Ids are written
    first: one Python worker for each running task, not an encoder's and a
    decoder's, of which the next stages would keep both."""
    queries.ship(spark)
    return queries.piece_digests(store.save(queries.piece_ids(docs), "ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("sentencepiece encoding and decoding", encode_stage),
]

#: The classifier and the encoder can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each one's result is written and read again."""
    docs = store.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
