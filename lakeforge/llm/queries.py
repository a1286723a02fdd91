"""Registered queries of the training-data operators, one for each, and their
DuckDB statements where SQL can state the result (see ``sql.py``)."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import exact, interpolate, minhash, mixing, negatives, piece_codec, quality, rules, sql, store, substring, urls, warc, wavelet, whiten

PIECE_MODEL, WORD_MODEL = "piece_bpe_32k.model", "word_bpe_49k.json"

# The rules (host, path, verdict) that pages are judged by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Production mix: the domain of a source, node weights, share of the tokens.
DOMAINS = {0: "web", 1: "books", 2: "code", 3: "reference"}
MIX = mixing.Mix(
    weights={("web",): 4, ("books",): 3, ("code",): 1, ("reference",): 2, ("web", "en"): 5, ("books", "en"): 3, ("web", "en", "src0"): 2},
    percent=75, max_epochs=3, seed="mix-1",
)


def domain_of_source(source: str = "source"):
    """Domain by the number in a source's name, modulo 4; 'web' without one."""
    number = F.coalesce(F.expr(f"try_cast(nullif(regexp_extract(`{source}`, '([0-9]+)$', 1), '') as bigint)"), F.lit(0)) % 4
    out = F.lit(DOMAINS[0])
    for k, name in DOMAINS.items():
        out = F.when(number == k, name).otherwise(out)
    return out


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Give the package to executors, once per session."""
    context = spark.sparkContext
    if getattr(context, "_lakeforge_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "lakeforge.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._lakeforge_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_table(spark, sf_dir, "pages")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir), domain_of_source(), MIX)


def piece_ids(docs: DataFrame) -> DataFrame:
    return piece_codec.encode(docs, tokenizer_path(PIECE_MODEL))


def piece_digests(encoded: DataFrame) -> DataFrame:
    return piece_codec.decode(encoded, tokenizer_path(PIECE_MODEL)).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(piece_ids(documents(spark, sf_dir)))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir), k=3, percent=85, distinct_texts=False).drop("text_sha256")


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda s, n: s + n)
    return substring.find_repeats(documents(spark, sf_dir), length=13).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(pages(spark, sf_dir), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.features(documents(spark, sf_dir))
    model = quality.train(found, store.read_table(spark, sf_dir, "labels"))
    return quality.score(found, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))


def op8_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = wavelet.write_shards(documents(spark, sf_dir), store.new_dir(spark, "tokens"), tokenizer_path(WORD_MODEL), end_id=1)
    return wavelet.read_shards(spark, manifest, wavelet.crc32_le).withColumnRenamed("digest", "ids_crc32")


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(pages(spark, sf_dir), store.new_dir(spark, "warc"), min_bytes=0)
    return warc.read_warc(spark, manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.read_table(spark, sf_dir, "embeddings")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.components(embeddings(spark, sf_dir), "vec_id", "embedding", most=32, scale=whiten.Scale(64, 1_000_000))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return interpolate.score(documents(spark, sf_dir), held_out, order=2)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(embeddings(spark, sf_dir).withColumn("label", label), F.col("id") % 50 == 0, times=256)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_mixing, op2_sentencepiece, op3_minhash, op4_substring, op5_url_filter, op6_exact, op7_quality, op8_wavelet, op9_host_rules, op10_warc, op11_whitening, op12_lm_score, op13_hard_negatives, pipeline]


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _shipped(q) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
