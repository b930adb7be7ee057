"""The operators of this subpackage over the given tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.llm import (
    bpe,
    decontamination,
    html,
    merkle,
    minhash,
    pieces,
    quality,
    sharding,
    suffix_tree,
    suffixes,
    urls,
    warc,
    whitening,
)
from incidentlens.llm.oracle import oracle_sql as oracle_sql
from incidentlens.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    (urls.BLOCK, "net", "/"),
    (urls.ALLOW, "example.net", "/en/"),
    (urls.BLOCK, "example.com", "/de/"),
    (urls.ALLOW, "org", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = bpe.VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(_table(spark, sf_dir, "documents"), vocabulary_path()))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.digests(decontamination.contamination(documents, items))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    return warc.read(warc.write(_table(spark, sf_dir, "pages"), folder), folder)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.judged(documents, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.kept_first(minhash.groups(_table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.slotted(sharding.shard(_table(spark, sf_dir, "documents")))


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of labelled documents: a page's path has its document's number.

    Unwanted are documents of bad quality and toxic ones.
    """
    number = F.regexp_extract(urls.path_of(F.col("url")), r"/(\d{1,18})(?:\D|$)", 1)
    pages = _table(spark, sf_dir, "pages").select("url", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))
    unwanted = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = _table(spark, sf_dir, "labels").select("doc_id", unwanted.alias("unwanted"))
    return pages.join(labels, "doc_id").select("url", "unwanted")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = urls.mine(labelled_urls(spark, sf_dir))
    return urls.judged(_table(spark, sf_dir, "pages"), mined, URL_RULES)


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(_table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extracted(pages, html.learned(pages))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return pieces.digests(pieces.encode_decode(documents, vocabulary_path(pieces.VOCABULARY)))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"), merkle.hit_by_crc(F.col("doc_id")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_decontamination": op2_decontamination,
        "op3_warc": op3_warc,
        "op4_quality": op4_quality,
        "op5_suffixes": op5_suffixes,
        "op6_minhash": op6_minhash,
        "op7_sharding": op7_sharding,
        "op8_urls": op8_urls,
        "op9_suffix_tree": op9_suffix_tree,
        "op10_html": op10_html,
        "op11_pieces": op11_pieces,
        "op12_merkle": op12_merkle,
        "op13_whitening": op13_whitening,
    }
