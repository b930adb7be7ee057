"""The corpus pipeline: documents to token ids.

Quality rules, near-duplicate removal, removal of repeated passages, benchmark
decontamination, BPE encoding. Each stage works on all that the one before has kept;
all but the last return the columns of ``documents``. A document goes if the quality
rules reject it, if it is not the first of its group of near duplicates, or if it
has words of a benchmark window; repeated passages are cut out of the text.

Rows are told apart by a number of the stage's own, so that a missing or repeated
doc_id doesn't give one row's verdict to another. The first of a group has the
smallest doc_id, a missing one coming last; of rows with equal doc_id and text one
stays. A label holds for all rows of its doc_id.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.llm import bpe, decontamination, minhash, quality, suffixes
from incidentlens.llm.queries import vocabulary_path
from incidentlens.llm.rows import ROW, numbered, without_keys
from incidentlens.sources.scratch import remove, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows that go to a Python worker at once: texts are long, and stages follow each other on executors
#: whose heaps have grown.
ROWS_AT_ONCE = 1000


def _small_batches(spark: SparkSession) -> None:
    """Smaller batches for this session, from now on: stages are run after they return."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS_AT_ONCE:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = numbered(docs, "doc_id", "text")
    labelled = rows.select(ROW, "doc_id").join(labels, "doc_id").select(ROW, "quality", "toxic")
    rejected = quality.judged(rows, labelled, ROW).where("NOT kept")
    return without_keys(rows, rejected, ROW).drop(ROW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    rows = numbered(docs, "doc_id", "text", collapsed=True)
    copies = minhash.kept_first(minhash.groups(rows, ROW), ROW).where("NOT kept")
    return without_keys(rows, copies, ROW).drop(ROW)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    # Half the usual blocks and buckets: their Python workers are the largest of all stages.
    cut = suffixes.without_repeats(
        numbered(docs, "doc_id", "text"), ROW, carried=others, as_text=True, block_bytes=4 << 20, bucket_bytes=8 << 20
    )
    return cut.select(
        F.col("kept").alias("text"), "more.*", F.length("kept").cast("long").alias("n_chars")
    ).select(*docs.columns)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(docs, "doc_id", "text")
    hits, _ = decontamination.occurrences(rows, items, ROW)
    return without_keys(rows, hits.select(F.col("doc").alias(ROW)), ROW).drop(ROW)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    # A quarter of the usual block, for the same reason.
    return bpe.digests(bpe.encode_decode(docs, vocabulary_path(), block_bytes=4 << 20), more=["ids"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("contaminated", contaminated),
    ("token_ids", token_ids),
]

#: Trained verdicts, connected components and BPE are beyond SQL; tests/llm has the pipeline's brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        new = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(new)
        docs, old, path = spark.read.parquet(new), path, new
        if old:
            remove(spark, old)
    return docs
