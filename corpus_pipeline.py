"""The cleaning pipeline over ``documents``: each stage calls one operator.

A stage takes the session, the documents that the stage before it kept, and the folder of the
tables. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isospread.llm import decontam, jaccard, linededup, mix, toxicity
from isospread.sources.storage import scratch_path


#: The column with a text's length while a stage works.
LENGTH = "__n_chars"
#: Rows that go to a Python worker at once, and the setting. Spark's 10,000 documents take some
#: 20 MB, which an executor holds several times for each core: beside the vectors, in the message,
#: and in the worker.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Where it is on, Spark starts the Python workers of DataFrames with a variable that those of
#: RDDs lack, and keeps two sets of workers beside each executor, of which one is idle.
TRACEBACK_SETTING = "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled"


def _spare_memory(spark: SparkSession) -> None:
    """Lower the session's rows of a batch to ``BATCH_ROWS``, and let the stages on RDDs use the
    same Python workers as those on DataFrames; no result depends on either, and an error in a
    worker is told with Spark's own lines."""
    rows = int(spark.conf.get(BATCH_SETTING))
    if not 0 < rows <= BATCH_ROWS:  # 0 and less mean no bound
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    spark.conf.set(TRACEBACK_SETTING, "false")


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the documents with all columns but id and text under names of their own, so that
    none clashes with a column that an operator adds; the names are put back afterwards."""
    known = {"doc_id": "doc_id", "text": "text", "n_chars": LENGTH}
    others = [c for c in docs.columns if c not in known]
    names = known | {c: f"__column_{i}" for i, c in enumerate(others)}
    done = work(docs.select(*(F.col(f"`{c}`").alias(names[c]) for c in docs.columns)))
    return done.select(*(F.col(names[c]).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score is 0.5 or more.

    The session keeps the settings that this stage makes, for the later stages too.
    """
    _spare_memory(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0))

    def clean(docs: DataFrame) -> DataFrame:
        index = toxicity.fit(docs, labels, crc % 5 != 0)
        return toxicity.score(docs, index, docs.columns).where("predicted = 0")

    return _apart(docs, clean)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier one nearly equals; a document left without any words goes.

    A column ``n_chars`` is brought up to date where lines go.
    """

    def cut(docs: DataFrame) -> DataFrame:
        found = linededup.dedup_lines(docs, docs.columns)
        emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))
        found = found.where(~emptied).withColumn("text", F.col("kept_text"))
        if LENGTH in docs.columns:
            length = F.length("text").cast(docs.schema[LENGTH].dataType)
            changed = F.when(F.col("n_removed") > 0, length).otherwise(F.col(LENGTH))
            found = found.withColumn(LENGTH, changed)
        return found

    return _apart(docs, cut)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    return _apart(docs, jaccard.one_of_each)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apart(docs, lambda d: decontam.find_items(d, benchmark, d.columns).where("n_hit = 0"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words, and which, a mix of the sources takes of each document."""
    return mix.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

#: The stages rest on learned models, hashes and seeded draws, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return done
        path = scratch_path(spark, f"stage-{number}")
        done.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
