"""A corpus pipeline: quality, toxicity, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.  ``run`` writes each stage's result to the shared folder and reads it again for
the next one, so a lost executor never sends the work back over earlier stages.

All stages keep the columns of their input as they are, whatever their names, but for ``text`` and
``n_chars`` where personal data is replaced; the last returns packing's own. An empty table gives an
empty result in every stage. Null and empty texts are scored as empty texts, link with nothing, hold
no personal data and are packed as an end id alone. Repeated rows are judged alike: the classifiers
and the replacing keep as many as come in, near duplicates keep all rows of a doc_id that stays, and
each row is packed. Very long texts are read whole in every stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from trajkit.llm import neardup, packing, pii, quality, toxicity
from trajkit.llm.blocks import vocabulary
from trajkit.session import table, written


#: Rows in a batch between Spark and Python workers, for all stages: workers of several stages stay on
#: an executor side by side, and batches of 10000 rows (the default) hold much of its memory.
BATCH_ROWS = 2000


def lean(stage):
    """``stage`` with batches of ``BATCH_ROWS`` rows.

    A stage's result is computed after the stage has returned, so the setting stays in the session.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return quality.filter_rows(docs, model, lambda score: score < 0.5)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, by shingles of five words and a similarity of 0.8."""
    return neardup.drop_near_duplicates(docs, width=5, percent=80)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality", lean(keep_quality)),
    ("toxicity", lean(keep_clean)),
    ("near duplicates", lean(drop_duplicates)),
    ("personal data", lean(redact_private)),
    ("packing", lean(pack)),
]

#: Trained classifiers and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
