"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept;
all but the last return the columns of ``docs``.  ``run`` writes each stage's rows to the
shared folder and rereads them as the next one's input.

NULL and empty texts, repeated rows, NULL ids and very long texts pass through every stage
under the rule that its operator states; an empty table gives an empty one.  Columns of
``documents`` beyond those of the table, whatever their names, come back as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse.llm import decontaminate, line_dedup, packing, simhash, toxicity
from memberpulse.llm.common import Workspace, temporary_tables
from memberpulse.llm.queries import table


def _nested(docs: DataFrame) -> DataFrame:
    """The rows whole, beside what an operator reads: none of its own columns can replace one of theirs."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the table of labels.

    NULL and empty texts are scored like any other; rows with a NULL id are scored, but not learned from.
    """
    scored = toxicity.toxicity(_nested(docs), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated lines go; so do documents that have no word left by that.

    ``n_chars``, where there is one, is counted anew for documents that lost lines; all other columns stay.
    """
    cleaned = line_dedup.dedup_lines(_nested(docs))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fields = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
        fields["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return cleaned.where(~emptied).select(*[fields.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays; wordless texts are one group, NULL ids come last."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the table of benchmark items go; NULL and wordless texts hold none."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that are left, packed into sequences; NULL and empty texts are one piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The toxicity classifier and the tokenizer can't be written in SQL; tests hold every stage to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``.

    What a stage's operator has staged is removed once the stage's rows are written; the
    tables that the last stage's lazy rows read stay until the caller is done with them
    (``temporary_tables``).
    """
    ws = Workspace(spark)
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with temporary_tables():
            docs = ws.stage(name, stage(spark, docs, sf_dir))
        if last:
            ws.drop(last)
        last = name
        ws.release()
    return STAGES[-1][1](spark, docs, sf_dir)
