"""From raw documents to packed training sequences: five stages, each written and read again before the next.

Toxic documents go; boilerplate lines go from all documents but the first that has them; of each group of near copies the
first document stays; documents with passages of the benchmark go; what is left is packed into windows.

Every stage takes any table of documents: the columns that are read are doc_id, text and, for line dedup, source; n_chars is
put right where it is there. Null ids and repeated rows are documents of their own, null and empty texts are texts without
words; other columns pass, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import toxicity as tox
from pulseframe.llm.common import clear, noted, staged, table, with_row_id
from pulseframe.llm.decontamination import decontaminate
from pulseframe.llm.line_dedup import dedup_lines
from pulseframe.llm.packing import pack
from pulseframe.llm.simhash import near_duplicates

#: Near copies: word shingles, and their least Jaccard similarity.
SHINGLE, SIMILARITY = 5, 0.8


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named c0, c1, ..., so that no name of an operator's own meets one of theirs; and which is which."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), {c: f"c{i}" for i, c in enumerate(docs.columns)}


def _named(plain: DataFrame, docs: DataFrame) -> DataFrame:
    return plain.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier predicts to be toxic. It learns from the labelled rows of docs that are not held out; where
    those are not of both kinds it knows no toxic text from another, and all stay."""
    rows, c = _plain(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(c["doc_id"]), "toxic")
    model = tox.fit(rows, labels, c["doc_id"], c["text"])
    if not len(model.weight):
        return docs
    return _named(tox.score(rows, model, c["doc_id"], c["text"]).where("predicted = 0"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines; all documents stay."""
    rows, c = _plain(docs)
    kept = dedup_lines(rows, c["doc_id"], c["text"], c["source"])
    if "n_chars" in c:
        kept = kept.withColumn(c["n_chars"], F.length(c["text"]).cast(docs.schema["n_chars"].dataType))
    return _named(kept, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of exact and near copies; a null id comes last, rows with the same id
    by their place in the table."""
    rows, c = _plain(docs)
    rows = with_row_id(rows)
    groups = near_duplicates(rows, "_row", c["text"], shingle=SHINGLE, similarity=SIMILARITY)
    named = groups.join(rows.select("_row", F.col(c["doc_id"]).alias("id")), "_row")
    first = named.groupBy("component_id").agg(F.min_by("_row", F.struct(F.col("id").isNull().alias("none"), "id", "_row")).alias("_row"))
    return _named(rows.join(first, "_row", "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark."""
    rows, c = _plain(docs)
    rows = with_row_id(rows)
    hit = decontaminate(rows, table(spark, sf_dir, "benchmark"), c["doc_id"], c["text"], row_col="_row").where("contaminated").select("_row")
    return _named(rows.join(hit, "_row", "left_anti"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, see pack()."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier, 64-bit fingerprints and a tokenizer's ids are beyond SQL; tests/llm checks each stage by itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        with noted() as own:
            last, docs = docs, staged(stage(spark, docs, sf_dir), f"stage{i}")
        # what the stage staged on its way, and what it read, is not needed any more
        clear(spark, [p for p in own if p != docs.staged_at] + ([last.staged_at] if i else []))
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
