"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

Quality rules drop documents; the n-gram Jaccard join leaves one document of each group;
passages of 50 words that repeat go; secrets are blotted out; best fit packs what is left.
Every stage but the last returns the columns of ``documents``, with ``n_chars`` following the
text where there is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seine.llm.chosen_path import jaccard_classes
from seine.llm.packing import pack_documents
from seine.llm.quality import judge
from seine.llm.queries import PASSAGE, WORD_BPE, table
from seine.llm.secrets import find_secrets
from seine.llm.shared import drop, scope, text_digest, written
from seine.llm.suffix_dedup import remove_repeats


def _with_text(rows: DataFrame, text: str) -> DataFrame:
    """The kept columns with another text."""
    columns = rows.schema["_kept"].dataType.names
    changed = {"text": F.col(text), "n_chars": F.length(F.col(text)).cast("long")}
    return rows.select(*(changed.get(c, F.col("_kept").getField(c)).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base or the posterior rejects.

    A null, empty or very short text goes; a very long one is judged whole; rows that repeat are
    judged alike, whatever their ids. An empty table gives no rows.
    """
    return judge(docs, docs.columns).where("kept").select(*(F.col("_kept").getField(c).alias(c) for c in docs.columns))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row: that of the least id, a null id last; rows without words stay.

    Rows are told apart by id and text, so rows of one id are in classes of their texts; of
    rows that repeat both, one stays.
    """
    classes = written(jaccard_classes(docs, row_keys=True).select("doc_id", "td", "stays", "has_words"), "classes")
    keyed = docs.select(F.struct(*docs.columns).alias("_kept"), F.col("doc_id").cast("long").alias("_id"), text_digest(F.col("text")).alias("_td"))
    same = keyed["_id"].eqNullSafe(F.col("doc_id")) & (keyed["_td"] == F.col("td"))
    among = lambda keys, how: keyed.join(keys.hint("merge"), same, how)
    later = classes.where("not stays").select("doc_id", "td").distinct()
    repeated = written(classes.where("stays and has_words").groupBy("doc_id", "td").count().where("count > 1").select("doc_id", "td"), "repeated")
    if repeated.isEmpty():
        left = among(later, "left_anti")
    else:
        left = among(later.union(repeated), "left_anti").union(among(repeated, "left_semi").dropDuplicates(["_id", "_td"]))
    return left.select(*(F.col("_kept").getField(c).alias(c) for c in docs.columns))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that start in two places or more.

    All occurrences go alike; a null text becomes an empty one, texts of fewer words stay as they
    are, and a repeated row repeats its text. No row goes, and an empty table gives none.
    """
    return _with_text(remove_repeats(docs, docs.columns, length=0, words=PASSAGE, texts=True), "kept_text")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by its kind.

    Null and empty texts stay as they are, long ones are scanned whole, repeated rows stay
    repeated, and an empty table gives no rows.
    """
    return _with_text(find_secrets(docs, docs.columns, redacted=True), "redacted_text")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences.

    A null or empty text is its end id alone; longer texts than a sequence are cut into pieces;
    each repeated row is packed; an empty table gives no rows.
    """
    return pack_documents(docs, WORD_BPE, end_id=1, size=4096)


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("suffix_dedup", suffix_dedup), ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]
#: The model, the sampled paths and the tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with scope(spark) as keep:
            out = keep(written(stage(spark, docs, sf_dir), name))
        if k:
            drop(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
