"""From raw documents to packed training sequences: each stage is written as Parquet and read again by the next."""

from pyspark.sql import functions as F

from casecast.llm.common import table
from casecast.llm.lines import dedup_lines
from casecast.llm.mixing import mix
from casecast.llm.packing import pack
from casecast.llm.quality import keep_good
from casecast.llm.queries import tokenizer_path, training_labels
from casecast.llm.simhash import keep_one
from casecast.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark, docs, sf_dir):
    """Documents whose quality score is below 0.3 go. Null and empty texts are scored like any other."""
    return keep_good(docs, training_labels(spark, sf_dir), threshold=0.3).select(*COLUMNS)


def line_dedup(spark, docs, sf_dir):
    """Lines of 20 code points that three documents hold stay in one. Every document stays, if need be empty."""
    kept = dedup_lines(docs.select(*COLUMNS), min_chars=20, min_docs=3)
    whole = kept.withColumn("text", F.col("kept")).withColumn("n_chars", F.char_length("kept").cast("bigint"))
    return whole.select(*COLUMNS)


def near_dedup(spark, docs, sf_dir):
    """Of documents whose fingerprints are linked by two or fewer differing bits the one of the smallest id stays.

    Texts that are null or empty are copies of each other. Rows without an id stay; of repeated rows one does.
    """
    return keep_one(docs.select(*COLUMNS), shingle=3, max_bits=2)


def mixing(spark, docs, sf_dir):
    """Sources at their target weights: a document is repeated as often as the mix takes it, up to three times.

    A null source is a source. Documents without words count nothing and follow their hash like any other.
    """
    taken = mix(docs.select(*COLUMNS), weights=(5, 2, 1), max_repeats=3)
    return taken.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def packing(spark, docs, sf_dir):
    """Sequences of 1024 ids, as `pack` returns them. A null or empty text is the end id alone."""
    return pack(docs, tokenizer_path(), capacity=1024, end_id=0)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the fitted classifier nor the tokeniser.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
