"""One query per operator over the test tables: name -> f(spark, sf_dir) -> DataFrame."""

import hashlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecast.llm.chat import format_reply_trees, linear_replies, masked_text, parse_turns
from casecast.llm.common import sha256, table
from casecast.llm.lexical import search
from casecast.llm.lines import dedup_lines
from casecast.llm.mixing import mix
from casecast.llm.packing import pack
from casecast.llm.pii import summary, with_private
from casecast.llm.quality import fit_quality, statistics_table
from casecast.llm.simhash import hex_digits, near_duplicates
from casecast.llm.sketch import as_text, resemblance, with_next, with_sketches
from casecast.llm.suffixes import remove_repeats
from casecast.llm.token_files import read_token_files, write_token_files
from casecast.llm.topk import quantised, top_k
from casecast.llm.trie import prefix_trie
from casecast.session import scratch_path, small_table

#: Ids of the byte-level vocabulary that the packed documents are made of.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name=TOKENIZER):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", hex_digits().alias("fingerprint"), "component_id")


def op2_packing(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to"
    )


# A conversation whose texts are control strings of the template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"
CONTROL_ROWS = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]


READ = (
    T.StructType()
    .add("n_turns", T.LongType())
    .add("turns_sha256", T.StringType())
    .add("loss_chars", T.LongType())
    .add("loss_sha256", T.StringType())
)


@F.pandas_udf(READ)
def _read_back(formatted: pd.Series, mask: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(formatted, mask):
        turns = parse_turns(text)
        said = "".join(f"{role}\n{words}\n" for role, words in turns)
        loss = "".join(masked_text(text, [(span["start"], span["end"]) for span in spans]))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        rows.append((len(turns), digests[0], len(loss), digests[1]))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])


def op3_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = small_table(spark, CONTROL_ROWS, "conv_id bigint, turn bigint, role string, text string")
    done = format_reply_trees(linear_replies(given.unionByName(control)), null_conversation=True)
    read = done.select("conv_id", "formatted", _read_back("formatted", "mask").alias("read"))
    return read.select("conv_id", "read.*", F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op4_exact_top_k(spark, sf_dir):
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    hits = top_k(vectors.where("id % 50 = 0"), vectors, k=5)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def held_out(doc_id="doc_id"):
    """The fifth of all documents whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").where(~held_out())


def op5_quality_classifier(spark, sf_dir, threshold=0.3):
    found = statistics_table(table(spark, sf_dir, "documents"))
    score = fit_quality(found, training_labels(spark, sf_dir)).score(F.col("statistics"))
    scored = found.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_line_dedup(spark, sf_dir):
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return done.select("doc_id", "n_lines", "n_dropped", sha256("kept").alias("kept_sha256"))


def op7_private_data(spark, sf_dir):
    found = with_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    added = F.size(F.filter("spans", lambda s: ~s["strict"])).cast("bigint").alias("n_added")
    return found.select("doc_id", *summary(), added)


def op8_document_fingerprints(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = F.char_length("text")
    changed = F.floor(chars / 4).cast("int")
    rows = with_next(documents, "doc_id", ["text"])
    rows = rows.withColumn("n_chars", chars.cast("bigint")).withColumn(
        "edited", F.concat(F.left("text", chars - changed), F.left("next_text", changed))
    )
    names = {"text": "sketch", "edited": "edited_sketch", "next_text": "next_sketch"}
    return with_sketches(rows, names).select(
        "doc_id",
        "n_chars",
        sha256("edited").alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
    )


def op9_mixing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).cast("bigint").alias("taken")
    return mix(documents, weights=(5, 2, 1), max_repeats=3).select("doc_id", "size", "source_size", "target", taken)


def op10_suffix_array_dedup(spark, sf_dir):
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), width=50)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256("kept").alias("kept_sha256"))


def op11_ranked_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


#: Ids of the vocabulary with word ends that the token files are made of.
FILE_TOKENIZER = "word_bpe_49k.json"


def op12_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(FILE_TOKENIZER), end_id=1)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"), head_turns=6, group=100)


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_packing": op2_packing,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_line_dedup": op6_line_dedup,
    "op7_private_data": op7_private_data,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_mixing": op9_mixing,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}
