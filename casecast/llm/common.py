"""What the operators share: how words are told apart, row keys, and small expressions."""

from pyspark.sql import functions as F

# The characters that separate words, and what a word is.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

DOC_ID = "doc_id"
TEXT = "text"


#: Texts reach Python in Arrow batches of 10,000 rows by default, however long they are. With this setting a batch also
#: ends at so many bytes.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def in_small_batches(df):
    """`df`, in a session whose Arrow batches are bounded in bytes; a bound that the user set lower stays."""
    conf = df.sparkSession.conf
    bound = conf.get(BATCH_SETTING).removesuffix("b")
    if bound.isdigit() and int(bound) > BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column=TEXT):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(column):
    return F.translate(column, UPPER, UPPER.lower())


def word_count(column=TEXT):
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("bigint")


def sha256(column):
    """Lowercase hex digest of a binary column, or of a string's UTF-8."""
    return F.sha2(column, 256)


def row_key(id_col, text_col):
    """Names a row by its id and its text, so that rows which share an id but not the text are told apart."""
    text = text_or_empty(text_col)
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.char_length(text).alias("n"))


def broadcast_if_few(df, rows):
    """`df` marked for broadcast if it has at most `rows` rows, which its caller knows to be narrow; else as it is."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).collect()) <= rows else df
