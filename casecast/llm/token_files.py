"""Token ids of a corpus in files that give single documents back fast: one shared dictionary, a frame per document."""

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casecast.llm.bpe import Words, bytes_of_characters, chunks, per_worker
from casecast.llm.common import DOC_ID, TEXT, broadcast_if_few, in_small_batches
from casecast.session import staged

# Fixed value: how the word-end vocabularies split a text; white space is dropped.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}"))
# The same where a byte 1 stands between stretches.
MARKED = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}\x01"))

#: Words whose ids a worker remembers, the longest of them in bytes (longer ones are soon forgotten), and how many words
#: are looked up at a time.
KNOWN_WORDS, KNOWN_LENGTH, STEP_WORDS = 1 << 18, 1024, 1 << 17
#: Code points from which a stretch without white space is encoded in parts.
LONG = 1 << 16
#: Text that is encoded at a time.
GROUP_BYTES = 1 << 20
#: Documents whose ids the dictionary is trained on, the longest of them in bytes, and the size of the dictionary.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 8192, 1 << 15
#: Bytes of frames in a block.
BLOCK_BYTES = 1 << 20
LEVEL = 3

FRAMES = "doc_id bigint, row bigint, n_tokens bigint, frame binary"
BLOCKS = (
    "part int, block int, least_id bigint, greatest_id bigint, n_docs bigint, n_tokens bigint, dictionary_sha256 string, "
    "width int, doc_ids array<bigint>, token_counts array<bigint>, offsets array<bigint>, payload binary"
)
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


class _Numbers(dict):
    """Numbers words in the order they are first asked for; `new` has those that were not asked for before."""

    def __init__(self):
        self.new = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEnds:
    """Ids of texts by a file of the `tokenizers` library.

    Where the file drops white space and lower-cases, nothing spans it, so ids are those of the words between, encoded by
    `tiktoken` from the same vocabulary once and remembered; texts are then a matter of looking words up. Its ids are the
    library's where ids follow the order of the merges and the end of a word is a byte that merges first of all. What
    that byte cannot stand for, and special tokens, are left to the library. Stretches of over `LONG` bytes are encoded in
    parts that end where a token always does, single words beyond that by `Words`, in bounded memory. Any other file
    is encoded text by text.
    """

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library, self.words = Tokenizer.from_file(path), None
        self.special = [token["content"] for token in spec.get("added_tokens", [])]
        self.by_word = self._drops_spaces(spec) and self._ordered(spec)
        if self.by_word:
            self.ranks = self._ranks(spec["model"]["vocab"])
            self.ends = tiktoken.Encoding("ends", pat_str=r"[^\x00\x01 ]+\x00|\x01", mergeable_ranks=self.ranks, special_tokens={})
            self.apart = self.ranks[b"\x01"]
            self.odd = [mark.encode() for mark in (*self.special, "\x00")]
            self._forget()

    @staticmethod
    def _ordered(spec):
        """Whether the ids of merged tokens follow the order of the merges."""
        vocab, merges = spec["model"].get("vocab"), spec["model"].get("merges", [])
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        made = [vocab.get(a + b, -1) for a, b in pairs] if isinstance(vocab, dict) else []
        return bool(made) and min(made) >= 512 and all(a < b for a, b in zip(made, made[1:]))

    def _ranks(self, vocab):
        """Ids by bytes, the end of a word being a byte 0 that merges with the byte before it first of all."""
        to_byte, ranks = bytes_of_characters(), {}
        for token, number in vocab.items():
            if token not in self.special:
                body = bytes(to_byte[c] for c in token.removesuffix("</w>"))
                end = b"\x00" if token.endswith("</w>") else b""
                if b"\x00" not in body or body + end == b"\x00":
                    ranks[body + end] = number
        return ranks

    @staticmethod
    def _drops_spaces(spec):
        kinds = [part.get("type") for part in (spec.get("normalizer") or {}).get("normalizers", [])]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        first, added = parts[0], spec.get("added_tokens", [])
        splits = first.get("pattern") == {"Regex": SPLIT} and first.get("behavior") == "Removed" and first.get("invert")
        plain = not any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        return bool(splits and plain and kinds == ["NFC", "Replace", "Lowercase"] and not spec.get("post_processor"))

    def _forget(self):
        self.known, self.held = _Numbers(), [(np.zeros(0, np.int64), np.zeros(0, np.uint32))]

    def _learn(self, words):
        """Hold the ids of `words`, in their order."""
        texts = {}
        text = b"\x01".join(words)
        if text.count(b"\x01") >= len(words) or max(map(len, words)) > LONG or any(mark in text for mark in self.odd):
            for i, word in enumerate(words):
                if len(word) > LONG or b"\x01" in word or any(mark in word for mark in self.odd):
                    texts[i] = word.decode()
            text = b"\x01".join(b"" if i in texts else word for i, word in enumerate(words))
        text = text.decode()
        text = text.lower() if text.isascii() else self.library.normalizer.normalize_str(text)
        ids = self.ends.encode_to_numpy(MARKED.sub("\\g<0>\x00", text) + "\x01").astype(np.uint32)
        apart = np.flatnonzero(ids == self.apart)
        sizes, ids = np.diff(apart, prepend=-1) - 1, np.delete(ids, apart)
        if texts:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, stretch in texts.items():
                parts[i] = self._long(stretch)
            sizes, ids = np.array([len(part) for part in parts]), np.concatenate(parts)
        self.held = [tuple(np.concatenate(pair) for pair in zip(*self.held, (sizes, ids)))]

    def _long(self, stretch):
        """Ids of a very long text without white space."""
        found = [np.zeros(0, np.uint32)]
        marks = "|".join(map(re.escape, self.special)) or "(?!)"
        at = 0
        for met in [*re.finditer(marks, stretch), None]:
            for part in chunks(stretch[at : met.start() if met else len(stretch)], LONG):
                if len(part) <= 2 * LONG:
                    found.append(np.array(self.library.encode(part, add_special_tokens=False).ids, np.uint32))
                else:
                    for word in WORDS.finditer(self.library.normalizer.normalize_str(part)):
                        found.extend(self._word(word[0]))
            if met:
                found.append(np.array([self.library.token_to_id(met[0])], np.uint32))
                at = met.end()
        return np.concatenate(found)

    def _word(self, word):
        """Ids of one word as the split gives it, as arrays. The end of a word is a byte that merges first."""
        if len(word) <= LONG or "\x00" in word:
            to_character = {byte: c for c, byte in bytes_of_characters().items()}
            symbols = "".join(to_character[byte] for byte in word.encode())
            return [np.array([token.id for token in self.library.model.tokenize(symbols)], np.uint32)]
        self.words = self.words or Words(self.ranks)
        return self.words.encode(word + "\x00")

    def __call__(self, texts):
        """The ids of UTF-8 `texts`, one array each."""
        if not self.by_word:
            done = self.library.encode_batch([text.decode() for text in texts], add_special_tokens=False)
            return [np.array(one.ids, np.uint32) for one in done]
        split = [text.split() for text in texts]
        words, ids, sizes = list(chain.from_iterable(split)), [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for at in range(0, len(words), STEP_WORDS):
            if len(self.known) > KNOWN_WORDS:
                self._forget()
            numbers = np.fromiter(map(self.known.__getitem__, words[at : at + STEP_WORDS]), np.int64)
            new = self.known.new
            if new:
                self._learn(new)
                self.known.new = []
            ((known_sizes, known_ids),) = self.held
            own = known_sizes[numbers]
            first = (np.cumsum(known_sizes) - known_sizes)[numbers] - np.cumsum(own) + own
            ids.append(known_ids[np.repeat(first, own) + np.arange(own.sum())])
            sizes.append(own)
            if new and max(map(len, new)) > KNOWN_LENGTH:
                self._forget()
        ends = np.cumsum(np.concatenate(sizes))[np.cumsum([len(own) for own in split])]
        return np.split(np.concatenate(ids), ends[:-1])


def _groups(batches):
    """(ids, UTF-8 texts) of about `GROUP_BYTES`."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = text.as_py() or b""
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
            if held > GROUP_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def serialised(ids, width):
    return ids.astype(f"<u{width}").tobytes()


def _encoder(path):
    return per_worker(f"words of {path}", lambda: WordEnds(path))


def _samples(path, end_id, width):
    def run(batches):
        encode = _encoder(path)
        for _, texts in _groups(batches):
            ids = [serialised(np.append(one, np.uint32(end_id)), width) for one in encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    return run


def train_dictionary(docs, tokenizer, end_id, width, id_col=DOC_ID, text_col=TEXT):
    """A zstandard dictionary for the ids of short documents, as bytes; empty if there is nothing to learn from.

    It is trained on `SAMPLE_DOCS` documents of at most `SAMPLE_BYTES`, those of the least hash of their id, so it is the
    same in every run and does not grow with the corpus. Too few samples to train on are taken as they are.
    """
    short = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    short = short.where(F.octet_length("text").between(1, SAMPLE_BYTES))
    sample = short.orderBy(F.xxhash64("id"), "id", "text").limit(SAMPLE_DOCS)
    samples = [bytes(r.ids) for r in sample.mapInArrow(_samples(tokenizer, end_id, width), "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _codec(dictionary):
    """What compresses and what decompresses a frame."""
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def _frames(path, end_id, width, dictionary):
    def run(batches):
        encode, (packer, _) = _encoder(path), _codec(dictionary)
        row = TaskContext.get().partitionId() << 33
        for doc_ids, texts in _groups(batches):
            ids = [np.append(one, np.uint32(end_id)) for one in encode(texts)]
            frames = [packer.compress(serialised(one, width)) for one in ids]
            columns = [
                pa.array(doc_ids, pa.int64()),
                pa.array(range(row, row + len(ids)), pa.int64()),
                pa.array([len(one) for one in ids], pa.int64()),
                pa.array(frames, pa.binary()),
            ]
            row += len(ids)
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_tokens", "frame"])

    return run


def _blocks(digest, width):
    names = [part.split(" ")[0] for part in BLOCKS.split(", ")]
    kinds = [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.string(), pa.int32()] + [pa.list_(pa.int64())] * 3 + [pa.binary()]

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, counts, frames, held = [], [], [], 0

        def block():
            known = [i for i in ids if i is not None]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            row = (part, number, min(known, default=None), max(known, default=None), len(ids), sum(counts), digest, width)
            row += (ids, counts, offsets, b"".join(frames))
            return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds)], names)

        for batch in batches:
            for doc_id, count, frame in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                ids.append(doc_id)
                counts.append(count)
                frames.append(frame)
                held += len(frame)
                if held >= BLOCK_BYTES:
                    yield block()
                    number, ids, counts, frames, held = number + 1, [], [], [], 0
        if ids:
            yield block()

    return run


def write_token_files(docs, path, tokenizer, end_id=1, id_col=DOC_ID, text_col=TEXT):
    """Write the ids of every document to `path`, a folder of any file system that Spark reaches.

    `blocks/` has the documents in ascending order of their ids, files and rows alike. A row is a block of about
    `BLOCK_BYTES`: each document's ids (the text's, then `end_id`; little-endian, two bytes wide where the vocabulary
    allows, else four) as a zstandard frame of its own, the frames one after the other in `payload`, and `offsets`,
    where each begins. `dictionary/` has the dictionary that all frames share; every block names its SHA-256, so frames
    are never read with another. `index/` has each block's first position in the corpus and its range of ids, which
    leads a reader to one document without reading the others.

    Documents are encoded and compressed where they are read; only frames are sorted, by ranges of id and input row, so
    a range of one repeated id can be cut as well. Positions come from the sums of blocks.

    Defined cases: a null or empty text is the end id alone. A very long text is one frame, encoded in parts. Rows that
    repeat an id, or have none, are kept one by one; null ids come first, and rows of one id in the order they are
    read. Only the two named columns are read. An empty table gives files without rows.
    """
    spark = docs.sparkSession
    sized = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    width = 2 if max(sized, end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end_id, width, id_col, text_col)
    digest = hashlib.sha256(dictionary).hexdigest()
    names = spark.createDataFrame(pa.table({"dictionary_sha256": [digest], "dictionary": pa.array([dictionary], pa.binary())}))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frames = in_small_batches(texts).mapInArrow(_frames(tokenizer, end_id, width, dictionary), FRAMES)
    frames = staged(frames, "token-frames")
    order = [F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    ranges = in_small_batches(frames).repartitionByRange(*order).sortWithinPartitions(*order)
    names.write.parquet(f"{path}/dictionary")
    ranges.mapInArrow(_blocks(digest, width), BLOCKS).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each task
    starts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_start"))
    earlier = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("block")), F.lit(0))
    within = blocks.select("part", "block", "least_id", "greatest_id", "n_docs", "n_tokens", earlier.alias("earlier"))
    index = within.join(starts, "part").withColumn("start", F.col("part_start") + F.col("earlier"))
    index.select("part", "block", "start", "least_id", "greatest_id", "n_docs", "n_tokens").write.parquet(f"{path}/index")


def _documents(digest, dictionary, only):
    def run(batches):
        _, unpacker = _codec(dictionary)
        for batch in batches:
            for block in batch.to_pylist():
                if block["dictionary_sha256"] != digest:
                    raise ValueError(f"a block was written with dictionary {block['dictionary_sha256']}, the folder has {digest}")
                at, rows, held = block["start"], [], 0
                for i, (doc_id, count) in enumerate(zip(block["doc_ids"], block["token_counts"])):
                    if only is None or doc_id in only:
                        frame = block["payload"][block["offsets"][i] : block["offsets"][i + 1]]
                        ids = unpacker.decompress(frame)
                        if block["width"] != 4:
                            ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                        rows.append((doc_id, at, count, ids))
                        held += len(ids)
                    at += count
                    if held > 4 * BLOCK_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows):
    kinds = [pa.int64()] * 3 + [pa.binary()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


def read_token_files(spark, path, doc_ids=None):
    """`doc_id`, `start` (ids of all documents before it), `n_tokens` and `ids` (little-endian unsigned 32-bit) of every
    document in the files, or of those in `doc_ids`, a short list: then only blocks that can hold them are read, and of
    these only the frames asked for."""
    names = spark.read.parquet(f"{path}/dictionary").first()
    only = None if doc_ids is None else set(doc_ids)
    index = spark.read.parquet(f"{path}/index")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    if only is not None:
        near = F.lit(False)
        for doc_id in sorted(only):
            near |= (F.col("least_id") <= doc_id) & (F.col("greatest_id") >= doc_id)
        index, blocks = index.where(near), blocks.where(near)
    starts = broadcast_if_few(index.select("part", "block", "start"), 1 << 16)
    rows = blocks.join(starts, ["part", "block"]).select(
        "dictionary_sha256", "width", "doc_ids", "token_counts", "offsets", "payload", "start"
    )
    return in_small_batches(rows).mapInArrow(_documents(names.dictionary_sha256, bytes(names.dictionary), only), DOCUMENTS)
