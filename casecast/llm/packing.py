"""Harmonic packing of tokenised documents into sequences of a fixed capacity."""

import json
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casecast.llm.bpe import CHUNK, Words, bytes_of_characters, chunks, per_worker
from casecast.llm.common import DOC_ID, TEXT, in_small_batches

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "padded_to bigint"
)
#: Sequences of one task are numbered from its partition number times this.
TASK_SEQUENCES = 1 << 40
#: Most bytes of ids in a batch of results.
BATCH_BYTES = 4 << 20

# Fixed value: how the byte-level vocabularies of this family split a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same for the `regex` library, whose \s has four more characters.
WORDS = regex.compile(SPLIT.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Encoder:
    """Ids of texts by a byte-level BPE file of the `tokenizers` library, special tokens' strings included.

    Where ids follow the order of the merges, as they do in files of this kind, `tiktoken` gives the same ids from the
    same vocabulary several times as fast; any other file is left to `tokenizers` itself. Texts of more than `CHUNK`
    code points are encoded in pieces that end where a word ends, and words longer than that by themselves, so memory
    beyond the text and its ids is bounded, and the faster one never meets white space that its regex engine refuses.
    """

    def __init__(self, path):
        self.path, self.library, self.fast, self.words = path, None, None, None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"].get("vocab"), spec["model"].get("merges", [])
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        made = [vocab.get(a + b, -1) for a, b in pairs] if isinstance(vocab, dict) else []
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
        if plain and made and all(a < b for a, b in zip(made, made[1:])) and min(made) >= 256:
            to_byte = bytes_of_characters()
            special = {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
            self.ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens=special)

    @property
    def slow(self):
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        return self.library

    def _unbroken(self, text):
        """Ids, as arrays, of a text without a place to cut it: word by word."""
        self.words = self.words or Words(self.ranks)
        special = "|".join(map(regex.escape, self.fast.special_tokens_set)) or "(?!)"
        at = 0
        for met in [*regex.finditer(special, text), None]:
            for word in regex.finditer(WORDS, text[at : met.start() if met else len(text)]):
                if len(word[0]) > CHUNK:
                    yield from self.words.encode(word[0])
                else:
                    yield np.array(self.fast.encode_ordinary(word[0]), np.uint32)
            if met:
                yield np.array(self.fast.encode(met[0], allowed_special="all"), np.uint32)
                at = met.end()

    def __call__(self, text):
        if self.fast is None:
            return self.slow.encode(text, add_special_tokens=False).ids
        if len(text) <= CHUNK:
            return self.fast.encode(text, allowed_special="all")
        found = []
        for piece in chunks(text, CHUNK // 2):
            if len(piece) <= CHUNK:
                found.append(np.array(self.fast.encode(piece, allowed_special="all"), np.uint32))
            else:
                found.extend(self._unbroken(piece))
        return np.concatenate(found)


def classes(capacity, waste=32):
    """Piece lengths and how many of them fill a sequence: the harmonic classes that pieces are cut to.

    Class k takes lengths of capacity/k rounded down, k to a sequence; classes that leave more than 1/`waste` of the
    sequence empty are passed over. Length 1 is always among them.
    """
    lengths = {}
    for k in range(1, capacity + 1):
        length = capacity // k
        if (capacity - k * length) * waste <= capacity:
            lengths[length] = max(k, lengths.get(length, 0))
    return dict(sorted(lengths.items()))


def cut(tokens, lengths):
    """(start, length) of a document's pieces: always the longest class length that still fits.

    What is left after a piece of class k is below capacity/(k(k+1)), so a document ends in a few pieces.
    """
    pieces, start = [], 0
    while start < tokens:
        length = lengths[bisect_right(lengths, tokens - start) - 1]
        pieces.append((start, length))
        start += length
    return pieces


def padded(tokens, capacity):
    """The size a sequence is padded to: `capacity`, or none if it holds a power of two."""
    return tokens if tokens & (tokens - 1) == 0 else capacity


class _Packer:
    """One open sequence per class; at the end what they hold is packed first fit, longest first."""

    def __init__(self, capacity, first):
        self.capacity, self.counts, self.next = capacity, classes(capacity), first
        self.open = defaultdict(list)

    def _close(self, pieces):
        total = sum(piece[2] for piece in pieces)
        offset, sequence = 0, self.next
        self.next += 1
        for piece in pieces:
            yield (*piece, sequence, offset, padded(total, self.capacity))
            offset += piece[2]

    def add(self, piece):
        held = self.open[piece[2]]
        held.append(piece)
        if len(held) == self.counts[piece[2]]:
            yield from self._close(held)
            held.clear()

    def finish(self):
        rooms = []
        for piece in sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2]):
            for room in rooms:
                if room[0] >= piece[2]:
                    break
            else:
                room = [self.capacity, []]
                rooms.append(room)
            room[0] -= piece[2]
            room[1].append(piece)
        for _, pieces in rooms:
            yield from self._close(pieces)


def _pack(path, capacity, end_id):
    def batch(rows):
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        names = "doc_id start length ids doc_tokens sequence_id offset padded_to".split()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches):
        encode, lengths = per_worker(f"encoder of {path}", lambda: Encoder(path)), list(classes(capacity))
        packer = _Packer(capacity, TaskContext.get().partitionId() * TASK_SEQUENCES)
        rows, held = [], 0
        for docs in batches:
            for doc_id, text in zip(docs.column(0).to_pylist(), docs.column(1)):
                ids = np.append(np.asarray(encode(text.as_py() or ""), "<u4"), np.uint32(end_id)).astype("<u4", copy=False)
                for start, length in cut(len(ids), lengths):
                    piece = (doc_id, start, length, ids[start : start + length].tobytes(), len(ids))
                    done = list(packer.add(piece))
                    rows += done
                    held += sum(4 * row[2] for row in done)
                if held > BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        rows += packer.finish()
        if rows:
            yield batch(rows)

    return run


def pack(docs, tokenizer, capacity=1024, end_id=0, id_col=DOC_ID, text_col=TEXT):
    """Every document's ids, cut into pieces that fill sequences of `capacity` ids.

    The result has a row per piece: `doc_id`, `start` and `length` within the document's ids (the text's, then
    `end_id`), `ids` (little-endian unsigned 32-bit), `doc_tokens`, `sequence_id`, `offset` there, and `padded_to`,
    the size its sequence is padded to. Pieces are cut to the lengths of harmonic classes, and a class fills each
    sequence with a fixed number of pieces, so a task needs to know nothing of the others: there is no shuffle. Each
    task holds one open sequence per class (about 90 for 1024) and packs what these hold at its end first fit, so at most one
    sequence in a task is not nearly full. `tokenizer` is a path that every executor can open.

    Defined cases: a null or empty text is the end id alone. A very long text is encoded in parts that give the ids of
    the whole. Rows that repeat an id are packed one by one, each with pieces of its own, and so are equal texts. A null
    id stays null. Only the two named columns are read, so others cannot clash; an empty table gives no piece.
    """
    inputs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_small_batches(inputs).mapInArrow(_pack(tokenizer, capacity, end_id), PIECES)
