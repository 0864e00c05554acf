import random
import zlib

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casecast.llm import bpe, token_files
from casecast.llm.queries import FILE_TOKENIZER, TOKENIZER, op12_token_files, tokenizer_path
from casecast.llm.token_files import WordEnds, read_token_files, write_token_files

PARTS = (
    "the |a|'s|'ll| |  |\n|12|3a|!?|<<endoftext>|É|é|é|中文|\x85|　|aaaaaaaaaa|ababab|qzx|\x1c|<|>|don't |_|\t|\x00|\x01|Σ|ΑΣ|İ|ﬁ|ß|ǅ"
).split("|") + ["<|endoftext|>", "<|ENDOFTEXT|>", "|"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(FILE_TOKENIZER))


def made_up(count, most, parts=PARTS, seed=4):
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) * draw.choice([1, 1, 1, 2, 30]) for _ in range(draw.randrange(most))) for _ in range(count)]


def same(tokenizer, texts, encode=None):
    encode = encode or WordEnds(tokenizer_path(FILE_TOKENIZER))
    assert encode.by_word
    for text, ids in zip(texts, encode([text.encode() for text in texts])):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library(tokenizer, spark, sf_dir):
    same(tokenizer, made_up(1500, 25) + [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])


def test_ids_of_long_stretches(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "LONG", 40)
    monkeypatch.setattr(bpe, "WINDOW", 16)
    letters = made_up(150, 600, "abcdefghijklmnopqrstuvwxyz", 5)
    same(tokenizer, made_up(600, 40, [p for p in PARTS if not p.isspace()]) + letters)


def test_more_words_than_are_remembered(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 20)
    monkeypatch.setattr(token_files, "KNOWN_LENGTH", 5)
    monkeypatch.setattr(token_files, "STEP_WORDS", 7)
    same(tokenizer, made_up(100, 20) + [" ".join(f"w{i}" for i in range(200))] + made_up(50, 8, seed=6))


def test_other_files_are_left_to_the_library():
    path = tokenizer_path(TOKENIZER)
    encode, library = WordEnds(path), Tokenizer.from_file(path)
    assert not encode.by_word
    assert encode([b"Some words"])[0].tolist() == library.encode("Some words", add_special_tokens=False).ids


def expected(tokenizer, rows):
    """{doc_id: [ids of each row]} and the positions at which they lie in ascending order of ids."""
    found = {}
    for row in rows:
        found.setdefault(row[0], []).append([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1])
    return found


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("block", [64, 1 << 20])
def test_written_and_read_back(spark, tokenizer, tmp_path, monkeypatch, clashing, block):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", block)
    rows = odd.odd_rows() + [(1000 - i, odd.prose(i, 5 + i), "en", "s", 1) for i in range(60)]
    path = str(tmp_path / "files")
    write_token_files(odd.table(spark, rows, clashing).repartition(3), path, tokenizer_path(FILE_TOKENIZER))
    found = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    ids = expected(tokenizer, rows)
    at = 0
    for r in found:
        own = np.frombuffer(r.ids, "<u4").tolist()
        ids[r.doc_id].remove(own)
        assert (r.start, r.n_tokens) == (at, len(own))
        at += len(own)
    assert not any(ids.values())
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0)) and order[:2] == [None, None]


def test_single_documents(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 256)
    rows = [(i, odd.prose(i, 40), "en", "s", 1) for i in range(200)]
    path = str(tmp_path / "files")
    write_token_files(odd.table(spark, rows), path, tokenizer_path(FILE_TOKENIZER))
    whole = {r.doc_id: r for r in read_token_files(spark, path).collect()}
    some = read_token_files(spark, path, [17, 150, 999]).collect()
    assert {r.doc_id: r for r in some} == {i: whole[i] for i in (17, 150)}
    index = spark.read.parquet(f"{path}/index")
    assert index.count() > 20 and index.agg(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in whole.values())


def test_files_of_another_dictionary_are_refused(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("a", "b")]
    for path, seed in zip(paths, (1, 2)):
        write_token_files(odd.table(spark, [(i, odd.prose(seed + i, 30)) for i in range(30)]), path, tokenizer_path(FILE_TOKENIZER))
    swapped = spark.read.parquet(f"{paths[0]}/dictionary")
    swapped.write.mode("overwrite").parquet(f"{paths[1]}/dictionary")
    with pytest.raises(Exception, match="dictionary"):
        read_token_files(spark, paths[1]).collect()


def test_the_query(spark, sf_dir, tokenizer):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    at, wanted = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        wanted.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in op12_token_files(spark, sf_dir).collect()) == wanted


def test_empty(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(odd.empty(spark), path, tokenizer_path(FILE_TOKENIZER))
    assert read_token_files(spark, path).collect() == [] and read_token_files(spark, path, [1]).collect() == []
