"""Token counts and token files against the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from hourweave.llm.queries import END_ID, QUERIES, TOKEN_LIMIT
from hourweave.llm.token_counts import count_tokens
from hourweave.llm.token_files import Encoder, read_documents, write_token_files
from hourweave.session import scratch_path

ODD = [
    "a\x1cb", "a \x1c b", "a\x0bb", "a\x85b", "a​b", "a᠎b", "x<|endoftext|>y <|startoftext|> z", "é ́x", "ΑΣ ΣΑΣ", "İstanbul don't I'LL",
    "", "  ", "a  b", " a", "a ", "\n a b", " \n b", "a\xa0 b", "it's  'll", "a\n\n b", "　 a", "1234 5", "x" * 3000, "<|endoftext|><|endoftext|>",
]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("head", [0, 5, 1 << 19])
def test_counts_equal_the_library(spark, docs, word_bpe, head):
    tokenizer = Tokenizer.from_file(word_bpe)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + list(enumerate(ODD, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in count_tokens(df, word_bpe, head=head).collect())
    assert got == Counter((i, len((t or "").encode()), len(ids_of(tokenizer, t))) for i, t in rows)


def test_counts_of_nothing(empty, word_bpe):
    assert count_tokens(empty, word_bpe).count() == 0


def test_count_query(spark, sf_dir, word_bpe):
    tokenizer = Tokenizer.from_file(word_bpe)
    want = {r.doc_id: len(ids_of(tokenizer, r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op9_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > TOKEN_LIMIT) for r in got)


def test_chunks_equal_whole_texts(byte_bpe):
    tokenizer = Tokenizer.from_file(byte_bpe)
    for text, ids in zip(ODD, Encoder(byte_bpe).encode(ODD)):
        assert np.frombuffer(ids, "<u2").tolist() == ids_of(tokenizer, text), repr(text)


def test_files_give_back_what_was_written(spark, docs, byte_bpe):
    tokenizer = Tokenizer.from_file(byte_bpe)
    folder = scratch_path(spark, "token-files-test")
    manifest = write_token_files(docs, folder, byte_bpe, END_ID, parts=4)
    got = read_documents(spark, folder, tokenizer.get_vocab_size(), ids=True).orderBy("start").collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((r.doc_id, (*ids_of(tokenizer, r.text), END_ID)) for r in docs.collect())
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert manifest.agg({"tokens": "sum"}).first()[0] == at


def test_files_of_nothing(spark, empty, byte_bpe):
    folder = scratch_path(spark, "token-files-empty")
    write_token_files(empty, folder, byte_bpe, END_ID, parts=2)
    assert read_documents(spark, folder, 50_257).count() == 0


def test_file_query(spark, sf_dir, byte_bpe):
    tokenizer = Tokenizer.from_file(byte_bpe)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    at = 0
    for r, got in zip(rows, QUERIES["op7_token_files"](spark, sf_dir).orderBy("start").collect(), strict=True):
        ids = np.array([*ids_of(tokenizer, r.text), END_ID], "<u4")
        assert (got.doc_id, got.start, got.n_tokens, got.ids_crc32) == (r.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
