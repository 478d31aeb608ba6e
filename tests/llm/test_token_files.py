import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postgauge.llm import token_files as T
from postgauge.llm import tokens
from postgauge.llm.queries import QUERIES
from postgauge.llm.tokens import Encoder
from postgauge.session import fresh_path


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
@settings(deadline=None)
def test_numbers_round_trip(numbers):
    control, data = T.pack(np.array(numbers, "<u4"))
    assert len(control) == -(-len(numbers) // 4)
    assert T.unpack(control, data, len(numbers)).tolist() == numbers


ALPHABET = st.sampled_from(list("abE'st 1\n\t\r\x1c  ́Σé.,<|>")) | st.characters(exclude_categories=["Cs"])


@given(st.text(ALPHABET, max_size=60))
@settings(deadline=None, max_examples=300)
def test_pieces_give_the_ids_of_the_whole_text(text):
    import public_tokenizers

    if not ENCODERS:
        ENCODERS.append(Encoder(public_tokenizers.path("word_bpe_49k.json"), keep=50))
    encoder = ENCODERS[0]
    assert encoder.splits
    assert encoder.ids(text).tolist() == plain_ids(encoder.tokenizer, text)


ENCODERS: list[Encoder] = []


@given(st.text(st.sampled_from(list("aZéÉßÑœŒŉǅȺЖѝЙΣſİıŁ .,´")), max_size=40))
@settings(deadline=None, max_examples=300)
def test_words_beyond_ascii_give_the_ids_of_the_whole_text(text):
    test_pieces_give_the_ids_of_the_whole_text.hypothesis.inner_test(text)


def test_pieces_met_once_are_forgotten_and_those_met_again_stay():
    """A corpus of new words, with a few that come back, holds hardly more than these few."""
    import public_tokenizers

    encoder, letters = Encoder(public_tokenizers.path("word_bpe_49k.json"), keep=200_000), "abcdefghij"
    for n in range(20_000):
        encoder.ids("the same words " + "".join(letters[int(d)] for d in str(n)) + "x,")
    assert encoder.known.keys() >= {"the", "same", "words"}
    assert len(encoder.known) + len(encoder.recent) < 700


def test_tokenizers_that_keep_blanks_are_not_split():
    import public_tokenizers

    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encoder.splits
    assert encoder.ids("a b\nc").tolist() == plain_ids(encoder.tokenizer, "a b\nc")


def expected(rows, tokenizer, end):
    tokenizer, at, out = Tokenizer.from_file(tokenizer), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain_ids(tokenizer, text), end], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_plain_encoding(spark, data, rows, tokenizer):
    got = [tuple(r) for r in QUERIES["op3_token_files"](spark, data).orderBy("start").collect()]
    assert got == expected([(r["doc_id"], r["text"]) for r in rows("documents")], tokenizer, 2)


@pytest.mark.parametrize(("part", "block"), [(1 << 20, 1 << 20), (7, 20)])
def test_odd_texts(spark, odd, tokenizer, part, block, monkeypatch):
    """Null ids first, repeated rows kept, documents cut in parts put together again."""
    monkeypatch.setattr(T, "PART", part)
    monkeypatch.setattr(T, "BLOCK", block)
    path = fresh_path(spark, "odd")
    T.write_token_files(odd, path, tokenizer, end_id=2, shards=3)
    got = T.read_token_files(spark, path).orderBy("start").collect()
    want = expected([(r.doc_id, r.text) for r in odd.collect()], tokenizer, 2)
    assert [(r.doc_id, r.start, r.n_tokens, T.crc32(np.array(r.ids))) for r in got] == want


def test_common_ids_get_small_ranks(spark, data, tokenizer):
    docs, path = spark.read.parquet(f"{data}/documents.parquet"), fresh_path(spark, "ranks")
    T.write_token_files(docs, path, tokenizer, end_id=2)
    table = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    assert [r["rank"] for r in table] == list(range(len(table)))
    assert all(a.n >= b.n for a, b in zip(table, table[1:]))


def test_empty_table(spark, odd, tokenizer):
    path = fresh_path(spark, "none")
    T.write_token_files(odd.limit(0), path, tokenizer, end_id=2)
    assert T.read_token_files(spark, path).collect() == []


def test_pieces_are_the_same_however_often_they_are_forgotten():
    """Known, recent and forgotten pieces, marked words and letters of many bytes; every byte has its character in one table."""
    assert len(tokens._BYTES) == len(set(tokens._BYTES)) == 256
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = Encoder(path, 64 * tokens._COST), Encoder(path)
    texts = ["Straße, naïve Ĳssel (word) words, words words! ёлка Ёлка", *(f"piece{chr(97 + k % 26) * (k % 9)} wÿrd{chr(0x430 + k % 32)}a," for k in range(400))]
    for text in texts * 2:
        assert encoder.ids(text).tolist() == plain._whole(text).tolist()
        assert len(encoder.known) <= 64 + 20 and len(encoder.recent) - encoder.older <= 32 + 20
