import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postgauge.llm import token_counts as C
from postgauge.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return C.whole_tokens(PATH)


@pytest.fixture(scope="module")
def counter(whole):
    return C.TokenCounter(PATH, whole)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def n_tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_every_proved_text_is_one_token_to_the_library(whole, library):
    assert len(whole) > 40_000
    texts = sorted(whole)
    assert all(len(e.ids) == 1 for e in library.encode_batch(texts, add_special_tokens=False))


ODD = list("abE'stve 1\n\t\r\x1c\xa0  ́Σé.,<|>²Ⅷ՘౜") + ["<|endoftext|>", "'ll", "՘", "₏", "\U00010940"]


@given(st.lists(st.sampled_from(ODD) | st.characters(exclude_categories=["Cs"]), max_size=40).map("".join))
@settings(deadline=None, max_examples=500)
def test_counts_are_those_of_the_library(counter, library, text):
    assert counter.count(text) == n_tokens(library, text)


def test_characters_that_the_pattern_sees_otherwise_are_left_to_the_library(counter, library):
    for code in range(0x500, 0x30000, 7):
        if not 0xD800 <= code < 0xE000:
            text = f"ab{chr(code)}cd 1{chr(code)} .{chr(code)}  {chr(code)}x"
            assert counter.count(text) == n_tokens(library, text), hex(code)


def test_what_is_remembered_is_bounded(whole, library):
    counter = C.TokenCounter(PATH, whole, remembered=2000)
    for k in range(200):
        text = f"qzx{k}vvq zzqk{k * 31}"
        assert counter.count(text) == n_tokens(library, text)
    assert counter.size <= 2000 + 2 * (C._COST + 4 * C.LONGEST)


def test_odd_rows(spark, odd, library):
    got = C.count_tokens(odd, PATH).collect()
    expected = [(r.doc_id, len((r.text or "").encode()), n_tokens(library, r.text)) for r in odd.collect()]
    order = repr
    assert sorted([(r["row"].doc_id, r.n_bytes, r.n_tokens) for r in got], key=order) == sorted(expected, key=order)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert C.count_tokens(odd.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, data, rows, library):
    expected = {d["doc_id"]: n_tokens(library, d["text"]) for d in rows("documents")}
    got = QUERIES["op13_token_counts"](spark, data).collect()
    assert {r.doc_id: r.n_tokens for r in got} == expected
    assert len(got) == len(rows("documents"))


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        C.ByteLevel(public_tokenizers.path("word_bpe_49k.json"))
