"""BPE against the tokenizers library, on given texts, on random ones and through Spark."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODER = bpe.Coder(bpe.read_vocabulary(PATH))
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "", " ", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "Hello, it's 2024!  \n\n\tyes ", "déjà vu œuvre ß", "日本語 テスト",
    "x<|endoftext|>y", "<|endoftext|>", "<|endoftext|", "\x1c\x1d\x1e\x1f\x85\xa0 ​　 z", "👩‍👩‍👧 emoji 🎉", "'S 'LL 'll n't",
    "½ ² ③ ٣ Ⅷ", "á́ é", "\x00\x01\x7f", "word " * 2000, "q" * 5000, "\r\n\r\n  \r\n x",
]


def same(text: str) -> None:
    packed = CODER.encode(text)
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)] == expected
    assert CODER.decode(packed).decode() == LIBRARY.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_given_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


def test_random_words_and_blanks():
    r = random.Random(3)
    for _ in range(300):
        same("".join(r.choice("etaoin shr'dlu\n\t.,;:!12é ßñ \x1c") for _ in range(r.randint(0, 300))))


def test_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    own = bpe.Coder(bpe.read_vocabulary(PATH))
    text = "one two three four five six one two three"
    assert own.encode(text) == CODER.encode(text)
    assert len(own.young) <= 3 and len(own.old) <= 3


def test_rows(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(99, None, "x"), (0, "", "y"), (None, "z", None)], "doc_id long, text string, n_tokens string")
    got = bpe.token_digests(docs, PATH).collect()
    assert len(got) == len(TEXTS) + 3
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(TEXTS):
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        assert by_id[i].n_tokens == len(ids)
        assert by_id[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert by_id[99].n_tokens == 0 and by_id[99].ids_sha256 == hashlib.sha256(b"").hexdigest()
    full = bpe.with_tokens(docs, PATH).collect()
    assert {r.decoded for r in full} == {*TEXTS, "z"} and full[0].n_tokens == "x"


def test_empty_table(spark):
    assert bpe.token_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
