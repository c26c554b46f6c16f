import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shoplens.llm.words import WordEncoder

ENCODERS = {name: WordEncoder(public_tokenizers.path(name), keeps, memory=200)
            for name, keeps in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True))}
PLAIN = {}
for name in ENCODERS:
    PLAIN[name] = Tokenizer.from_file(public_tokenizers.path(name))

PARTS = ["word", "don't", "it's", "'tis", "I'll", " ", "  ", "\n", "\n\n", "\t", "\x85", "\xa0", "\x1c", ".", "...", "1234",
         "½", "É", "é", "Σ", "日本", "🙂", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "a_b", "x" * 40, " ", "İ", "K"]


def same(text):
    for name, encoder in ENCODERS.items():
        assert encoder.ids(text).tolist() == PLAIN[name].encode(text, add_special_tokens=False).ids, (name, text)


def test_special_strings():
    for text in ["Hello, it's <|endoftext|> me", "<|endoftext|><|startoftext|>", " <|endoftext|> ", "a <|endoftext|>b<|endoftext", "  <|startoftext|>\n"]:
        same(text)


def test_mixed_parts():
    rng = random.Random(1)
    for _ in range(1500):
        same("".join(rng.choice(PARTS) for _ in range(rng.randrange(9))))


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    same(text)


def test_whole_documents(small_docs):
    for row in small_docs.limit(60).collect():
        same(row.text)
