"""Token ids by pre-tokens against the library on whole texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.tokens import Encoder

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ODD = [
    "", " ", "\n", "a", " a", "a\n\n b", "a \nb", "it's we'll x's'd", "wor1d 234 a_b __", "été Straße ΟΔΟΣ οδος σς",
    "İ् x", "日本語 한국어 ไทย हिन्दी عربى", "ά Å क़", "é", "\U0001f600‍ x", "a  b ", "<|endoftext|>",
    "Ӏӏ ǅ Ⅷ ٣ ²", "\x00a\x01 b",
]


def by_library(file: str, texts: list[str]) -> list[list[int]]:
    encoded = Tokenizer.from_file(public_tokenizers.path(file)).encode_batch(texts, add_special_tokens=False)
    return [x.ids for x in encoded]


@pytest.mark.parametrize(("file", "spaced"), FILES)
def test_ids_are_those_of_the_library(file, spaced):
    draw = random.Random(3)
    letters = list("abcXYZ é'slt'd re've12  \n\n\t.,!?_-ßñσΣςİıǅĐ日語ไหि한") + ["्", "Ӏ"]
    texts = ODD + ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(4000)]
    encoder = Encoder(public_tokenizers.path(file), spaced)
    for _ in range(2):
        found = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts)]
        assert found == by_library(file, texts)


@pytest.mark.parametrize(("file", "spaced"), FILES)
def test_only_odd_words_need_the_librarys_pattern_and_a_pre_token_is_merged_once(file, spaced, monkeypatch):
    encoder = Encoder(public_tokenizers.path(file), spaced)
    sent, merged = [], []
    monkeypatch.setattr(encoder, "_whole", lambda texts: sent.extend(texts) or Encoder._whole(encoder, texts))

    class Model:
        def tokenize(self, part, model=encoder.model):
            merged.append(part)
            return model.tokenize(part)

    encoder.model = Model()
    texts = ["zebra, zebra. zebra! (zebra)", "the zebra's zebra; ﭏzebra"]
    found = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts)]
    assert found == by_library(file, texts)
    assert not sent or all("zebra," not in x for x in sent)
    assert len(merged) == len(set(merged))


@pytest.mark.parametrize(("file", "spaced"), FILES)
def test_words_met_twice_are_remembered(file, spaced):
    encoder = Encoder(public_tokenizers.path(file), spaced)
    for texts in (["one two"], ["one three"], ["one four"]):
        encoder.encode(texts)
    assert set(encoder.known) == {"one"}
