import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickerloom.llm.tokens import ChunkEncoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PLAIN = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}
ENCODERS = {f: ChunkEncoder(public_tokenizers.path(f), 50) for f in FILES}
PARTS = st.sampled_from([
    "the", "a", " ", "  ", "\n", " \n", "\t", "'s", ".", ",", "3", "é", "́", "漢字", "\xa0",
    " ", "\x1c", "<|endoftext|>", "<|startoftext|>", "İ", "ﬁ", "e.g", "Word", "#", "\x00",
])
TEXTS = st.one_of(st.lists(PARTS, max_size=20).map("".join), st.text(max_size=30))


def expected(name, text):
    return PLAIN[name].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(name, texts):
    encoder = ENCODERS[name]
    found = [ids.tolist() for ids in encoder.stream(texts, 7)]
    assert found == [expected(name, t) + [7] for t in texts]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == expected(name, text)
        chunks, counts = encoder.counted(text)
        assert "".join(chunks) == text and sum(counts) == len(expected(name, text))
        sizes, tokens = encoder.measured(text)
        assert sizes.tolist() == [len(c) for c in chunks] and tokens.tolist() == counts


@pytest.mark.parametrize("name", FILES)
def test_a_full_table_starts_afresh(name, monkeypatch):
    monkeypatch.setattr("tickerloom.llm.tokens.TABLE_PIECES", 10)
    monkeypatch.setattr("tickerloom.llm.tokens.STREAM_CHARS", 40)
    texts = [f"word{k} other{k % 3}, the end." for k in range(60)]
    encoder = ChunkEncoder(public_tokenizers.path(name), 5)
    assert [i.tolist() for i in encoder.stream(texts, 0)] == [expected(name, t) + [0] for t in texts]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == expected(name, text)
