from __future__ import annotations

from array import array

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from legmeter.llm.encoding import encoder
from texts import cases

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PARTS = ["ab", "Über", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "'s", "don't", "12", "!!", "###", "<|endoftext|>", "e\u0301", "ΣΑΣ", "İ", "漢字", "\x1c", "x."]


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=12).map("".join))
def test_cached_pieces_equal_direct_encoding(name, text):
    assert encoder(name).encode(text) == array("I", encoder(name).direct(text)).tobytes()


@pytest.mark.parametrize("name", NAMES)
def test_documents_equal_direct_encoding(name):
    for _, text, *_ in cases():
        found = np.frombuffer(encoder(name).encode_document(text), "<u4").tolist()
        assert found == [*encoder(name).direct(text or ""), 2]
