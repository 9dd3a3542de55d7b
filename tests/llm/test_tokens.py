import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kredo.llm import tokens
from tests.llm.tables import ROWS

PATH = tokens.default_path()


def library_ids(text):
    return tokens.encoder(PATH).tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [r[1] for r in ROWS if r[1]])
def test_same_ids_as_the_library(text):
    assert np.frombuffer(tokens.encoder(PATH).ids(text), "<u4").tolist() == library_ids(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBcé ßÀ'sT12..,!<|>\n\t\x1c\x85\xa0éİ"), st.characters()), max_size=40))
def test_same_ids_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(tokens.encoder(PATH).ids(text), "<u4").tolist() == library_ids(text)


def test_the_piece_cache_is_bounded():
    small = tokens.WordEncoder(PATH, max_entries=10)
    for k in range(50):
        small.ids(f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 5]}")
        assert len(small.pieces) + len(small.older) <= 10
    assert np.frombuffer(small.ids("x" * 200), "<u4").tolist() == library_ids("x" * 200)
