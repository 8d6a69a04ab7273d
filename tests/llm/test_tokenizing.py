import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from billscope.llm.tokenizing import CachedTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
OURS, THEIRS = CachedTokenizer(PATH, 2, limit=60), Tokenizer.from_file(PATH)

PARTS = [" ", "  ", "\n", "\n\n", " \n", "\t", "\x0b", " ", "\u0085", " ", "word", "It's", "'s", "don't.", "Ünïcode", "ß", "x" * 70, "42", ".", "?!", "...", "-", "<|endoftext|>", "漢字", "é", "\U0001f600", "A,", "͸", "š", "«a»", "a’s", "—", "…", "''s", "\"'re", "\r\n", " \u2009", "x1y", "½", "µ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=4))
def test_ids_equal_those_of_the_tokenizer(texts):
    want = [x.ids for x in THEIRS.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, OURS.dtype).tolist() for x in OURS.encode(texts)] == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert np.frombuffer(OURS.encode([text])[0], OURS.dtype).tolist() == THEIRS.encode(text, add_special_tokens=False).ids


COVERED = st.text(st.sampled_from(list(" \n\t\r'stremvlda.,!?-<|>*09AzéßØžŉ¡«»¿‘’“”…–—_~`^$+=|") + [" ", " ", "\n", "'"]), max_size=40)


@settings(max_examples=1500, deadline=None)
@given(COVERED)
def test_ids_of_covered_text(text):
    assert np.frombuffer(OURS.encode([text])[0], OURS.dtype).tolist() == THEIRS.encode(text, add_special_tokens=False).ids
