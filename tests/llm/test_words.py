import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from queuelake.llm.words import as_bytes, shingle_set, window_hashes, word_hashes

TEXT = st.text(alphabet="ab \t\n\x0b\x0c\r\x1c é日", max_size=60)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT)
def test_equal_words_equal_hashes(a, b):
    wa, wb = words(a), words(b)
    ha, hb = word_hashes(as_bytes(a, True)), word_hashes(as_bytes(b, True))
    assert len(ha) == len(wa)
    assert [x == y for x in wa for y in wb] == [x == y for x in ha.tolist() for y in hb.tolist()]


def test_shingles_are_counted_like_strings():
    rng = np.random.default_rng(1)
    text = " ".join(rng.choice(["ab", "ba", "a", "b", "aa", "Ab"], size=400))
    w = words(text)
    assert len(shingle_set(text)) == len({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    assert len(shingle_set("A b\tc")) == 1
    assert shingle_set("A b\tc")[0] == shingle_set("a  B c ")[0]
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0


def test_no_collisions_among_many_words():
    text = " ".join(f"{i:x}" for i in range(200_000))
    h = word_hashes(as_bytes(text, True))
    assert len(np.unique(h)) == 200_000
    assert len(np.unique(window_hashes(h))) == 200_000 - 4
