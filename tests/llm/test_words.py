from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewell.llm import words as W

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 é\n\t\x0b-_ß", max_size=60)), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(rows):
    raw = [None if t is None else t.encode() for t in rows]
    for flags, pattern in ((W.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        cut = W.cut(raw, flags)
        for d, t in enumerate(raw):
            own = [cut.data[cut.start[i] : cut.end[i]].tobytes() for i in range(cut.first[d], cut.first[d + 1])]
            assert own == re.findall(pattern, (t or b"").lower())


def test_hashes_follow_the_word_alone():
    many = W.cut([b"a bb " + b"c" * 5000 + b" bb", b"BB A"], W.NOT_SPACE).hashes()
    assert many[1] == many[3] == many[4] and many[0] == many[5] and len(set(many.tolist())) == 3


def test_runs_keep_to_their_text():
    cut = W.cut([b"a b c d", b"", b"a b", b"a b c"], W.NOT_SPACE)
    runs, bounds = W.runs(cut.hashes(), cut.first, 3)
    assert np.diff(bounds).tolist() == [2, 0, 1, 1]
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 3
