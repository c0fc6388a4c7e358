"""Word bounds and hashes against plain regular expressions."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm.text import (Rolling, WordHasher, byte_table, gather_bytes, lower_table,
                                slices, string_buffer, word_bounds)

RULES = {"space": r"[^\x20\x09-\x0D]+", "alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=6))
def test_words_follow_the_rule(texts):
    texts = [t if t is None else t.encode("utf-8", "replace").decode() for t in texts]
    data, offs = string_buffer(pa.array(texts, pa.string()))
    low = lower_table()[data]
    for name, rule in RULES.items():
        s, e, row = word_bounds(low, offs, byte_table(name))
        got = [(int(r), bytes(low[a:b]).decode()) for a, b, r in zip(s, e, row)]
        want = [(i, w) for i, t in enumerate(texts)
                for w in re.findall(rule, (t or "").translate(ASCII))]
        assert got == want
        assert gather_bytes(low, s, e).to_pylist() == [w.encode() for _, w in want]
        h = WordHasher(1)(low, s, e)
        assert len(set(h.tolist())) == len({w for _, w in want})


def test_sliced_arrays_and_slices():
    arr = pa.array(["a b", None, "c", "dd ee", ""]).slice(1, 4)
    data, offs = string_buffer(arr)
    assert bytes(data) == b"cdd ee" and offs.tolist() == [0, 0, 1, 6, 6]
    assert [*slices(offs, 3)] == [(0, 2), (2, 4)] or [*slices(offs, 3)][-1][1] == 4
    covered = [i for a, b in slices(offs, 1) for i in range(a, b)]
    assert covered == [0, 1, 2, 3]


def test_rolling_ranges_depend_on_content_only():
    x = np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64)
    x[30:40] = x[5:15]
    h = Rolling(2).ranges(x, np.array([5, 30, 6]), np.array([15, 40, 16]))
    assert h[0] == h[1] != h[2]
