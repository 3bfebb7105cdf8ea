"""Properties of the pure functions, over generated inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartolux.functions import aligner as A
from cartolux.functions import sequence as S
from cartolux.functions import tokenizer as T
from cartolux.schemas import FORMATS, spelling, spellings

bases = st.text("ACGT", max_size=200)


@given(bases)
def test_reverse_complement_is_an_involution(s):
    assert S.reverse_complement(S.reverse_complement(s)) == s


@given(bases, st.sampled_from(sorted(S.ENZYMES.values())))
def test_sites_mirror(s, motif):
    mirrored = sorted((len(s) - at - len(motif) + 2, c) for at, c in S.sites(S.reverse_complement(s), {1: [motif]}))
    assert mirrored == S.sites(s, {1: [motif]})


@given(st.lists(st.text('ab"\t é', max_size=12), min_size=1, max_size=18))
def test_quoted_fields_come_back(fields):
    line = "\t".join('"' + f.replace('"', '""') + '"' for f in fields)
    assert T.tokenize([line]) == ([fields], [-1])


@given(st.lists(st.text('ab"\té', max_size=20), max_size=12), st.integers(1, 50))
def test_chunks_do_not_matter(lines, chunk):
    kinds = T.classes("\n".join(lines).encode() + b"\n")
    assert (T.states(kinds, chunk) == T.states(kinds)).all()


@settings(deadline=None)
@given(st.lists(st.integers(1000, 20000), min_size=8, max_size=30), st.floats(0.97, 1.03))
def test_a_stretched_map_aligns_to_itself(distances, stretch):
    p = np.cumsum(distances).astype(float)
    a = A.align(p * stretch, p)
    assert len(a.pairs) == len(p) and all(i == j for i, j in a.pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(a.pairs, a.pairs[1:]))


def test_spellings_are_unambiguous():
    for kind, columns in FORMATS.items():
        known = spellings(kind)
        assert {known[spelling(c)] for c in columns} == set(columns)
