import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import arrays as A
from airshed.llm import tables
from airshed.llm.sampling import runs

TEXT = st.text(alphabet=st.sampled_from(list("aAb Zé\t\n\x0b\x1c.0日")), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6), st.sampled_from([1, 10, 10**6]))
def test_words_are_the_regex_words(texts, limit):
    for separators, pattern in ((A.SPACE, rb"[^\x20\x09-\x0D]+"), (A.NOT_ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = []
        for _, offsets, buf in A.pieces(pa.array(texts, pa.string()), limit):
            starts, ends, rows = A.words(buf, offsets, separators)
            own = [bytes(buf[a:b]).lower() for a, b in zip(starts, ends)]
            got += [own[a:b] for a, b in zip(rows[:-1], rows[1:])]
        assert got == [re.findall(pattern, (t or "").encode().lower()) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_are():
    text = b" ".join([b"Alpha", b"beta", b"alpha", b"BETA", b"alphabet"] * 50)
    buf = np.frombuffer(text, np.uint8)
    starts, ends, _ = A.words(buf, np.array([0, len(buf)]), A.SPACE)
    folded, exact = A.span_hashes(buf, starts, ends), A.span_hashes(buf, starts, ends, fold=False)
    assert len(set(folded.tolist())) == 3 and len(set(exact.tolist())) == 5
    assert folded[0] == folded[2] == folded[-3]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 9))
def test_first_minima(values, width):
    v = np.array(values, dtype=np.uint64) << np.uint64(40)
    want = [i + min(range(width), key=lambda j: (values[i + j], j)) for i in range(len(values) - width + 1)]
    assert A.first_minima(v, width).tolist() == want


def test_runs_cover_every_window_once_and_equal_windows_agree():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    offsets = np.array([0, 0, 150, 155, 400])
    length, k = 13, 4
    r = runs(A.grams(items, k), offsets, length, k)
    cover = [p for a, b in zip(r.first.tolist(), r.last.tolist()) for p in range(a, b + 1)]
    assert cover == A.inside_rows(offsets, length).tolist() == [*range(0, 138), *range(155, 388)]
    place = {}
    for a, b, at, seed in zip(r.first.tolist(), r.last.tolist(), r.at.tolist(), r.seed.tolist()):
        for p in range(a, b + 1):
            window = items[p : p + length].tobytes()
            assert place.setdefault(window, (at - p, seed)) == (at - p, seed)


def test_spans_and_filter(spark):
    lo, hi = A.merge_spans(np.array([5, 0, 3, 9]), np.array([7, 2, 6, 9]))
    assert list(zip(lo.tolist(), hi.tolist())) == [(0, 2), (3, 7), (9, 9)]
    keys = A.mix(np.arange(1, 5001, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in keys.view(np.int64)], "k long")
    words = tables.key_filter(df, "k")
    assert tables.may_hold(words, keys).all()
    assert tables.may_hold(words, A.mix(np.arange(10**6, 10**6 + 100_000, dtype=np.uint64))).sum() < 50
    before = spark.conf.get(tables.CLEAN_UP, None)
    assert tables.written(df, "t").count() == 5000 and spark.conf.get(tables.CLEAN_UP, None) == before
