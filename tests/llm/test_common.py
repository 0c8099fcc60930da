import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelens.llm.common import components, range_hashes, run_hashes, steps, text_bytes, word_spans

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t \x0b\x1c ", max_size=30)), max_size=8)


@settings(deadline=None, max_examples=80)
@given(TEXT)
def test_words_are_those_of_each_row(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    start, end, row = word_spans(data, offsets)
    raw = data.tobytes()
    got = [[] for _ in texts]
    for a, b, r in zip(start, end, row):
        got[r].append(raw[a:b])
    assert got == [(t or "").encode().split() for t in texts]


@settings(deadline=None, max_examples=40)
@given(TEXT, st.integers(0, 5))
def test_slices_of_arrow_columns(texts, lo):
    column = pa.array(texts, pa.string())
    data, offsets = text_bytes(column.slice(min(lo, len(texts))))
    want = [(t or "").encode() for t in texts[min(lo, len(texts)):]]
    assert [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])] == want


def test_hashes_do_not_depend_on_place():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    a, b = np.array([100, 900]), np.array([140, 960])
    for lane in (0, 1):
        whole = range_hashes(data, a, b, lane)
        assert whole.tolist() == range_hashes(data[100:], a - 100, b - 100, lane).tolist()
        runs = run_hashes(data.astype(np.uint64), 20, lane)
        assert runs[50:].tolist() == run_hashes(data[50:].astype(np.uint64), 20, lane).tolist()
    assert len(run_hashes(np.zeros(3, np.uint64), 20)) == 0


def test_steps_cover_every_row_once():
    offsets = np.array([0, 0, 5, 5, 100, 101, 101, 140])
    got = list(steps(offsets, 10))
    assert got[0][0] == 0 and got[-1][1] == 7 and all(x[1] == y[0] for x, y in zip(got, got[1:]))


@pytest.mark.parametrize("shape", ["random", "path", "star", "empty"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {"random": [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3), (3, None)],
             "path": [(i, i + 1) for i in range(40)], "star": [(99, i) for i in range(40)], "empty": []}[shape]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
