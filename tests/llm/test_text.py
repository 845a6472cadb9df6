import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from limnos.llm import text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Z9é\n\t\x0b\x1f ", max_size=20)), max_size=8)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(["x y", *texts, "z"], pa.string()).slice(1, len(texts))
    data, offsets = text.text_bytes(column)
    starts, ends, first = text.word_spans(data, offsets)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        got = [raw[a:b] for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        assert got == WORD.findall((t or "").encode())


def test_hashes_tell_words_apart():
    words = [f"{a}{i}" for a in ("", "a", "zz", "é") for i in range(5000)]
    data, offsets = text.text_bytes(pa.array(words))
    hashes = text.span_hashes(data, offsets[:-1], offsets[1:])
    assert len(set(hashes.tolist())) == len(set(words))
    assert (text.span_hashes(data, offsets[5:9], offsets[6:10]) == hashes[5:9]).all()


def test_blocks_hold_all_rows():
    batch = pa.record_batch([pa.array(range(9)), pa.array(["x" * n for n in (0, 5, 50, 0, 3, 3, 3, 100, 1)])], names=["i", "text"])
    parts = list(text.blocks(iter([batch.slice(0, 4), batch.slice(4)]), most=10))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9))
    assert max(p.num_rows for p in parts) > 1


def test_code_points():
    data, _ = text.text_bytes(pa.array(["aé日😀b"]))
    assert text.code_points(data)[-1] == 5 and text.code_points(data)[3] == 2
    assert np.array_equal(text.mix64(np.arange(3, dtype=np.uint64)), text.mix64(np.arange(3, dtype=np.uint64)))
