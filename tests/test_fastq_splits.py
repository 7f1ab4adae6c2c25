"""Full-record source: every split size gives back every record exactly
once (pure Python over the partition reader, many random cases)."""

import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from seqtally.sources import fastq as fq

seq = st.text(alphabet="ACGTN", min_size=1, max_size=60)
qual_char = st.sampled_from(list('@+,"!#I5?_'))


@st.composite
def records(draw):
    n = draw(st.integers(min_value=0, max_value=40))
    out = []
    for i in range(n):
        s = draw(seq)
        q = "".join(draw(st.lists(qual_char, min_size=len(s), max_size=len(s))))
        out.append((f"@r{i} d", s, "+", q))
    return out


def read_all(path, split):
    size = os.path.getsize(path)
    got = []
    for start in range(0, max(size, 1), split):
        part = fq._Range(path, start, min(size, start + split), False)
        for b in fq._record_batches(part):
            d = b.to_pydict()
            got += list(zip(d["header"], d["sequence"], d["spacer"], d["quality"]))
    return got


@settings(max_examples=300, deadline=None)
@given(recs=records(), split=st.integers(min_value=1, max_value=400),
       final_newline=st.booleans())
def test_every_split_size_returns_each_record_once(recs, split, final_newline):
    text = "\n".join(f"{h}\n{s}\n{p}\n{q}" for h, s, p, q in recs)
    if recs and final_newline:
        text += "\n"
    with tempfile.NamedTemporaryFile("w", suffix=".fastq", delete=False) as f:
        f.write(text)
    try:
        assert read_all(f.name, split) == recs
    finally:
        os.unlink(f.name)
