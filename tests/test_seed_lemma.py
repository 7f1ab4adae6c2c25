"""The stepped-seed plan finds every occurrence: a pure-Python model of the
probe positions and index offsets chosen by ``seed_lanes``, checked against
brute force on random libraries (no Spark needed)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from seqtally.operators.match import SEED_MIN, seed_lanes

dna = st.text(alphabet="ACGT", min_size=0, max_size=120)
barcode = st.text(alphabet="ACGT", min_size=1, max_size=40)


def model_hits(read, library, max_build_rows):
    counts = {}
    for b in library:
        counts[len(b)] = counts.get(len(b), 0) + 1
    lanes, k, s = seed_lanes(counts, SEED_MIN, max_build_rows=max_build_rows)
    index = {}
    for i, b in enumerate(library):
        if len(b) < SEED_MIN:
            index.setdefault(b, []).append((i, 0))
        else:
            for o in range(s):
                index.setdefault(b[o:o + k], []).append((i, o))
    found = set()
    for klen, step in lanes:
        for pos in range(0, len(read) - klen + 1, step):
            for i, o in index.get(read[pos:pos + klen], []):
                b = library[i]
                start = pos - o
                if start >= 0 and read[start:start + len(b)] == b:
                    found.add(i)
    return found


@settings(max_examples=400, deadline=None)
@given(read=dna, library=st.lists(barcode, min_size=1, max_size=12, unique=True),
       plant=st.lists(st.integers(min_value=0, max_value=11), max_size=3),
       bound=st.sampled_from([1, 7, 50, 10 ** 9]))
def test_stepped_seeds_find_every_occurrence(read, library, plant, bound):
    for j in plant:                       # make some barcodes actually occur
        b = library[j % len(library)]
        read = read[: len(read) // 2] + b + read[len(read) // 2:]
    want = {i for i, b in enumerate(library) if b in read}
    assert model_hits(read, library, bound) == want


def test_lanes_shape():
    lanes, k, s = seed_lanes({20: 5, 24: 3}, 8, max_build_rows=10 ** 9)
    assert (k, s) == (12, 9) and lanes == [(12, 9)]
    lanes, k, s = seed_lanes({20: 5}, 8, max_build_rows=10)
    assert s == 2                          # 5 barcodes x 2 offsets fit the bound
    lanes, k, s = seed_lanes({3: 2, 5: 1, 9: 4}, 8, max_build_rows=10 ** 9)
    assert lanes == [(3, 1), (5, 1), (9, 1)] and (k, s) == (9, 1)
