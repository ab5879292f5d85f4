import zlib

import numpy as np
import pytest
from inputs import EDGES, prose

from trajloom.llm.sharding import permute, shards, unpermute


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    rows = np.arange(n)
    places = permute(rows, n, 5)
    assert sorted(places) == list(range(n)) and (unpermute(places, n, 5) == rows).all()
    if n > 500:
        assert (places != permute(rows, n, 6)).any() and abs(np.corrcoef(rows, places)[0, 1]) < 0.2


def test_shards_of_a_table(docs):
    rows = [*EDGES, *((300 + k, prose(k, k)) for k in range(80)), *[(900, "same")] * 40]
    got = shards(docs(rows), 24).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(k, [])) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    # the place follows from the row number alone
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32))
    places = permute(np.arange(len(rows)), len(rows))
    unique = [k for k, r in enumerate(order) if r.doc_id not in (104, 900)]
    assert all((order[k].shard, order[k].slot) == (places[k] % 24, places[k] // 24) for k in unique)


def test_same_whatever_the_partitions(docs):
    rows = [(k, prose(k, 5)) for k in range(200)]
    a = sorted(map(tuple, shards(docs(rows).repartition(7)).collect()))
    assert a == sorted(map(tuple, shards(docs(rows).repartition(2, "text")).collect()))


def test_empty_table(docs):
    assert shards(docs([])).count() == 0
