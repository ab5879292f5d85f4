import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import EDGES, prose

from trajloom.llm.packing import Plan, cut, pack, sequences
from trajloom.llm.queries import vocabulary
from trajloom.llm.token_files import EliasFano, TokenFile, _settle, pack_file, read, write
from trajloom.llm.tokens import Encoder, Vocabulary

tokenizers = pytest.importorskip("tokenizers")
WORD, BYTE = (vocabulary(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path, texts, special=False):
    t = tokenizers.Tokenizer.from_file(path)
    if special:
        t.encode_special_tokens = True
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [2], np.uint32) for x in texts]


@pytest.mark.parametrize("text_of_special", [False, True])
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cut_texts_encode_as_whole_ones(path, text_of_special):
    rng = random.Random(1)
    signs = " \n\t  ab'stéÀ́ß0 9.,!　́ <|>endof×µª²" + "漢😀ǅ"
    some = " \n'stéÀß0 9.,!|&"
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(40))) for a in (signs, some, some.replace("'", "")) for _ in range(4000)]
    texts += ["abc <|endoftext|> def", "x<|endoftext|><|endoftext|>y <|ENDOFTEXT|>", "<|endoftext|> a <|startoftext|>", " ́a b", "", None, prose(1, 500), "it's  we'll\n\n 'x' '. '", "x" * 5000]
    got = Encoder(Vocabulary.load(path, text_of_special))(texts)
    for a, b in zip(got, plain(path, texts, text_of_special), strict=True):
        assert np.array_equal(np.append(a, np.uint32(2)), b)


def test_contract_call():
    """The bare call takes the strings of special tokens as those tokens."""
    t = tokenizers.Tokenizer.from_file(WORD)
    want = t.encode("abc <|endoftext|> def", add_special_tokens=False).ids
    assert Encoder(Vocabulary.load(WORD))(["abc <|endoftext|> def"])[0].tolist() == want and 49407 in want


def test_ids_that_do_not_fit_are_an_error():
    with pytest.raises(ValueError):
        pack_file([1], [np.array([70_000], np.uint32)], 2)
    assert TokenFile(pack_file([1], [np.array([70_000], np.uint32)], 4)).ids.tolist() == [70_000]
    assert Vocabulary.load(WORD).width == 2


def test_a_task_that_runs_again_leaves_the_file(tmp_path):
    from pyarrow import fs

    class NoReplace:  # a store whose renaming does not replace
        def __init__(self):
            self.own = fs.LocalFileSystem()

        def move(self, a, b):
            if self.own.get_file_info(b).type == fs.FileType.File:
                raise OSError("exists")
            self.own.move(a, b)

        def __getattr__(self, name):
            return getattr(self.own, name)

    for _ in range(2):
        (tmp_path / "passing").write_bytes(b"x")
        _settle(NoReplace(), str(tmp_path / "passing"), str(tmp_path / "name"))
    assert [p.name for p in tmp_path.iterdir()] == ["name"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=200), st.integers(0, 2**20))
def test_elias_fano(values, more):
    values = np.array(sorted(values), np.int64)
    top = int(values[-1]) + more if len(values) else more
    held = EliasFano.encode(values, top)
    assert (held.select(np.arange(len(values))) == values).all()
    assert (len(held.low), len(held.high)) == EliasFano.sizes(len(values), top, held.bits)


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    held = EliasFano.encode(ends, int(ends[-1]))
    assert held.nbytes < len(ends) * 13 / 8 and held.before.nbytes <= held.high.nbytes / 16 + 8


def test_file_bytes_round_trip():
    ids = [np.arange(k, dtype=np.uint32) for k in (3, 0, 5, 1)]
    held = TokenFile(pack_file([None, -7, 2**40, 2**40], ids, 2))
    assert held.doc_id(np.arange(4)) == [None, -7, 2**40, 2**40]
    begin, stop = held.offsets(np.arange(4))
    assert [held.ids[a:b].tolist() for a, b in zip(begin, stop)] == [x.tolist() for x in ids]
    with pytest.raises(ValueError):
        TokenFile(b"x" * 100)


@pytest.mark.parametrize("size", [50, 1 << 22])
def test_files_of_a_table(docs, size):
    rows = [*EDGES, *((300 + k, prose(k, k)) for k in range(60))]
    got = read(write(docs(rows), WORD, 2, file_ids=size)).collect()
    want = {(i, len(x), zlib.crc32(x.astype("<u4").tobytes())) for (i, _), x in zip(rows, plain(WORD, [t for _, t in rows]))}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(rows)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in got]
    assert known == sorted(known, key=lambda d: (d is not None, d or 0))


def test_cut():
    assert cut(1, 4) == [0] and cut(4, 4) == [0] and cut(5, 4) == [0, 1] and cut(8, 4) == [0, 4] and cut(11, 4) == [0, 3, 7]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 60), max_size=20))
def test_plan_is_best_fit_decreasing(counts):
    plan, gaps, n = Plan(counts, 30), [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [k for k, g in enumerate(gaps) if g >= length]
            if fits:
                k = min(fits, key=lambda k: gaps[k])
                gaps[k] -= length
            else:
                gaps.append(30 - length)
    assert plan.sequences == len(gaps)
    used = defaultdict(list)
    for length, c in counts.items():
        for s, o in zip(*(x.tolist() for x in plan.place(np.full(c, length), np.arange(c)))):
            used[s].append((o, length))
    for parts in used.values():
        at = 0
        for o, length in sorted(parts):
            assert o == at
            at += length
        assert at <= 30
    assert sorted(30 - sum(x for _, x in p) for p in used.values()) == sorted(gaps)


def test_packing_a_table(docs):
    rows = [*EDGES, *((300 + k, prose(k, 7 * k)) for k in range(90))]
    got = pack(docs(rows), BYTE, 2, capacity=64).collect()
    want = []
    for (i, _), x in zip(rows, plain(BYTE, [t for _, t in rows])):
        starts = cut(len(x), 64)
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(x)])):
            want.append((i, k, a, b - a, zlib.crc32(x[a:b].astype("<u4").tobytes())))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    parts = defaultdict(list)
    for r in got:
        parts[r.sequence_id].append((r.offset, r.length))
    for p in parts.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 64
    assert len(parts) <= 1.1 * sum(r.length for r in got) / 64 + 1
    whole = {r.sequence_id: r for r in sequences(docs(rows), BYTE, 2, capacity=64).collect()}
    assert len(whole) == len(parts) and sum(len(r.ids) for r in whole.values()) == sum(w[3] for w in want)


def test_empty_table(docs):
    assert pack(docs([]), BYTE, 2).count() == 0
    assert read(write(docs([]), WORD, 2)).count() == 0
