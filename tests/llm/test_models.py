import random
import zlib

import numpy as np
from inputs import EDGES, prose

from pyspark.sql import functions as F

from trajloom.llm import language, quality

FRENCH = "le la les une dans pour avec être très où déjà maison rivière lumière musique eau sept huit".split()


def french(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(FRENCH) for _ in range(n))


def test_recurrent_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    net = language.Network(["a", "b", "c"], hidden=3)
    net.x, net.h, net.o = (w.astype(np.float64) for w in (net.x, net.h, net.o))
    data = rng.integers(97, 101, (7, 4)).astype(np.uint8)
    want, mask = np.array([0, 1, 2, 1]), np.ones((7, 4), np.float32)
    mask[5:, 1] = 0
    _, grads = net.gradient(data, want, mask)
    for w, g in zip((net.x, net.h, net.o), grads):
        for at in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 6):
            old, step = w.flat[at], 1e-2
            w.flat[at] = old + step
            up = net.gradient(data, want, mask)[0]
            w.flat[at] = old - step
            down = net.gradient(data, want, mask)[0]
            w.flat[at] = old
            assert abs((up - down) / (2 * step) - g.flat[at]) < 2e-3 + 0.02 * abs(g.flat[at])


def test_scores_do_not_depend_on_the_batch():
    net = language.Network(["a", "b"])
    texts = [b"", b"x", b"abc" * 50, b"q" * 128, b"hello world " * 100]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    all_ = net.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, t in enumerate(texts):
        own = net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        np.testing.assert_allclose(own[0], all_[k], atol=1e-5)
        assert abs(own.sum() - (1 if t else 0)) < 1e-4
    # every byte is labelled: the mean over runs is the mean over positions
    t = texts[4]
    runs = [np.frombuffer(t[k : k + language.RUN], np.uint8) for k in range(0, len(t), language.RUN)]
    p = np.concatenate([net.label(net.run(r[:, None]))[:, 0] for r in runs])
    assert len(p) == len(t)
    np.testing.assert_allclose(p.mean(0), all_[4], atol=1e-5)


def test_language_of_a_table(spark):
    rows = [(k, prose(k, 20 + k % 30), "en") for k in range(80)] + [(100 + k, french(k, 20 + k % 30), "fr") for k in range(80)]
    odd = [(300, None, "en"), (301, "", None), (302, "12 !? 34", "fr"), (None, "the house", "en"), (303, french(9, 9000), None), (304, "ж漢", None), (304, "ж漢", None)]
    df = spark.createDataFrame([(i, t, x, 1) for i, t, x in rows + odd], "doc_id long, text string, lang string, id int")
    got = language.identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    for i, _, _ in rows:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    right = [by[i].lang_pred == x for i, _, x in rows if by[i].held_out]
    assert np.mean(right) > 0.95
    assert [by[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and by[303].lang_pred == "fr"
    assert by[None].held_out is False and by[304].lang_pred in ("en", "fr") and all(0 <= r.score <= 1 for r in got)
    nothing = language.identify(df.where("lang is null")).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == 4
    assert language.identify(df.limit(0)).count() == 0


def test_a_rare_language_is_learned(spark):
    rows = [(k, f"the house {k}", "en") for k in range(6000)] + [(6001 + 7 * k, f"дом {k}", "ru") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.each_sample(df, "lang", 50, 100)
    assert sum(x == "en" for _, x in got) == 50 and sorted(t for t, x in got if x == "ru") == ["дом 0", "дом 1", "дом 2"]
    order = df.where("lang = 'en'").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(50).collect()
    assert [t for t, x in got if x == "en"] == [r.text for r in order]
    many = df.where("lang = 'en'").unionAll(df.where("doc_id = 6008").withColumn("doc_id", F.lit(5).cast("long")))
    assert language.train(many, held=2, window=100).languages == ["en", "ru"]
    assert language.each_sample(df.limit(0), "lang", 50, 100) == []


def test_convolution_gradient_is_the_slope():
    rng = np.random.default_rng(2)
    net = quality.Network()
    texts = [b"hello there", b"aaa bbb aaa bbb", b"", b"x!! y!! z!!"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    want = np.array([1, 0, 1, 0], np.float32)
    net.embed, net.near, net.bias, net.out = (w.astype(np.float64) for w in (net.embed, net.near, net.bias + 0.1, net.out))
    _, grads = net.gradient(data, offsets, want)
    for w, g in zip((net.embed, net.near, net.bias, net.out), grads):
        for at in rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 4):
            old, step = w.flat[at], 1e-3
            w.flat[at] = old + step
            up = net.gradient(data, offsets, want)[0]
            w.flat[at] = old - step
            down = net.gradient(data, offsets, want)[0]
            w.flat[at] = old
            assert abs((up - down) / (2 * step) - g.flat[at]) < 2e-3 + 0.05 * abs(g.flat[at])


def test_chunks_cover_the_text_and_nothing_else():
    net = quality.Network()
    texts = [b"", b"abcdefgh" * 40, b"z", b"the end of it"]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    all_ = net.score(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, t in enumerate(texts):
        assert abs(net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] - all_[k]) < 1e-5
    base = net.score(np.frombuffer(texts[1], np.uint8), np.array([0, 320]))[0]
    changed = [texts[1][:k] + b"\xff" + texts[1][k + 1 :] for k in (0, 150, 319)]
    net.embed[255] = 30
    assert all(abs(net.score(np.frombuffer(t, np.uint8), np.array([0, 320]))[0] - base) > 1e-6 for t in changed)


def test_repeats():
    laid, first = quality.cells(np.frombuffer(b"ababababcc", np.uint8), np.array([0, 10]))
    share = quality.repeats(laid)
    assert share[0, 1] == 6 / 8 and share[0, 0] == 0 and share[1, 0] == 1 / 8 and first.tolist() == [0, 2 + quality.PAD]


def test_quality_of_a_table(spark, docs):
    good = [(k, prose(k, 30 + k % 50)) for k in range(150)]
    bad = [(200 + k, " ".join(w + random.Random(k + j).choice(["&&&", "$$$", "%%%"]) for j, w in enumerate(prose(k, 40).split()))) for k in range(150)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _ in good + bad] + [(7000, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = [*good, *bad, *((1000 + (i or 0), t) if i else (None, t) for i, t in EDGES)]
    got = quality.scored(docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    held = [i for i, _ in good + bad if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i, _ in good + bad if by[i].held_out] == held
    assert np.mean([(by[i].score >= 0.7) == (i < 200) for i in held]) > 0.95
    assert quality.scored(docs([]), labels).count() == 0
    assert quality.scored(docs(rows), labels.limit(0)).count() == len(rows)


def test_quality_needs_labels_of_both_classes_among_the_documents(spark, docs):
    rows = [(k, prose(k, 60) if k % 2 else "$$$ " * 60) for k in range(120)]
    label = lambda pairs: spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")
    own = [(k, k % 2, 0) for k in range(120)]
    foreign = label([(10_000 + k, k % 2, 0) for k in range(30_000)])
    mixed = quality.scored(docs(rows), label(own).union(foreign)).collect()
    alone = quality.scored(docs(rows), label(own)).collect()
    assert [(r.doc_id, round(r.score, 6)) for r in mixed] == [(r.doc_id, round(r.score, 6)) for r in alone]
    assert np.mean([r.predicted == r.doc_id % 2 for r in mixed]) > 0.9
    for none in (foreign, label([]), label([(k, 1, 0) for k in range(120)]), label([(k, None, 0) for k in range(120)])):
        got = quality.scored(docs(rows), none).collect()
        assert len(got) == 120 and {(r.score, r.predicted) for r in got} == {(0.5, 0)}
    assert quality.scored(docs([]), label([])).count() == 0


def test_quality_equals_a_slow_forward_pass():
    """Every chunk by itself: embedding, repeats, filters, largest response, logistic layer."""
    net, rng = quality.Network(), np.random.default_rng(3)
    net.bias[:] = rng.normal(0, 0.2, net.bias.shape)
    texts = [b"", b"x", b"abcabcabc" * 9, "déjà vu\n".encode() * 30, bytes(rng.integers(1, 256, 333, dtype=np.uint8))]
    got = net.score(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
    for t, p in zip(texts, got):
        cells = -(-len(t) // quality.CELL)
        laid = np.frombuffer(t.ljust(cells * quality.CELL, b"\0") + bytes(quality.PAD * quality.CELL), np.uint8)
        best = np.zeros(quality.FILTERS)
        for c in range(cells + quality.PAD):
            total = net.bias.astype(float).copy()
            for half in (0, 1):
                if c + half >= cells + quality.PAD:
                    continue
                part = range((c + half) * quality.CELL, (c + half + 1) * quality.CELL)
                flags = [sum(k >= lag and laid[k] and laid[k] == laid[k - lag] for k in part) / quality.CELL for lag in range(1, quality.LAGS + 1)]
                x = np.concatenate([net.embed[laid[k]] for k in part] + [np.array(flags)])
                total += x @ net.near[half].astype(float)
            best = np.maximum(best, total)
        want = 1 / (1 + np.exp(-(best @ net.out[:-1] + net.out[-1])))
        assert abs(p - want) < 1e-4


def test_language_equals_a_slow_forward_pass(spark):
    """Byte by byte with one state, both ways, run by run; the mean of the labels of all bytes."""
    net = language.Network(["a", "b", "c"], seed=5)
    text = ("the house " * 30 + "été").encode()
    sig = lambda v: 1 / (1 + np.exp(-v))
    size, labels = net.h.shape[1], []
    for lo in range(0, len(text), language.RUN):
        run = text[lo : lo + language.RUN]
        both = []
        for way in (0, 1):
            h, out = np.zeros(size), []
            for b in run if way == 0 else run[::-1]:
                row, rec = net.x[way][b].astype(float), h @ net.h[way].astype(float)
                z, r = sig(row[:size] + rec[:size]), sig(row[size : 2 * size] + rec[size : 2 * size])
                c = np.tanh(row[2 * size :] + r * rec[2 * size :])
                h = z * h + (1 - z) * c
                out.append(h)
            both.append(out if way == 0 else out[::-1])
        for f, g in zip(*both):
            e = np.exp(np.concatenate([f, g, [1.0]]) @ net.o.astype(float))
            labels.append(e / e.sum())
    got = net.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    other = np.mean(labels, axis=0)
    assert np.abs(got - other).max() < 1e-3
