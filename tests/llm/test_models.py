"""Toxicity, lattice likelihood and neighbour search against held-out rows and brute force."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fleetlake.llm import lattice, neighbours, toxicity
from tests.llm.conftest import sentence

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BAD = ["horrid", "vilest", "scummy", "wretch"]


def toxic_rows(n):
    draw, rows, known = random.Random(3), [], sentence(99, 400).split()
    for k in range(n):
        words, bad = draw.choices(known, k=draw.choice((20, 60, 200))), k % 4 == 0
        for _ in range(max(2, len(words) // 30) if bad else 0):
            words[draw.randrange(len(words))] = draw.choice(BAD)
        rows.append((k, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_rows_and_misspellings(spark, make_docs):
    rows = toxic_rows(600)
    docs = make_docs(*[r[:2] for r in rows])
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in rows], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert {d for d, r in found.items() if r.held_out} == {d for d in range(600) if zlib.crc32(str(d).encode()) % 3 == 1}
    held = [(found[d].predicted, y) for d, _, y in rows if found[d].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95
    model = toxicity.fit(docs, labels)
    plain = [" ".join(random.Random(k).choices(sentence(99, 400).split(), k=40)) for k in range(4)]
    misspelt = [f"{t} {w}" for t, w in zip(plain, ("horridd", "hhorrid", "vilestt", "scummyy"), strict=True)]
    assert toxicity.score_texts(pa.array(misspelt), model).min() > toxicity.score_texts(pa.array(plain), model).max()


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 1), (5, 1, 0), (5, 0, 0), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    found = toxicity.scores(odd_docs, labels).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert [r.score for r in toxicity.scores(odd_docs, labels.limit(0)).collect()] == [0.0] * len(found)
    assert toxicity.scores(no_docs, labels).count() == 0


def test_a_task_learns_and_not_the_driver(spark, make_docs, monkeypatch):
    rows = toxic_rows(60)
    docs = make_docs(*[r[:2] for r in rows], (0, "zz"), (None, "zz"))
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in rows], "doc_id long, quality int, toxic int")
    own = toxicity.fit(docs, labels)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    expected = toxicity.train(pa.array([t for _, t, _ in learned]), np.array([y for *_, y in learned]))
    assert own.bias == pytest.approx(expected.bias, rel=1e-3)
    assert np.allclose(own.weight, expected.weight, rtol=1e-2, atol=1e-2 * np.abs(expected.weight).max())

    def told(texts, labels):
        return toxicity.Model(np.full(1, len(labels), np.float32), float(os.getpid()))

    monkeypatch.setattr(toxicity, "train", told)
    model = toxicity.fit(docs, labels)
    assert model.weight.tolist() == [len(learned)]
    assert model.bias != os.getpid()


def test_sums_by_blocks_equal_those_of_all(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    draw = np.random.default_rng(2)
    values, source, into = draw.normal(size=30), draw.integers(0, 30, 100, np.int32), draw.integers(0, 9, 100, np.int32)
    assert (toxicity._gathered(values, source, into, 12) == np.bincount(into, values[source], 12)).all()
    assert toxicity._gathered(values, source[:0], into[:0], 3).tolist() == [0.0] * 3


def test_subword_bag_is_the_mean_of_distinct_words():
    model = toxicity.Model(np.random.default_rng(0).normal(size=toxicity.BUCKETS).astype(np.float32), 0.25)
    one, other, both = ("alpha", "beta", "alpha beta Alpha, beta!")
    logit = lambda t: (lambda p: math.log(p / (1 - p)))(toxicity.score_texts(pa.array([t]), model)[0]) - 0.25
    n = toxicity.PADDING
    assert logit(both) * (n + 2) == pytest.approx((logit(one) + logit(other)) * (n + 1), rel=1e-6)


def lattice_rows():
    rows = [(k, sentence(k, 30) + " the of the " + "ABC déjà 日本") for k in range(60)]
    return rows + [(100, None), (101, ""), (None, "the of"), (None, None), (3, rows[3][1]), (200, "q" * 300 + " x\x0bY\x1cz")]


def word_probability(word, scores, longest):
    """Sum over all segmentations, from the definition."""
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        total[end] = sum(total[b] * scores.get(word[b:end], 0.0) for b in range(max(0, end - longest), end))
    return total[-1]


def test_lattice_equals_brute_force(make_docs):
    rows = lattice_rows()
    docs = make_docs(*rows)
    split = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    vocabulary = lattice.pieces(PIECES)
    counts, piece_counts, n_texts = Counter(), Counter(), 0
    for d, t in rows:
        if not held(d):
            n_texts += 1
            counts.update([*split(t), None])
            piece_counts.update(i for one in vocabulary.model.encode(split(t)) for i in one)
    n, v = sum(counts.values()), len(counts)
    total = sum(piece_counts.values()) + n_texts + len(vocabulary.bytes_of) + 1
    scores = Counter()
    for i, b in enumerate(vocabulary.bytes_of):
        if b is not None:
            scores[b] += (piece_counts[i] + 1) / total
    longest = max(map(len, scores))
    found = lattice.likelihoods(docs, PIECES).collect()
    assert len(found) == len(rows)
    by_id = {}
    for d, t in rows:
        words = split(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words, None])
        own = math.log10((n_texts + 1) / total)
        if d != 200:
            own += sum(math.log10(word_probability(b"\0" + w.encode(), scores, longest)) for w in words)
        by_id[d, len(words) + 1] = (held(d), len(words) + 1, sum(counts[w] > 0 for w in [*words, None]), n, base, own)
    for r in found:
        expected = by_id[r.doc_id, r.n_tokens]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[:4]
        assert r.base_score == pytest.approx(expected[4])
        if r.doc_id != 200:
            assert r.score == pytest.approx(expected[5])


def test_long_words_agree_with_the_matrix_form():
    strings, scores = [b"a", b"b", b"ab", b"\0a", b"\0", b"ba"], np.log([0.3, 0.2, 0.2, 0.1, 0.1, 0.1])
    own = lattice.Lattice(strings, scores)
    word = np.frombuffer(b"abbaabab" * 7, np.uint8)
    short = own.words(word, np.array([0]), np.array([len(word)]))[0]
    assert own._long(word) == pytest.approx(short)
    assert math.exp(short) == pytest.approx(word_probability(b"\0" + word.tobytes(), dict(zip(strings, np.exp(scores), strict=True)), 2))


def test_lattice_of_odd_rows(odd_docs, no_docs):
    assert lattice.likelihoods(odd_docs, PIECES).count() == odd_docs.count()
    assert lattice.likelihoods(no_docs, PIECES).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_neighbours(rows, every=100):
    usable = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    size = Counter(len(v) for _, v in usable).most_common(1)[0][0]
    usable = [(i, v) for i, v in usable if len(v) == size]
    out = {}
    for q, a in usable:
        if q % every == 0:
            best = sorted({(float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in usable if i != q})
            nearest = {}
            for d, i in best:
                nearest.setdefault(i, d)
            out.setdefault(q, []).extend(sorted((d, i) for i, d in nearest.items()))
    return out


def test_search_finds_the_neighbours(spark):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.4 * draw.normal(size=16)).astype(np.float32).tolist(), 0) for k in range(4000)]
    found = neighbours.self_search(vectors(spark, rows)).collect()
    expected = brute_neighbours(rows)
    hits = sum((r.vec_id, round(r.score, 9)) in {(i, round(d, 9)) for d, i in expected[r.query_id][:10]} for r in found)
    assert len(found) == 400 and hits / 400 >= 0.9
    assert {r.rank for r in found} == set(range(1, 11))


def test_search_of_odd_vectors(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(k, same, 0) for k in range(2500)] + [(3000, [1.5, 2.0, 2.0], 0), (3100, [float("nan"), 1.0, 1.0], 0), (3200, None, 0)]
    rows += [(3300, [0.0, 0.0, 0.0], 0), (3400, [1.0, None, 1.0], 0), (3500, [1.0, 2.0], 0), (None, same, 0), (3600, [float("inf"), 1.0, 1.0], 0)]
    rows += [(3000, [1.5, 2.0, 2.0], 0)]
    found = {}
    for r in neighbours.self_search(vectors(spark, rows)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {*range(0, 2500, 100), 3000}
    assert found[0] == [(k, k, 0.0) for k in range(1, 11)]
    assert found[3000] == [(k + 1, k, 0.5) for k in range(10)]
    few = [(0, same, 0), (1, [1.0, 2.0, 3.0], 0)]
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.self_search(vectors(spark, few)).collect()] == [(0, 1, 1, 1.0)]
    assert neighbours.self_search(vectors(spark, [])).count() == 0


def test_copies_crowd_out_no_other_row(spark, monkeypatch):
    draw = np.random.default_rng(8)
    many = draw.normal(size=(60, 6)).astype(np.float32).tolist()
    rows = [(0, many[0], 0)] + [(5, many[5], 0)] * 60 + [(k, many[k], 0) for k in range(1, 60) if k != 5]
    for size in (neighbours.CHUNK_ROWS, 16):
        monkeypatch.setattr(neighbours, "CHUNK_ROWS", size)
        for every, extra in ((100, []), (5, [(5, many[7], 0)])):
            found = neighbours.self_search(vectors(spark, rows + extra), every).collect()
            if not extra:
                expected = brute_neighbours(rows, every)
                assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [
                    (q, k + 1, i) for q in sorted(expected) for k, (_, i) in enumerate(sorted(expected[q])[:10])
                ]
            assert Counter(r.query_id for r in found) == dict.fromkeys(range(0, 60, every), 10)


def test_parts_are_balanced():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(600, 8))
    label = neighbours.balanced_parts(x, neighbours.nearest(x, x, 11), 7)
    assert np.bincount(label, minlength=7).max() <= math.ceil(1.1 * 600 / 7)
