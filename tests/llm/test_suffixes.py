from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetlake.llm import suffixes
from tests.llm.conftest import sentence


def brute_force(rows):
    """Per row (id, bytes, removed, runs, digest), from all strings of all texts."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    n = suffixes.LENGTH
    seen = Counter(b[i : i + n] for _, b in texts for i in range(len(b) - n + 1))
    out = Counter()
    for d, b in texts:
        gone = np.zeros(len(b) + 1, np.int8)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = 1
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out[d, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()] += 1
    return out


def passages():
    draw = random.Random(5)
    shared = [sentence(100 + k, 70) for k in range(6)]
    rows = [(k, " ".join([sentence(k, 30), draw.choice(shared), sentence(1000 + k, 20), draw.choice(shared)])) for k in range(40)]
    rows += [(50, shared[0][:199]), (51, shared[1][:200]), (52, "a" * 1500), (53, "ab" * 400), (54, "é" * 300)]
    rows += [(55, sentence(7, 30) + shared[2][30:260]), (56, "x" + shared[2][29:255] + "é"), (57, None), (58, "")]
    rows += [(60 + k, rows[3][1]) for k in range(30)] + [(3, rows[3][1]), (None, rows[5][1]), (None, None)]
    return rows


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_removals_equal_brute_force(make_docs, batches):
    rows = passages()
    found = suffixes.removals(make_docs(*rows), batches)
    assert Counter(map(tuple, found.collect())) == brute_force(rows)


def test_seeds_of_many_stretches(make_docs):
    # Every piece of one passage, of any length and place, in texts of their own; some differ in one byte.
    draw = random.Random(9)
    passage = sentence(77, 90)[:420]
    rows = []
    for k in range(150):
        first = draw.randrange(0, 200)
        piece = passage[first : first + draw.randrange(195, 221)]
        if k % 3 == 0:
            at = draw.randrange(len(piece))
            piece = piece[:at] + "#" + piece[at + 1 :]
        rows.append((k, f"{sentence(200 + k, 20)} {piece}{chr(65 + k % 26)} {sentence(500 + k, 20)}"))
    found = suffixes.removals(make_docs(*rows))
    assert Counter(map(tuple, found.collect())) == brute_force(rows)


def test_blocks_hold_every_string_once():
    draw = np.random.default_rng(1)
    data = draw.integers(0, 256, 900).astype(np.uint8)
    anchor, far, near = np.array([300, 500, 250]), np.array([57, 168, 8]), np.array([3, 100, 8])
    edge, place, strings, skip, core1, _, left, right = suffixes.blocks_of(data, anchor, far, near)
    found = sorted((e, p + i) for e, p, n in zip(edge, place, strings, strict=True) for i in range(n))
    assert found == sorted((e, a - o) for e, (a, f, c) in enumerate(zip(anchor, far, near, strict=True)) for o in range(c, f + 1))
    for p, n, s, before, behind in zip(place, strings, skip, left, right, strict=True):
        core = p + s + n - 1
        assert before.tobytes() == bytes(data[p:core][::-1]).ljust(8, b"\0")
        end = core + suffixes.LENGTH - suffixes.BLOCK + 1
        assert behind.tobytes() == bytes(data[end : end + suffixes.BLOCK - 1 - s]).ljust(8, b"\0")
    assert len(core1) == len(edge)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(map(tuple, suffixes.removals(odd_docs).collect())) == brute_force(rows)
    assert suffixes.removals(no_docs).count() == 0
    cut = suffixes.without_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()


def test_columns_named_like_own_ones(odd_docs):
    docs = odd_docs.selectExpr("*", "doc_id as __k1", "'a' as __K2", "'b' as __left", "text as __cut")
    cut = suffixes.without_repeats(docs)
    same = [c for c in docs.columns if c not in ("text", "n_chars")]
    assert cut.columns == docs.columns
    assert Counter(cut.select(*same).collect()) == Counter(docs.select(*same).collect())


def test_repeated_rows_meet_once(make_docs):
    text = " ".join([sentence(1, 60), sentence(2, 20), sentence(1, 60)])
    rows = [(1, text)] * 60 + [(None, text)] * 40 + [(2, sentence(1, 60))]
    docs = make_docs(*rows)
    runs = suffixes.repeated_strings(docs).collect()
    assert len(runs) == 3
    assert all(len(r.starts) == len(set(zip(r.starts, r.strings, strict=True))) for r in runs)
    assert Counter(map(tuple, suffixes.removals(docs).collect())) == brute_force(rows)


def test_cut_texts_are_what_is_left(make_docs):
    rows = passages()
    cut = suffixes.without_repeats(make_docs(*rows))
    left = {r.doc_id: r for r in cut.where("doc_id < 40").collect()}
    plain = {d: (t, n, s) for d, _, n, _, s in brute_force(rows) for t in [None]}
    for doc_id, row in left.items():
        assert hashlib.sha256(row.text.encode()).hexdigest() == plain[doc_id][2]
        assert row.n_chars == len(row.text)
    assert cut.where("doc_id = 57").first().text is None


def test_every_window_has_one_anchor():
    draw = np.random.default_rng(0)
    for size in (200, 201, 700, 5000):
        data = draw.integers(97, 100, size).astype(np.uint8)
        row, first, count, place, _ = suffixes.anchors(data, np.array([0, size]))
        starts = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count, strict=True)])
        assert sorted(starts.tolist()) == list(range(size - 199))
        assert ((place >= first + count - 1) & (place + suffixes.SEED <= first + 200)).all()
