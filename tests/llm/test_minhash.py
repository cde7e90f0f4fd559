from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from fleetlake.llm import graph, minhash
from tests.conftest import rows_of
from tests.llm.conftest import sentence


def shingles(text):
    words = re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def probability_jaccard(a, b):
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def brute_force(rows):
    bags = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, j in combinations(range(len(rows)), 2):
        if (not bags[i] and not bags[j]) or (bags[i] and probability_jaccard(bags[i], bags[j]) >= 0.8 - 1e-9):
            parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(k) for k in range(len(rows))]


def edited(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def near_rows():
    rows = [(k, sentence(k, 150)) for k in range(20)]
    base = sentence(500, 200)
    rows += [(100 + k, edited(base, k, k % 4)) for k in range(25)]
    rows += [(200 + k, base.upper()) for k in range(10)]
    rows += [(300, base + " " + base), (301, " ".join(base.split()[:100])), (302, "One two"), (303, "one, two!"), (304, "")]
    chain = sentence(900, 120)
    for k in range(6):
        rows.append((400 + k, chain))
        chain = edited(chain, k, 2)
    return rows


def test_classes_equal_brute_force(make_docs):
    rows = near_rows()
    classes = brute_force(rows)
    expected = [(d, min(r[0] for r, c in zip(rows, classes, strict=True) if c == own)) for (d, _), own in zip(rows, classes, strict=True)]
    found = minhash.near_duplicates(make_docs(*rows))
    assert rows_of(found, "doc_id", "class_id") == sorted(expected, key=repr)
    assert rows_of(found.where("keep"), "doc_id") == sorted({(c,) for _, c in expected}, key=repr)


def test_one_document_of_each_class_stays(make_docs):
    rows = near_rows()
    docs = make_docs(*rows)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(brute_force(rows)))


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    classes = brute_force(rows)
    found = minhash.near_duplicates(odd_docs)
    assert found.count() == len(rows)
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(classes))
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.deduplicated(no_docs).count() == 0


def test_registers_estimate_the_index():
    random_ = np.random.default_rng(1)
    hashes = random_.integers(0, 2**63, 60).astype(np.uint64)
    a, b = random_.integers(1, 6, 60), random_.integers(0, 6, 60)
    b_hashes, b = hashes[b > 0], b[b > 0]
    exact = minhash.probability_jaccard(
        (np.sort(hashes), a[np.argsort(hashes)]), (np.sort(b_hashes), b[np.argsort(b_hashes)])
    )
    ca, cb = dict(zip(hashes.tolist(), a.tolist(), strict=True)), dict(zip(b_hashes.tolist(), b.tolist(), strict=True))
    assert exact == pytest.approx(probability_jaccard(Counter(ca), Counter(cb)))
    agree = []
    for salt in range(20):
        salted = [h ^ np.uint64(salt * 7919) for h in (hashes, b_hashes)]
        own = minhash.signatures(
            np.concatenate(salted), np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        )
        agree.append((own[0] == own[1]).mean())
    assert np.mean(agree) == pytest.approx(exact, abs=0.03)


def test_signatures_do_not_depend_on_the_company():
    hashes = np.random.default_rng(2).integers(0, 2**63, 500).astype(np.uint64)
    weights = np.ones(500, np.int64)
    alone = minhash.signatures(hashes[:7], weights[:7], np.array([0, 7]))
    among = minhash.signatures(hashes, weights, np.array([0, 7, 7, 500]))
    assert (alone[0] == among[0]).all() and (among[1] == 0).all()


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    found = dict(rows_of(graph.components(edges)))
    assert {found[k] for k in range(41)} == {0} and {found[k] for k in range(100, 130)} == {100}
    assert found[201] == 200
    assert graph.components(edges.limit(0)).count() == 0


def changed(text, places, mark):
    words = text.split()
    for place in places:
        words[place] += mark
    return " ".join(words)


def test_near_pairs_among_less_similar_texts(make_docs):
    # Buckets of a near pair are filled by texts that are about 0.73 similar to one of the two.
    rows, expected = [], []
    for family in range(3):
        base = sentence(3000 + family, 200)
        near = changed(base, (31, 71, 111, 151), "x")
        assert 0.8 <= probability_jaccard(shingles(base), shingles(near)) < 0.85
        own = 1000 * family
        rows += [(own, base), (own + 1, near)]
        expected += [(own, own), (own + 1, own)]
        for k in range(2, 250):
            places = random.Random(own + k).sample(range(5, 195, 6), 6)
            rows.append((own + k, changed(base, places, f"o{k}")))
            expected.append((own + k, own + k))
    found = minhash.near_duplicates(make_docs(*rows))
    assert rows_of(found, "doc_id", "class_id") == sorted(expected, key=repr)


def test_near_rows_share_a_leading_shingle():
    draw = np.random.default_rng(3)
    times = np.zeros(minhash.COUNTERS, np.int64)
    near = 0
    for _ in range(3000):
        n = int(draw.integers(2, 120))
        base = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        bags = []
        for _ in range(2):
            stay = base[draw.random(len(base)) > 0.08]
            bags.append((stay, 1 + (draw.random(len(stay)) < draw.choice([0, 0.005, 0.1])).astype(np.int64)))
        if not all(len(b[0]) for b in bags) or minhash.probability_jaccard(*bags) < 0.8:
            continue
        near += 1
        found = []
        for hashes, weights in bags:
            at, _, size, even, inner = minhash.leading(hashes, weights, np.array([0, len(hashes)]), times)
            found.append(({int(h): bool(i) for h, i in zip(hashes[at], inner, strict=True)}, int(size[0]), bool(even[0])))
        (a, size_a, even_a), (b, size_b, even_b) = found
        common = a.keys() & b.keys()
        if even_a and even_b:
            common = {h for h in common if (a[h] or size_a > size_b) and (b[h] or size_b > size_a)}
        assert common
    assert near > 500


def test_parities_never_part_near_rows(spark):
    """Bits that differ stay below the distance, and the bound cuts no near pair but most others."""
    draw, rows, near = np.random.default_rng(5), [], []
    for _ in range(1500):
        base = np.unique(draw.integers(0, 2**63, int(draw.integers(2, 300))).astype(np.uint64))
        loss, repeats = draw.choice([0.02, 0.06, 0.1, 0.2]), draw.choice([0, 0.005, 0.1])
        bags = []
        for _ in range(2):
            own = np.concatenate([base[draw.random(len(base)) > loss], draw.integers(0, 2**63, int(loss * len(base))).astype(np.uint64)])
            own = np.unique(own)
            bags.append((own, 1 + (draw.random(len(own)) < repeats).astype(np.int64)))
        if not all(len(b[0]) for b in bags):
            continue
        masks = [minhash.parities(h, w, np.array([0, len(h)]))[0] for h, w in bags]
        weights = [dict(zip(h.tolist(), w.tolist(), strict=True)) for h, w in bags]
        distance = sum(abs(weights[0].get(h, 0) - weights[1].get(h, 0)) for h in weights[0].keys() | weights[1].keys())
        assert sum(int(x ^ y).bit_count() for x, y in zip(*masks, strict=True)) <= distance
        share = [float(minhash.repeated_share(w, np.array([0, len(w)]))[0]) for _, w in bags]
        side = [[int(w.sum()), e, *(m.view(np.int64).tolist())] for (_, w), e, m in zip(bags, share, masks, strict=True)]
        near.append(minhash.probability_jaccard(*bags) >= 0.8)
        rows.append((len(near) - 1, *side[0], *side[1]))
    names = [f"{c}_{s}" for s in "ab" for c in ("size", "repeated", *minhash.MASKS)]
    kinds = ["double" if n.startswith("repeated") else "long" for n in names]
    table = spark.createDataFrame(rows, "n long, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    cut = {r.n: r.far for r in table.select("n", minhash.far_apart().alias("far")).collect()}
    assert sum(near) > 200 and not any(cut[n] for n, is_near in enumerate(near) if is_near)
    assert np.mean([cut[n] for n, is_near in enumerate(near) if not is_near]) > 0.6


def test_columns_named_like_own_ones(odd_docs):
    docs = odd_docs.selectExpr("*", "doc_id as __k1", "'a' as __K2")
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    plain = sorted(minhash.deduplicated(odd_docs).collect(), key=repr)
    assert sorted((r[: len(plain[0])] for r in kept.collect()), key=repr) == sorted(map(tuple, plain), key=repr)
