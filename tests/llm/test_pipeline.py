"""Decontamination, and the stages of the pipeline one after the other."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from fleetlake.llm import decontam
from tests.conftest import rows_of
from tests.llm.conftest import sentence
from tests.llm.test_minhash import edited
from tests.llm.test_models import toxic_rows

ITEM = "item_id long, text string"


def words(text):
    return re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (text or "").lower())


def bag(some):
    return Counter(tuple(some[i : i + 5]) for i in range(max(1, len(some) - 4))) if some else Counter()


def brute_force(rows, items):
    """Pairs whose best item-sized window is similar enough."""
    out = set()
    for d, t in rows:
        own = words(t)
        for i, text in items:
            asked = words(text)
            for s in range(len(own) - len(asked) + 1 if asked else 0):
                a, b = bag(own[s : s + len(asked)]), bag(asked)
                if sum((a & b).values()) / sum((a | b).values()) >= 0.8 - 1e-9:
                    out.add((d, i))
    return out


def leaks():
    items = [(k, sentence(700 + k, 12 + 5 * k)) for k in range(8)]
    items += [(20, "four little words here"), (21, "echo echo echo echo echo echo echo"), (22, ""), (23, None), (24, items[2][1].upper())]
    rows = [(k, sentence(k, 80)) for k in range(20)]
    for k, (i, text) in enumerate(items[:8]):
        own = text.split()
        rows.append((100 + k, f"{sentence(50 + k, 20)} {text} {sentence(60 + k, 9)}"))
        rows.append((200 + k, " ".join(own[1:]) + " tail"))
        rows.append((300 + k, edited(text, k, 1)))
        rows.append((400 + k, " ".join(own[: len(own) // 2])))
    rows += [(500, items[3][1]), (500, items[3][1]), (501, "say four, little WORDS here!"), (502, "echo " * 30), (503, None), (None, items[4][1])]
    return rows, items


def test_matches_equal_brute_force(spark, make_docs, monkeypatch):
    rows, items = leaks()
    benchmark = spark.createDataFrame(items, ITEM)
    docs = make_docs(*rows)
    expected = brute_force(rows, items)
    assert set(rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id")) == expected
    # The same in blocks of the benchmark.
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 3)
    assert set(rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id")) == expected
    dirty = {d for d, _ in expected}
    clean = decontam.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter(r[0] for r in rows_of(clean, "doc_id")) == Counter(d for d, _ in rows if d not in dirty)


def test_odd_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(1, sentence(2))], ITEM)
    assert Counter(rows_of(decontam.contaminated(odd_docs, benchmark), "doc_id")) == {(3,): 2, (5,): 1, (8,): 1}
    assert decontam.contaminated(odd_docs, benchmark.limit(0)).count() == 0
    assert decontam.clean(no_docs, benchmark).count() == 0


def test_all_prints_within_the_radius_are_candidates():
    draw = random.Random(0)
    masks = set(decontam._MASKS.tolist())
    for _ in range(300):
        flips = draw.sample(range(64), decontam.RADIUS)
        assert any(sum(1 << (b % 16) for b in flips if b // 16 == k) in masks for k in range(4))


def test_texts_shorter_than_the_item(spark, make_docs):
    items = [(k, sentence(7000 + k, n)) for k, n in enumerate((6, 9, 14, 30, 60))]
    rows = []
    for k, text in items:
        own = text.split()
        for cut in range(min(len(own), 16)):
            rows += [(1000 * k + cut, " ".join(own[: len(own) - cut])), (1000 * k + 500 + cut, " ".join(own[cut:]))]
    rows += [(9000, " ".join(items[4][1].split()[2:50])), (9001, edited(" ".join(items[4][1].split()[1:]), 1, 1))]
    expected = set()
    for d, t in rows:
        for i, text in items:
            own, asked = words(t), words(text)
            for s in range(max(len(own) - len(asked), 0) + 1 if own else 0):
                a, b = bag(own[s : s + len(asked)]), bag(asked)
                if sum((a & b).values()) / sum((a | b).values()) >= 0.8 - 1e-9:
                    expected.add((d, i))
    benchmark, docs = spark.createDataFrame(items, ITEM), make_docs(*rows)
    assert (3001, 3) in expected and (3501, 3) in expected
    assert set(rows_of(decontam.contaminated(docs, benchmark), "doc_id", "item_id")) == expected


def test_similar_windows_beyond_the_radius():
    import numpy as np
    import pyarrow as pa

    from fleetlake.llm.common import lowered, text_buffer, word_hashes

    beyond = 0
    for k in range(1500):
        text = sentence(8000 + k, 54)
        # One edit inside leaves 45 of 55 shingles, and only one window of the item's size.
        own = text.split()
        own[20] = "changed"
        items = decontam.Items([k], pa.array([text]))
        word, _ = word_hashes(*text_buffer(lowered(pa.array([" ".join(own)]))))
        assert [m[:1] + m[2:] for m in items.matches(word)] == [(k, 0, 1)]
        gram = decontam.gram_hashes(word, 5)
        prints = decontam.simhash(decontam._signs(gram).sum(axis=0)[None])
        beyond += int(np.bitwise_count(prints[0] ^ items.prints[0])) > decontam.RADIUS
    assert beyond > 0


@pytest.fixture
def corpus(spark, tmp_path):
    """Tables with a case for each stage."""
    passage, item = sentence(800, 70), sentence(801, 25)
    rows = [(d, t) for d, t, _ in toxic_rows(300)]
    rows += [(1000 + k, edited(sentence(810, 200), k, k % 3)) for k in range(5)]
    rows += [(1100 + k, f"{sentence(820 + k, 40)} {passage} {sentence(840 + k, 40)}") for k in range(4)]
    rows += [(1200, f"{sentence(860, 30)} {item} {sentence(861, 30)}"), (1300, None), (None, sentence(870)), (1301, "")]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, 1, y) for d, _, y in toxic_rows(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], ITEM).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), passage


def test_every_stage_acts(spark, corpus):
    folder, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/out{k}")
        docs = spark.read.parquet(f"{folder}/out{k}")
        kept.append(docs)
        if k < 4:
            assert docs.columns == kept[0].columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    toxic = {d for d, _, y in toxic_rows(300) if y}
    assert len(toxic - ids[1]) > 0.9 * len(toxic) and len(ids[0] - ids[1] - toxic) < 5
    assert ids[1] - ids[2] == {1001, 1002, 1003, 1004, 1301}
    assert ids[3] == ids[2]
    cut = {r.doc_id: r for r in kept[3].where("doc_id between 1100 and 1103").collect()}
    assert len(cut) == 4 and all(passage not in r.text and len(r.text) == r.n_chars for r in cut.values())
    assert ids[3] - ids[4] == {1200}
    assert ids[5] == ids[4]
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (kept[4], kept[5]))
    assert {d: t or "" for d, t in before.items()} == after
    assert kept[5].where("n_tokens <> size(ids)").count() == 0


def test_run_gives_the_last_stage(spark, corpus):
    found = corpus_pipeline.run(spark, corpus[0])
    assert {"doc_id", "text", "ids", "n_tokens"} <= set(found.columns) and found.count() > 200
