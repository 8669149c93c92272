"""Queries that SQL cannot express, and the pipeline, against plain versions of their definitions."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from revbridge.llm import ann, license_scan, packing, quality_rules, sharding, simhash, suffix_array
from revbridge.llm.common import Scratch
from revbridge.llm.queries import MIN_SITES, PACK_BUCKETS, PACK_BUDGET, PACK_LEN, queries

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_simhash(spark, documents):
    got = rows(queries()["op2_simhash"](spark, SF), "doc_id", "fingerprint", "component_id")
    assert got == sorted((d, f"{f:016x}", c) for d, f, c in brute.simhash([r[:2] for r in documents]))


def test_suffix_dedup(spark, documents):
    got = rows(queries()["op7_suffix_dedup"](spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeats([r[:2] for r in documents]))


def test_license_base(spark, documents):
    got = queries()["op4_license_scan"](spark, SF).collect()
    want = {d: brute.license_base(t) for d, t, _ in documents}
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == want[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_license_suppression_is_that_of_the_rules():
    """Every match of every rule, none gated, resolved pair by pair."""
    import re

    text = (
        "Licensed under the MIT License. SPDX-License-Identifier: Apache-2.0 see the GNU Lesser General Public License version 2.1 "
        "or later. Licensed under CC BY-NC-SA 4.0 International. All rights reserved. Copyright (c) 2020 Permission is hereby granted, "
        "free of charge, to any person obtaining a copy. the unlicense; licensed under the terms of the Mozilla Public License v 2.0"
    )
    words = license_scan.words_of(text)
    joined = " " + b" ".join(words).decode() + " "
    signatures = license_scan.signatures()
    matches = [(s, i, m.start(), m.end()) for i, s in enumerate(signatures) for m in re.finditer(rf"(?<= ){s.pattern}(?= )", joined)]
    matches.sort(key=lambda m: (-m[0].priority, m[2] - m[3], m[2], m[1]))
    accepted = []
    for m in matches:
        if not any(a[2] <= m[2] and m[3] <= a[3] for a in accepted):
            accepted.append(m)
    want = sorted((s.label, joined[:a].count(" ") - 1, joined[:b].count(" "), i) for s, i, a, b in accepted)
    got = sorted((d.label, d.start, d.end, d.rule) for d in license_scan.detections(words))
    assert got == want
    assert {"mit", "apache", "lgpl", "cc-by-nc-sa", "mpl", "unlicense", "all rights reserved"} <= {d[0] for d in got}
    assert "cc-by" not in {d[0] for d in got} and "gpl" not in {d[0] for d in got}
    assert len(signatures) > 300


def test_license_labels_and_scores_over_the_table(spark, documents):
    """All rules on every whole text without any gate, resolved pair by pair."""
    signatures = license_scan.signatures()
    rules = [re.compile(rf"(?<= ){s.pattern}(?= )") for s in signatures]
    extra = [(10**6 + i, f"Notes. {words.title()}, and more.") for i, (_, _, _, words) in enumerate(license_scan.CLAUSES)]
    extra += [(2 * 10**6, " ".join(words for _, _, _, words in license_scan.CLAUSES)), (2 * 10**6 + 1, "Licensed under the MIT License, All Rights Reserved")]
    texts = [r[:2] for r in documents] + extra
    want = {}
    for d, t in texts:
        joined = " " + b" ".join(license_scan.words_of(t)).decode() + " "
        found = sorted(((-s.priority, m.start() - m.end(), m.start(), i, m.end()) for i, (s, r) in enumerate(zip(signatures, rules)) for m in r.finditer(joined)))
        kept = []
        for _, _, a, i, b in found:
            if not any(x <= a and b <= y for x, y, _ in kept):
                kept.append((a, b, i))
        base = [x for x in brute.license_base(t)[4].split(",") if x]
        labels = sorted({signatures[i].label for _, _, i in kept} | set(base))
        want[d] = (",".join(labels), max([signatures[i].confidence for _, _, i in kept] + [0.7] * bool(base), default=0.0))
    got = license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.labels, r.score) for r in got.collect()} == want
    assert all(label in want[10**6 + i][0].split(",") for i, (label, _, _, _) in enumerate(license_scan.CLAUSES))
    table = {r.doc_id: (r.labels, r.score) for r in queries()["op4_license_scan"](spark, SF).collect()}
    assert table == {d: want[d] for d, *_ in documents}


def test_every_license_rule_names_a_keyword_its_matches_hold():
    """A rule's keyword gate never hides a match of its own."""
    automaton, patterns = license_scan._compiled()
    for family in license_scan.FAMILIES:
        for name in family[2].split("|"):
            assert name == name.lower().strip()
    for text in ("licensed under gpl license", "mit license", "gnu general public license version 3", "apache software license", "eclipse public licence"):
        words = text.encode().split()
        joined = " " + text + " "
        gated = {d.rule for d in license_scan.detections(words)}
        ungated = [i for i, p in enumerate(patterns) if p.search(joined)]
        assert bool(gated) == bool(ungated), text


def test_nearest_is_exact_here(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = rows(queries()["op10_nearest"](spark, SF), "query_id", "rank", "vec_id", "score")
    want = sorted(brute.nearest(vectors, 5, lambda i: i % 50 == 0))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], abs_tol=1e-12) for g, w in zip(got, want))


def test_recall_of_random_vectors():
    """The hardest case for one-bit codes: no structure.  Recall of the 5 nearest stays above 0.9."""
    rng = np.random.default_rng(1)
    for dim in (16, 64, 100):
        data = rng.standard_normal((4000, dim))
        turn = ann.rotation(dim)
        words, correction = ann.encode(ann.unit(data), turn)
        near = ann.Nearest(ann.QueryBlock(np.arange(60), data[:60], turn), 5)
        for i in range(0, 4000, 512):
            s = slice(i, i + 512)
            near.add(np.arange(4000)[s], words[s], correction[s], data[s])
        exact = ann.unit(data[:60]) @ ann.unit(data).T
        exact[np.arange(60), np.arange(60)] = -np.inf
        best = np.argsort(-exact, axis=1)[:, :5]
        assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(near.ids, best)]) >= 0.9
        assert near.reranked < 0.5 * 60 * 4000


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 2**64, 200, dtype=np.uint64)
    fps[100:] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    planes = simhash.bit_planes(fps)
    asked = np.repeat(np.arange(200), planes.shape[1])
    blocks = np.tile(np.arange(planes.shape[1]), 200)
    hit, found = simhash.within(planes, fps[asked], blocks, radius)
    got = {(int(asked[h]), int(blocks[h]) * 64 + j) for h, w in zip(hit, found) for j in range(64) if int(w) >> j & 1 and int(blocks[h]) * 64 + j < 200}
    assert got == {(a, b) for a in range(200) for b in range(200) if (int(fps[a]) ^ int(fps[b])).bit_count() <= radius}


def test_links_across_tiles(spark):
    """A run far longer than a tile: components are those of all links."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**62))
    fps = {centre}
    while len(fps) < 600:
        near = centre
        for b in rng.integers(0, 64, 3):
            near ^= 1 << int(b)
        fps.add(near)
    fps |= {int(x) for x in rng.integers(0, 2**62, 50)}
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    scratch = Scratch(spark)
    from revbridge.llm.components import connected_components

    got = {r.vertex: r.component for r in connected_components(simhash.fingerprint_links(frame, 2, tile=40), scratch).collect()}
    want = brute.components(sorted(signed), [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    assert {f: got.get(f, f) for f in signed} == want


def test_components_of_a_long_chain(spark):
    from revbridge.llm.components import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.vertex: r.component for r in connected_components(edges, Scratch(spark)).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000}


@pytest.mark.parametrize("seed", range(40))
def test_induced_sorting(seed, monkeypatch):
    """Repeats found by the sorted suffixes: small alphabets, recursion, tiny queues that go to disk."""
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(suffix_array, "NAME_USES", int(rng.choice([1, 2, 256])))
    letters = int(rng.choice([1, 2, 3, 26]))
    raw = bytes(rng.integers(97, 97 + letters, int(rng.integers(0, 400))).astype(np.uint8))
    raw = raw + b"\xff" + raw[: len(raw) // 2] + b"\xff" + raw[len(raw) // 3 :]
    width = int(rng.choice([1, 2, 5, 20]))
    count = Counter(raw[i : i + width] for i in range(len(raw) - width + 1))
    want = [i + width <= len(raw) and count[raw[i : i + width]] > 1 for i in range(len(raw))]
    assert suffix_array.repeated_starts(raw, width, int(rng.choice([4, 64, 1 << 20]))).tolist() == want


def test_order_and_common_prefixes_of_all_suffixes():
    raw = b"mississippi_mississippi_ippi"
    symbols = np.zeros(len(raw) + 1, np.int16)
    symbols[:-1] = np.frombuffer(raw, np.uint8) + 1
    got = list(suffix_array.induce(suffix_array.Text(symbols), 64, np.frombuffer(raw, np.uint8)))
    pos = np.concatenate([p for p, _ in got]).tolist()
    lcp = np.concatenate([x for _, x in got]).tolist()
    assert pos == sorted(range(len(raw) + 1), key=lambda i: raw[i:], reverse=True)
    for k in range(1, len(pos) - 1):
        a, b = raw[pos[k - 1] :], raw[pos[k] :]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(x): int(rng.integers(1, 50)) for x in rng.choice(200, int(rng.integers(1, 11)), replace=False)}
    buckets = int(rng.integers(1, 6))
    bounds = packing.optimal_boundaries(histogram, buckets)
    assert len(bounds) <= buckets and bounds == sorted(bounds) and bounds[-1] == max(histogram)
    assert sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram.items()) == brute.boundaries(histogram, buckets)


def test_table_is_even_and_stable():
    names = sharding.shard_names(20)
    table = sharding.fill_table(names, 2003)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.2 * 2003


def test_quality_measures(documents):
    for _, t, _ in documents:
        assert quality_rules.measures(t) == brute.measures(t)


def plain_pipeline(docs):
    """docs: (doc_id, text, source) -> multiset of (doc_id, piece, n_tokens, bucket_len, batch, padding, text)."""
    judged = brute.quality(docs, quality_rules.Limits())
    docs = [(d, brute.without_lines(t, gone), s) for (d, t, s), (_, gone, _, _, kept) in zip(docs, judged) if kept]
    left = brute.line_dedup([(t, s) for _, t, s in docs], MIN_SITES)
    docs = [(d, x[2], s) for (d, _, s), x in zip(docs, left)]
    group = brute.simhash([(d, t) for d, t, _ in docs])
    docs = [r for r, (d, _, c) in zip(docs, group) if d == c]
    mixed = brute.mixing(docs)
    docs = [r for r, m in zip(docs, mixed) for _ in range(int(m[3]))]
    pieces = []
    for d, t, _ in docs:
        w = brute.words(t)
        n = max(1, math.ceil(len(w) / PACK_LEN))
        cuts = [m.start() for m in re.finditer(brute.SPACE, t or "")][PACK_LEN::PACK_LEN]  # where a piece's first word stands
        parts = [t] if n == 1 else [t[a:b] for a, b in zip([0, *cuts], [*cuts, None])]
        pieces += [(d, p, min(PACK_LEN, len(w) - p * PACK_LEN), parts[p], brute.digest(t)) for p in range(n)]
    bounds = packing.optimal_boundaries(Counter(p[2] for p in pieces), PACK_BUCKETS)
    bucket = [next(b for b in bounds if b >= p[2]) for p in pieces]
    out = Counter()
    for b in bounds:
        mine = sorted((i for i in range(len(pieces)) if bucket[i] == b), key=lambda i: (brute.hash60("pack", *pieces[i][:2], pieces[i][4]), pieces[i][:3]))
        for place, i in enumerate(mine):
            d, p, n, t, _ = pieces[i]
            out[d, p, n, b, place // max(1, PACK_BUDGET // max(1, b)), b - n, t] += 1
    return out


def test_pipeline(spark, documents):
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == plain_pipeline(documents)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
