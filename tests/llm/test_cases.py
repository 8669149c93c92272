"""Defined results for odd inputs, for every operator and pipeline stage: nulls in any column, empty
and very long texts, ties, repeated rows, empty tables, and extra columns with clashing names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revbridge.llm import ann, license_scan, line_dedup, mixing, packing, quality_rules, sharding, simhash, suffix_dedup, url_filter
from revbridge.llm.common import Scratch, global_index, prefix_sums, uniform60

from . import brute

LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60000))
PROSE = "\n".join(" ".join(f"p{(i * 31 + k * 17) % 977}" for k in range(14)) for i in range(8))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, PROSE, "en", "a", 1), (2, PROSE, "en", "b", 1), (2, PROSE, "en", "b", 1), (3, None, None, None, None),
    (None, PROSE + " x", None, "a", None), (None, None, "en", None, 5), (4, "", "en", "a", 0), (5, " \t\n\x0b ", "en", "c", 5),
    (6, LONG, "en", "a", 9), (7, "The MIT License the mit licence", None, None, 3), (8, "one two three four five six seven eight nine ten", "en", "b", 4),
    (9, "one two three four five six seven eight nine ten", "en", None, 4), (-10, "É é ß\u00a0ü " * 12, "de", "ü", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(docs):
    """Extra columns named like the ones that operators add or use inside."""
    names = "k1 k2 fp a b n u size target taken reps batch piece n_tokens host rule verdict slot shard h at line removed vertex component _k1 _id site gone data row key u whole need before place places found possible listed n_lines n_removed _part _offset _block".split()
    return docs.withColumns({n: F.lit("x") for n in names})


def bag(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def pairs():
    return [(r[0], r[1]) for r in ROWS]


@pytest.fixture(params=["docs", "clashing"])
def either(request):
    return request.getfixturevalue(request.param)


def test_sharding(either):
    out = sharding.assign(either, [F.col("doc_id")], sharding.shard_names(4))
    assert all(r[c] == "x" for r in out.collect() for c in either.columns[5:] if c not in ("slot", "shard"))
    got = bag(out, "doc_id", "shard")
    assert sum(got.values()) == len(ROWS)
    assert len({s for (d, s) in got if d == 2}) == 1 and len({s for (d, s) in got if d is None}) == 1
    table = sharding.fill_table(sharding.shard_names(4), sharding.prime_from(400))
    assert all(s == f"shard-{table[brute.hash60(d) % 401]:05d}" for d, s in got)


def test_sharding_splits_a_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"), "id")
    plain = Counter(r.shard for r in sharding.assign(rows, [F.col("key")], sharding.shard_names(10)).collect())
    split = Counter(r.shard for r in sharding.assign(rows, [F.col("key")], sharding.shard_names(10), spread_by=[F.col("id")]).collect())
    assert max(plain.values()) > 1000 and max(split.values()) < 400 and sum(split.values()) == 3000


def test_simhash(spark, either):
    got = bag(simhash.near_duplicates(either, Scratch(spark)).withColumn("hex", simhash.hex_fingerprint(F.col("fp"))), "doc_id", "hex", "component_id")
    assert got == Counter((d, f"{f:016x}", c) for d, f, c in brute.simhash(pairs()))


def test_simhash_keeps_one_of_each_group(either):
    kept = bag(simhash.drop_near_duplicates(either).select("doc_id", "text"), "doc_id", "text")
    groups = {}
    for (d, t), (_, f, c) in zip(pairs(), brute.simhash(pairs())):
        groups.setdefault(f, set()).add((d, t))
    assert len(kept) == sum(kept.values())
    for members in groups.values():
        ids = [d for d, _ in members if d is not None]
        assert sum(m in kept for m in members) <= 1 or len({brute.fingerprint(t) for _, t in members}) > 1
        if ids and len(groups) == len({c for _, _, c in brute.simhash(pairs())}):
            assert any(d == min(ids) for d, t in kept if (d, t) in members)
    assert sum(kept.values()) == len(set(brute.components(list(groups), [(a, b) for a in groups for b in groups if (a ^ b).bit_count() <= 2]).values()))


def test_line_dedup(either):
    got = bag(line_dedup.remove_boilerplate(either, 2), "doc_id", "n_lines", "n_removed", "text")
    want = brute.line_dedup([(r[1], r[3]) for r in ROWS], 2)
    assert got == Counter((r[0], *w) for r, w in zip(ROWS, want))


@pytest.mark.parametrize("sites,least", [(5, 4), (5, 5), (5, 6), (60, 55), (60, 61), (300, 250)])
def test_line_dedup_near_the_threshold(spark, sites, least):
    rows = [(i, f"Common  LINE\nown line {i}", f"s{i % sites}") for i in range(2 * sites)] + [(-1, "common line", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = bag(line_dedup.remove_boilerplate(frame, least), "doc_id", "text")
    want = brute.line_dedup([r[1:] for r in rows], least)
    assert got == Counter((r[0], w[2]) for r, w in zip(rows, want))


def test_license_scan(either):
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert bag(license_scan.scan_licenses(either), *cols) == Counter((d, *brute.license_base(t)) for d, t in pairs())


def test_license_scan_of_a_text_full_of_licenses():
    text = "MIT license, apache license; " * 20000
    n, base, found = license_scan.scan(text)
    assert (n, len(base), base[0], base[-1]) == (80000, 40000, (0, "mit"), (79998, "apache"))
    assert len(found) == 40000 and {d.label for d in found} == {"mit", "apache"}


def test_quality(either):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = brute.quality([(r[0], r[1], r[3]) for r in ROWS], quality_rules.Limits())
    assert bag(quality_rules.judge(either), *cols) == Counter((r[0], *w[0], w[3], w[4]) for r, w in zip(ROWS, want))


def test_quality_removes_frequent_lines_but_not_copies(spark):
    own = lambda i: " ".join(f"v{(i * 53 + k * 29) % 1009}" for k in range(20))
    rows = [(i, f"{own(i)}\nhome about contact\n{own(i + 500)}", "h") for i in range(30)]
    rows += [(100 + i, PROSE + f"\nlast {i % 3}", "h") for i in range(40)]  # copies in three versions
    rows += [(200 + i, "home about contact\n" + "home about contact " * 0 + f"x{i} y{i}", "h") for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = quality_rules.Limits(min_documents=8, max_share=0.1)
    judged = brute.quality([(r[0], r[1], r[2]) for r in rows], limits)
    assert bag(quality_rules.judge(frame, limits=limits), "doc_id", "kept", "n_removed_words") == Counter((r[0], w[4], w[2]) for r, w in zip(rows, judged))
    kept = bag(quality_rules.filter_documents(frame, limits=limits), "doc_id", "text")
    assert kept == Counter((r[0], brute.without_lines(r[1], w[1])) for r, w in zip(rows, judged) if w[4])
    assert all((r[0], r[1]) in kept for r in rows if 100 <= r[0] < 200) and not any("home" in t for _, t in kept)


URLS = [
    (1, "HTTP://A.B.Example.ORG/es/1?x"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2"), (4, "x://com/fr/"), (5, "x://a.com/de/7#z"),
    (6, "x://acom/de/7"), (7, None), (8, "no scheme"), (9, ""), (10, "http://bad.net/p/1.html?utm=3"), (11, "https://www.bad.net/p/1/"), (12, "https://www.bad.net/p/1/"),
    (None, "https://m.bad.net:80/p/1#top"), (13, "http://notorg/"), (14, "http://org"), (15, "a://b://c.org/x"), (16, "http://bad.net/p/12"), (17, "://"), (18, "x://a.org?x/es/"),
]
RULES = [url_filter.Rule(*r) for r in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))]


def test_url_filter(spark):
    pages = spark.createDataFrame([(*u, "x", "y", "z") for u in URLS], "page_id long, url string, host string, verdict string, _block string")
    listed = spark.createDataFrame([("bad.net/p/1",), ("bad.net/p/1",), (None,), ("example.org/en/2",)], "canonical_url string")
    got = {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed, RULES).collect()}
    assert len(got) == len(URLS)
    assert {r._block for r in url_filter.judge(pages, listed, RULES).collect()} == {"z"}
    for (page, url), (host, path, rule, verdict) in got.items():
        rest = (url or "").split("://", 1)
        rest = rest[1] if len(rest) == 2 else ""
        cut = min([i for i, ch in enumerate(rest) if ch in "/?#"], default=len(rest))
        end = min([i for i, ch in enumerate(rest) if ch in "?#" and i >= cut], default=len(rest))
        assert (host, path) == (rest[:cut].lower(), rest[cut:end])
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert rule == (best.name if best else None)
        assert verdict == (best.verdict if best else "block" if page in (10, 11, 12, None) else "allow"), url


def test_bloom_has_no_false_negatives_and_few_hits(spark):
    urls = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("u"))
    bloom, blocks = url_filter.build_filter(urls, "u", 3000)
    assert url_filter.possible_hits(urls, "u", bloom, blocks, "hit").filter("hit").count() == 3000
    others = spark.range(3000, 13000).select(F.concat(F.lit("h/"), "id").alias("u"))
    assert url_filter.possible_hits(others, "u", bloom, blocks, "hit").filter("hit").count() < 300


def test_suffix_dedup(either):
    got = bag(suffix_dedup.remove_repeats(either), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(brute.repeats(pairs()))


def test_suffix_dedup_of_runs_periods_edits_and_long_texts(spark, monkeypatch):
    import random

    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    rows = [(0, "z" * 450), (1, "ab" * 180), (2, passage), (3, passage[100:420] + "!" + passage[421:]), (4, "q" + passage[300:499] + "q"), (5, "q" + passage[300:500] + "q")]
    rows += [(10 + i, passage[:200 + i] + "#" + passage[210 + i :]) for i in range(40)]  # many near copies of one anchor
    rows += [(60, "é" * 120), (61, "xé" + "é" * 99), (62, "".join(rnd.choice("abcdefgh ") for _ in range(3000)) + passage), (63, passage[:199])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1000)  # many shards, split anchors
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 2000)  # long texts in pieces
    got = bag(suffix_dedup.remove_repeats(frame, keep_text=True), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(brute.repeats(rows))


def test_mixing(either):
    got = Counter((r.doc_id, r["size"], r.source_size, r.target, r.reps) for r in mixing.mix_sources(either).collect())
    want = brute.mixing([(r[0], r[1], r[3]) for r in ROWS])
    assert got == Counter((r[0], *w) for r, w in zip(ROWS, want))


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 400), f"s{min(i % 9, 4)}") for i in range(900)] + [(9000, "w " * 50, "tiny")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(frame).collect()
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 200 for s in target) and target["tiny"] == 3 * size["tiny"]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    again = mixing.mix_sources(frame.repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)


def test_one_doc_id_is_spread(spark, monkeypatch):
    """2,000 rows of one length and no doc_id: no part of the running sums holds many of them."""
    rows = [(None, f"w{i} x y", "s") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    parts = []

    def watched(df, group, u, *rest):
        parts.append(df.groupBy(group, F.shiftrightunsigned(u, 54)).count().agg(F.max("count")).first()[0])
        return prefix_sums(df, group, u, *rest)

    for module in (mixing, packing):
        monkeypatch.setattr(module, "prefix_sums", watched)
    got = Counter((r["size"], r.source_size, r.target, r.reps) for r in mixing.mix_sources(frame, (1, 2)).collect())
    assert got == Counter(brute.mixing(rows, (1, 2)))
    places = Counter((r.bucket_len, r.batch) for r in packing.pack(frame, 100, 3, 30).collect())
    assert places == {(3, b): 10 for b in range(200)}
    assert max(parts) < 2000 / 64 * 3  # 64 parts of about 31 rows


def test_pieces_are_the_text_again(spark):
    texts = ["  lead\n\n\tcode {\n    x = 1;\r\n}\n" * 40 + "end  ", "short  text", " \n ", "", "a b c d e f g h", "É\u00a0ü  " * 30]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.piece_text(packing.pieces(docs, 7).select("row.*", "piece", "n_pieces", "n_tokens"), 7).collect()
    for i, t in enumerate(texts):
        mine = sorted((r.piece, r.text, r.n_tokens) for r in rows if r.doc_id == i)
        assert "".join(x for _, x, _ in mine) == t and all(len(brute.words(x)) == n for _, x, n in mine)


def test_packing(either):
    out = packing.pack(either, max_len=1000, n_buckets=3, budget=4000).collect()
    assert all(r[c] == "x" for r in out for c in either.columns[5:] if c not in packing.ADDED)
    lengths = Counter()
    for r in ROWS:
        n = len(brute.words(r[1]))
        for p in range(max(1, -(-n // 1000))):
            lengths[r[0], p, min(1000, n - 1000 * p)] += 1
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in out) == lengths
    batches = Counter((r.bucket_len, r.batch) for r in out)
    assert all(n * max(1, b) <= 4000 or n == 1 for (b, _), n in batches.items())
    assert sum(r.padding for r in out) == brute.boundaries(Counter(r.n_tokens for r in out), 3)
    for b in {b for b, _ in batches}:
        full = max(1, 4000 // max(1, b))
        sizes = [batches[b, i] for i in range(max(i for x, i in batches if x == b) + 1)]
        assert all(n == full for n in sizes[:-1])


VECTORS = [(i, [float((i * 7 + k * 13) % 11 - 5) for k in range(6)]) for i in range(1, 40)]
VECTORS += [(50, None), (100, [0.0] * 6), (150, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (200, [float("nan")] * 6), (250, [float("inf")] + [1.0] * 5), (300, []), (350, [1.0] * 6), (400, [2.0] * 6), (401, [2.0] * 6), (None, [1.0] * 6)]


def test_nearest_of_every_length_and_magnitude(spark):
    import random

    rng = random.Random(5)
    lengths = {i: rng.choice([3, 3, 5]) for i in range(120)}
    size = {i: 10.0 ** rng.choice([0, 200, -200, 306, -306]) for i in lengths}
    rows = [(i, [rng.gauss(0, 1) * size[i] for _ in range(n)]) for i, n in lengths.items()]
    rows += [(150, [1e200] * 3), (151, [1e-200, 2e-200, 0.0]), (200, [2.0] * 9), (None, [1.0, 2.0, 3.0])]
    got = sorted(tuple(r) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 5, block=2).collect())
    want = []
    for n in (3, 5, 9):
        same = [(d, [float(x) for x in v]) for d, v in rows if d is not None and len(v) == n]
        top = {d: max(map(abs, v)) for d, v in same}
        want += brute.nearest([(d, [x / top[d] for x in v]) for d, v in same], 5, lambda i: i % 50 == 0)
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)] and len(got) >= 15
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, sorted(want)))


def test_nearest(spark):
    frame = spark.createDataFrame([(*v, 1, "x", 2.0) for v in VECTORS], "vec_id long, embedding array<double>, rank int, vector string, score double").repartition(4)
    got = sorted(tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, 5, block=1).collect())
    want = sorted(brute.nearest([v for v in VECTORS if v[0] is not None and v[1] != []], 5, lambda i: i % 50 == 0))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))
    few = frame.filter("vec_id in (350, 400, 50)")
    assert sorted(r[:3] for r in ann.nearest(few, F.col("vec_id") % 50 == 0, 5).collect()) == [(350, 1, 400), (400, 1, 350)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canonical_url string")
    frames = [
        sharding.assign(docs, [F.col("doc_id")], ["a"]), simhash.near_duplicates(docs, Scratch(spark)), simhash.drop_near_duplicates(docs),
        line_dedup.remove_boilerplate(docs), license_scan.scan_licenses(docs), quality_rules.judge(docs), quality_rules.filter_documents(docs),
        url_filter.judge(pages, listed, RULES), suffix_dedup.remove_repeats(docs), mixing.mix_sources(docs), packing.pack(docs), ann.nearest(vectors, F.col("vec_id") % 50 == 0),
    ]
    assert all(f.count() == 0 for f in frames)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, either, name, stage):
    out = stage(spark, either, "/none")
    if name != "packing":
        assert out.columns == either.columns
    got = out.collect()
    if name != "packing":
        assert all(r[c] == "x" for r in got for c in either.columns[5:])
    empty = stage(spark, either.limit(0), "/none")
    assert empty.columns == out.columns and empty.count() == 0


def test_running_sums_and_places(spark):
    rows = [(f"g{i % 3}", i * 5 % 7, i) for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, w long, i long").withColumn("u", uniform60(F.col("i")))
    got = {r.i: r.before for r in prefix_sums(frame, "g", "u", "w", "before", [F.col("i")], bits=3).collect()}
    for g in ("g0", "g1", "g2"):
        total = 0
        for _, w, i in sorted((r for r in rows if r[0] == g), key=lambda r: brute.hash60(r[2])):
            assert got[i] == total
            total += w
    names = spark.createDataFrame([("b",), ("ü",), (None,), ("a",), ("Z",)], "s string")
    assert {r.s: r.n for r in global_index(names, "s", "n", Scratch(spark)).collect()} == {"Z": 0, "a": 1, "b": 2, "ü": 3, None: 4}
