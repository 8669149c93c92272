"""Boilerplate that always has the same neighbour lines, and near copies that must not look like it."""

from revbridge.llm import quality_rules

from . import brute


def own(i):
    return " ".join(f"v{(i * 53 + k * 29) % 1009}x{i}" for k in range(10))


MENU = "Home\nAbout us\nContact\nPrivacy"
FOOTER = "All rights reserved\nImprint and terms"
PAGES = {
    "blank": lambda i: (f"{own(i)}\n\nCookie notice\n\n{own(i + 500)}", f"{own(i)}\n\n\n{own(i + 500)}"),
    "menu": lambda i: (f"{MENU}\n{own(i)}\n{own(i + 500)}", f"{own(i)}\n{own(i + 500)}"),
    "footer": lambda i: (f"{own(i)}\n{own(i + 500)}\n{FOOTER}", f"{own(i)}\n{own(i + 500)}"),
}


def test_quality_removes_lines_with_the_same_neighbours(spark):
    pages = [(1000 * k + i, *page(i), host) for k, (host, page) in enumerate(PAGES.items()) for i in range(30)]
    thin = [(9000 + i, f"{MENU}\nHome\nAbout us\nContact\nPrivacy\nown{i} page{i}", "menu") for i in range(3)]
    frame = spark.createDataFrame([(d, t, h) for d, t, _, h in pages] + thin, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in quality_rules.filter_documents(frame).collect()}
    assert got == {d: left for d, _, left, _ in pages}
    removed = {r.doc_id: (r.n_removed_words, r.depleted) for r in quality_rules.judge(frame).collect()}
    assert {removed[1000 * k] for k in range(3)} == {(2, False), (5, False), (6, False)} and removed[9000] == (10, True)


def test_quality_keeps_near_copies(spark):
    lines = [own(i) for i in range(900, 910)]
    rows = [(i, "\n".join(lines[: i % 10] + [own(i)] + lines[i % 10 + 1 :])) for i in range(60)]  # one line of ten rewritten
    rows += [(100 + i, "\n".join([own(800), "", own(801), "", own(802), "", own(803), "", f"version {i}"])) for i in range(60)]
    rows += [(200 + i, text) for i, (_, text) in enumerate(rows[:40])]  # and copied as it is
    frame = spark.createDataFrame([(*r, "h") for r in rows], "doc_id long, text string, source string")
    got = {r.doc_id: r.n_removed_words for r in quality_rules.judge(frame).filter("kept").collect()}
    assert got == {d: 0 for d, _ in rows}


def boilerplate(host, n):
    """Identical consent walls, pages of 84 per cent boilerplate, a menu, a footer and own pages on one host."""
    wall = "We value your privacy and ask for your consent now\nAccept all cookies or manage your many choices here"
    lines = [own(700 + k) for k in range(6)] + ["and four words more"]
    if host == "walls":
        return [(i, wall, host) for i in range(n)]
    if host == "thin":
        return [(1000 + i, "\n".join([*lines, " ".join(f"own{i}x{k}" for k in range(12))]), host) for i in range(n)]
    return [(2000 + i, f"{MENU}\n{own(i)}\n{own(i + 400)}\n{FOOTER}", host) for i in range(n)]


def test_boilerplate_of_a_whole_site_goes_with_its_documents(spark):
    rows = [r for host in ("walls", "thin", "pages") for r in boilerplate(host, 50)]
    rows += [(3000 + i, f"{own(i + 90)}\n{own(i + 91)}", "walls") for i in range(20)]  # walls are 50 of 70 documents
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_removed_words, r.kept) for r in quality_rules.judge(frame).collect()}
    assert all(not kept for d, (_, kept) in got.items() if d < 2000)  # all walls, all thin pages
    assert all(kept for d, (_, kept) in got.items() if d >= 2000)
    want = brute.quality(rows, quality_rules.Limits())
    assert got == {r[0]: (w[2], w[4]) for r, w in zip(rows, want)}


def test_brute_force_knows_rests_copies_and_shares(spark):
    rows = [r for host in ("walls", "thin", "pages") for r in boilerplate(host, 12)]
    rows += [(100 * k + i + 5000, page(i)[0], host) for k, (host, page) in enumerate(PAGES.items()) for i in range(20)]
    rows += [(7000 + i, rows[0][1] if i % 3 else f"{own(5)}\n{own(6)}", "mixed") for i in range(60)]
    rows += [(7100 + i, f"{own(5)}\n{own(6)}\n{own(i + 20)}", "mixed") for i in range(40)] + [(None, None, None), (None, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.n_removed_words, r.kept) for r in quality_rules.judge(frame).collect()), key=repr)
    want = sorted(((r[0], w[2], w[4]) for r, w in zip(rows, brute.quality(rows, quality_rules.Limits()))), key=repr)
    assert got == want
