"""Plain versions of the corpus operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(SPACE, text or "")


def fingerprint(text, shingle=3):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash(rows, shingle=3, radius=2):
    """rows: (doc_id, text) -> [(doc_id, fingerprint, component_id)]."""
    prints = [(d, fingerprint(t, shingle)) for d, t in rows]
    distinct = sorted({f for _, f in prints})
    group = components(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= radius])
    least = defaultdict(lambda: None)
    for d, f in prints:
        g = group[f]
        if d is not None and (least[g] is None or d < least[g]):
            least[g] = d
    return [(d, f, least[group[f]]) for d, f in prints]


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def repeats(rows, width=200):
    """rows: (doc_id, text) -> [(doc_id, n_bytes, n_removed, n_spans, sha256)]."""
    data = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + width] for _, b in data for i in range(len(b) - width + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", lower(line)).strip(" ")


def measures(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        dup += bool(words(x)) and x in seen
        seen.add(x)
    wins = defaultdict(list)
    for i in range(len(w) - 4):
        wins[tuple(w[i : i + 5])].append(i)
    covered = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def quality(rows, limits):
    """rows: (doc_id, text, host) -> per row (measures, removed places, base_failed, kept)."""
    docs, texts, spread = defaultdict(set), defaultdict(set), defaultdict(set)
    of_host, texts_of_host = defaultdict(set), defaultdict(set)
    rows_with = Counter()
    split = lambda t: [normal(x) for x in t.split("\n")] if t is not None else []
    for d, text, host in rows:
        of_host[host].add((d, text))
        texts_of_host[host].add(text)
        n = split(text)
        for i, x in enumerate(n):
            if x:
                rows_with[host, x] += 1
                docs[host, x].add((d, text))
                texts[host, x].add(text)
                spread[host, x].add((n[i - 1] if i else None, n[i + 1] if i + 1 < len(n) else None))
    least = limits.min_documents
    counted = {k for k in texts if rows_with[k] > least and len(texts[k]) > least and len(texts[k]) > len(texts_of_host[k[0]]) * limits.max_share}
    rests = defaultdict(set)
    for host, every in texts_of_host.items():
        for text in every:
            n = [x for x in split(text) if x]
            gone = [x for x in n if (host, x) in counted]
            left, total = sum(len(words(x)) for x in gone), sum(len(words(x)) for x in n)
            if left <= total * limits.max_removed and total - left >= limits.min_left:
                for x in set(gone):
                    rests[host, x].add(tuple(sorted(y for y in n if (host, y) not in counted)))
    above = {k for k in counted if max(len(spread[k]), len(rests[k])) >= len(texts[k]) * limits.min_spread}
    above |= {k for k in docs if rows_with[k] > least and len(docs[k]) > least and len(docs[k]) > len(of_host[k[0]]) * limits.site_share}
    out = []
    for _, text, host in rows:
        m = measures(text)
        n = [normal(x) for x in text.split("\n")] if text is not None else []
        gone = [i for i, x in enumerate(n) if (host, x) in above]
        lost = sum(len(words(n[i])) for i in gone)
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        kept = not failed and lost <= m[0] * limits.max_removed and m[0] - lost >= limits.min_left
        out.append((m, gone, lost, failed, kept))
    return out


def without_lines(text, gone):
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in set(gone)) if gone else text


def line_dedup(rows, min_sites):
    """rows: (text, site) -> [(n_lines, n_removed, text left)]."""
    sites = defaultdict(set)
    for text, site in rows:
        for x in (text or "").split("\n"):
            if normal(x) and site is not None:
                sites[normal(x)].add(site)
    out = []
    for text, _ in rows:
        if text is None:
            out.append((0, 0, None))
            continue
        lines = text.split("\n")
        gone = [i for i, x in enumerate(lines) if normal(x) and len(sites[normal(x)]) >= min_sites]
        out.append((len(lines), len(gone), without_lines(text, gone)))
    return out


def hash60(*parts):
    return int(hashlib.md5(":".join("~" if p is None else str(p) for p in parts).encode()).hexdigest()[:15], 16)


def digest(text):
    return None if text is None else hashlib.md5(text.encode()).hexdigest()


def mixing(rows, cycle=(1, 2, 3), epochs=3, seed="mix"):
    """rows: (doc_id, text, source) -> [(size, source_size, target, reps)]."""
    size = [len(words(t)) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = sum(size) - sum(epochs * total[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and float(left) * weight[s] / float(w) > epochs * total[s]}
        if not more:
            break
        full |= more
    target = {s: float(epochs * total[s]) if s in full else float(left) * weight[s] / float(w) for s in order}
    reps = [0] * len(rows)
    for s in order:
        mine = [i for i, r in enumerate(rows) if r[2] == s]
        mine.sort(key=lambda i: (hash60(seed, rows[i][0], size[i], digest(rows[i][1])), rows[i][0] is not None, rows[i][0] or 0, size[i]))
        whole = math.floor(target[s] / total[s]) if total[s] else 0
        need, before = target[s] - whole * total[s], 0
        for i in mine:
            reps[i] = whole + (need > 0 and 2 * before + size[i] <= 2 * need)
            before += size[i]
    return [(size[i], total[r[2]], target[r[2]], reps[i]) for i, r in enumerate(rows)]


def boundaries(histogram, buckets):
    """The least padding of at most `buckets` buckets, by trying every choice of boundaries."""
    lengths = sorted(histogram)
    best = math.inf
    for k in range(1, min(buckets, len(lengths)) + 1):
        for cut in combinations(lengths[:-1], k - 1):
            bounds = [*cut, lengths[-1]]
            best = min(best, sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram.items()))
    return best


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    return dot / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))


def nearest(rows, k, is_query):
    """rows: (vec_id, vector) -> [(query_id, rank, vec_id, score)]."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in good:
        if is_query(q):
            found = sorted((-cosine(v, c), i) for i, c in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out
