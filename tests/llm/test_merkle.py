"""The manifest against a plain recursive tree, and odd inputs."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from revbridge.llm import merkle
from revbridge.llm.common import ascii_lower

from .brute import lower

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """[[siblings before and after of a node, a level each], ...] and the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for k, i in enumerate(at):
            run = runs[i // 8]
            paths[k].append((run[: i % 8], run[i % 8 + 1 :]))
            at[k] = i // 8
        nodes = [sha("".join(run)) for run in runs]
    return paths, nodes[0]


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        done[g] = tree([leaf(*r) for r in groups[g]])
    upper, root = tree([done[g][1] for g in names])
    out = []
    for g, above in zip(names, upper):
        for r, path in zip(groups[g], done[g][0]):
            path = path + above
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            acc = leaf(r[0], lower(r[1]), *r[2:]) if bad else leaf(*r)
            for before, after in path:
                acc = sha("".join(before) + acc + "".join(after))
            proof = sha("".join(d for before, after in path for d in before + after))
            out.append((r[0], leaf(*r), done[g][1], root, proof, acc, acc == root))
    return sorted(out, key=repr)


def result(df):
    tampered = {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))}
    out = merkle.manifest(df, tampered=tampered)
    folded = merkle.fold(F.col("other_leaf"), F.col("path"))
    out = out.select("key", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256), folded, folded == F.col("root"))
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 530])
def test_sizes(spark, n):
    rows = [(i * 37 % 1009, f"Text {i}", "en", "s", i) for i in range(n)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)


def test_odd_rows(spark):
    rows = [(i % 40, None if i % 7 == 0 else f"É ß {i % 9} X" * (i % 5), [None, "de", "en", "", "ü"][i % 5 % 4 if i > 150 else 2], None if i % 3 else "a", None if i % 4 else i) for i in range(200)]
    rows += [(None, None, None, None, None), (None, "A", None, None, 1), (None, "A", None, None, 1), (3, "A" * 300000, "zz", "s", -5), (-4, "b", "zz", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    names = "g key digest pos n run slot before after path root leaf _salt _at _part _row other_leaf".split()
    want = expected(rows)
    assert result(df) == want
    assert result(df.withColumns({n: F.lit("x") for n in names})) == want


def test_equal_rows_and_many_groups(spark):
    rows = [(7, "same", "en", "s", 1)] * 100 + [(1, "t", f"l{i:03d}", "s", 1) for i in range(90)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(6)) == expected(rows)


def test_empty(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_changed_rows_are_found_out(spark):
    rows = [(i, "Some Text", "en", "s", 1) for i in range(100)]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert {r[0] for r in got if not r[-1]} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 0}
