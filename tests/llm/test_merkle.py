"""Merkle manifest: plain recomputation, depths, odd rows, tampering."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from saldo.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout):
    """All levels of a tree, from its leaves to its root."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        levels.append(nodes)
    return levels


def path_of(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        start = at // fanout * fanout
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])))
        at //= fanout
    return out


def plain(rows, fanout=16):
    """(doc_id, leaf, subroot, root, path) of every row, by hand."""
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = h(*[field(v) for v in (i, source, lang, n, text)])
        groups[source].append((i is not None, i or 0, leaf, i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([g[2] for g in sorted(groups[s])], fanout) for s in names}
    top = climb([trees[s][-1][0] for s in names], fanout) if names else [[None]]
    out = []
    for k, s in enumerate(names):
        for at, (_, _, leaf, i) in enumerate(sorted(groups[s])):
            path = path_of(trees[s], at, fanout) + path_of(top, k, fanout)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], tuple(path)))
    return out


def built(docs, fanout=16, every=2, **carry):
    leaf = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    return merkle.proofs(merkle.manifest(docs, leaf, carry=carry, fanout=fanout, every=every))


def found(docs, **how):
    rows = built(docs, **how).collect()
    return [(r.key, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in rows]


def ordered(rows):
    return sorted(rows, key=repr)


ODD = [
    (1, "Text", "en", "b", 4), (None, "x", None, "b", None), (None, None, None, None, None), (2, "", "en", "", 0),
    (3, "same", "en", "b", 4), (3, "same", "en", "b", 4), (3, "other", "en", "b", 5), (4, "É" * 90_000, "fr", "é", 90_000),
    (5, "a:b|-", "-", "Z", -1),
]


@pytest.mark.parametrize("fanout, every", [(16, 2), (2, 3), (3, 1)])
def test_odd_rows_equal_the_plain_trees(spark, fanout, every):
    docs = spark.createDataFrame(ODD, SCHEMA)
    for name in ("key", "grp", "digest", "own", "place", "tree", "depth", "path", "nodes"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert ordered(found(docs, fanout=fanout, every=every)) == ordered(plain(ODD, fanout))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 600])
def test_every_depth_equals_the_plain_tree(spark, n):
    rows = [(k * 7, f"text {k}", "en", "one", k) for k in range(n)] + [(1, "y", "en", f"s{k}", 1) for k in range(20)]
    assert ordered(found(spark.createDataFrame(rows, SCHEMA).repartition(5))) == ordered(plain(rows))


def test_deep_trees_with_few_children(spark):
    rows = [(k, str(k), None, "hot" if k % 3 else f"s{k}", k) for k in range(150)]
    want = ordered(plain(rows, 2))
    for every in (1, 2, 3):
        assert ordered(found(spark.createDataFrame(rows, SCHEMA), fanout=2, every=every)) == want


def test_only_every_second_level_is_stored(spark):
    rows = [(k, str(k), None, "one", k) for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = merkle.manifest(docs, merkle.leaf_digest(F.col("doc_id")))
    assert kept.groups.levels == (0, 2)
    leaves, upper = (kept.groups.read(level) for level in (0, 2))
    assert (leaves.count(), upper.count()) == (3, 1)
    assert max(r.n for r in leaves.select(F.size("nodes").alias("n")).collect()) <= 256


def test_folding_finds_what_was_changed(spark):
    rows = [(k, f"Text {k}", "en", f"s{k % 3}", k) for k in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = F.when(F.col("doc_id") % 10 == 0, merkle.leaf_digest(F.lit("changed"), F.col("doc_id")))
    got = built(docs, other=other).withColumn("back", merkle.fold(F.coalesce("carried.other", "leaf"), F.col("path")))
    assert all((r.back == r.root) == (r.key % 10 != 0) for r in got.collect())
    for r in got.withColumn("all", merkle.siblings_text(F.col("path"))).collect():
        assert r["all"] == "".join(s.left + s.right for s in r.path)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    kept = merkle.manifest(docs, merkle.leaf_digest(F.col("doc_id")))
    assert kept.root is None and merkle.proofs(kept).count() == 0
