"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from awkward import awkward, empty, words

from catalograph.llm import simhash


def brute_print(text, shingle):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[k : k + shingle]) for k in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def check(df, shingle=4, radius=4):
    rows = df.select("doc_id", "text").collect()
    prints = [brute_print(r.text, shingle) for r in rows]
    of = brute_components(set(prints), radius)
    smallest = {}
    for r, p in zip(rows, prints):
        ids = smallest.setdefault(of[p], [])
        if r.doc_id is not None:
            ids.append(r.doc_id)
    expected = sorted(((r.doc_id, f"{p:016x}", min(smallest[of[p]], default=None)) for r, p in zip(rows, prints)), key=repr)
    out = simhash.near_duplicates(df, shingle=shingle, radius=radius)
    for frame in (out, simhash.near_duplicates(df, shingle=shingle, radius=radius, carry=False)):
        got = frame.select("doc.doc_id", simhash.hex_digits(simhash.F.col("print")).alias("f"), "component_id").collect()
        assert sorted(((r.doc_id, r.f, r.component_id) for r in got), key=repr) == expected
    one = simhash.deduplicated(df, shingle=shingle, radius=radius)
    assert one.columns == df.columns
    assert sorted(repr(r.doc_id) for r in one.collect()) == sorted(repr(min(smallest[c], default=None)) for c in smallest)


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_awkward(spark):
    df = awkward(spark)
    check(df)
    assert simhash.near_duplicates(df).schema["doc"].dataType.names == df.columns


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == simhash.deduplicated(empty(spark)).count() == 0


@pytest.mark.parametrize("tree", [5, 2000])
def test_links_of_crowded_and_chained_prints(spark, monkeypatch, tree):
    """Shards above the size of a tree are dealt to several; no component is lost."""
    monkeypatch.setattr(simhash, "TREE", tree)
    rng = random.Random(3)
    prints = {0}
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(30)}
    at = rng.getrandbits(64)
    for _ in range(40):  # a chain: neighbours are near, ends far apart
        prints.add(at := at ^ sum(1 << b for b in rng.sample(range(64), 4)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    stars = simhash.components(simhash.links(spark.createDataFrame(signed, "print long"), 4)).collect()
    of = {r.a & (2**64 - 1): r.b & (2**64 - 1) for r in stars}
    groups, expected = {}, {}
    for p, root in brute_components(prints, 4).items():
        expected.setdefault(root, set()).add(p)
        groups.setdefault(of.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tree_follows_edges_within_the_radius():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 16, 300, dtype=np.uint64))
    found = {(int(root), int(prints[k])) for root, at in simhash.BkTree(prints).search(prints, 3) for k in at}
    assert found == {(int(a), int(b)) for a in prints for b in prints if (int(a) ^ int(b)).bit_count() <= 3}
    tree = simhash.BkTree(prints)
    assert all((int(tree.root) ^ int(child.root)).bit_count() == edge for edge, child in tree.children.items())
