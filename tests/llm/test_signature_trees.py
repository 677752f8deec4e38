from __future__ import annotations

import random
import re

import numpy as np
import pytest

from roostline.llm.components import connected_components
from roostline.llm.signature_trees import (
    least_overlap,
    needed_shared,
    op8_ngram_jaccard_join,
    paired_blocks,
    prefix_size,
    similar,
    similar_groups,
    tree_links,
)


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for n, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(n)
    union = Union()
    seen = set()
    for members in holders.values():
        for k, a in enumerate(members):
            for b in members[:k]:
                if (a, b) not in seen and union.find(a) != union.find(b):
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                        union.join(a, b)
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        root = union.find(n)
        ids = [i for i in (least.get(root), doc_id) if i is not None]
        least[root] = min(ids) if ids else None
    return sorted(
        ((d, len(sets[n]), least[union.find(n)] if sets[n] else d) for n, (d, _) in enumerate(rows)), key=str
    )


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def corpus(seed, n=60):
    """Families of edited copies around the threshold, texts that share a passage, and edges."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    passage = [word() for _ in range(40)]
    rows = []
    for family in range(n):
        base = [word() for _ in range(rng.choice([3, 5, 6, 12, 40, 150]))]
        if family % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.2:
                text += [word() for _ in range(len(text) // 5)]
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(text)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (None, rows[0][1]), (None, "only here " * 3), (5, rows[5][1])]
    rows += [(9003, "Three Short WORDS"), (9004, "three short words"), (9005, "É x y z w q"), (9006, "é x y z w q")]
    rows += [(9007, "a b " * 30_000), (9008, "a b " * 20_000)]
    return rows


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 5)])
def test_components_equal_a_plain_join(documents, seed, block):
    rows = corpus(seed)
    assert found(similar_groups(documents(rows), block)) == plain(rows)


def test_pairs_of_blocks_that_cannot_link_go_before_sets_move(spark):
    rng = np.random.default_rng(11)
    sets = []
    for family in range(12):
        base = rng.integers(0, 2**63, 20 + 15 * family, np.uint64)
        for _ in range(8):
            edited = base.copy()
            some = rng.integers(0, len(base), rng.integers(0, 4))
            edited[some] = rng.integers(0, 2**63, len(some), np.uint64)
            sets.append(np.unique(edited))
    rows = [(k, len(x), [int(v) for v in x.view(np.int64)]) for k, x in enumerate(sets)]
    frame = spark.createDataFrame(rows, "class bigint, n bigint, tokens array<bigint>")
    members = frame.selectExpr("class", "cast(7 as bigint) as group")
    units = [tuple(r) for r in paired_blocks(frame, members, 8).select("class", "side", "first", "second").collect()]
    side = {c: s for c, s, _, _ in units}
    pairs = {(a, b) for _, _, a, b in units}
    assert set(side) == set(range(len(sets)))
    assert all(side[c] in (a, b) for c, _, a, b in units) and len(units) == len(set(units))
    for i in range(len(sets)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                assert tuple(sorted((side[i], side[j]))) in pairs
    every = len(set(side.values()))
    assert len(pairs) < every * (every + 1) // 4


def test_empty_table(documents):
    assert similar_groups(documents([(1, "x")]).filter("doc_id = 2")).collect() == []


def test_tree_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(7)
    for trial in range(30):
        sets = []
        for _ in range(rng.integers(1, 12)):
            base = rng.integers(0, 2**63, rng.integers(1, 80), dtype=np.uint64)
            for _ in range(rng.integers(1, 14)):
                kept = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.12])]
                sets.append(np.unique(kept if len(kept) else base))
        half = len(sets) // 2

        def components(links):
            union = Union()
            for a, b in links:
                union.join(a, b)
            return [union.find(k) for k in range(len(sets))]

        def linked(a, b):
            common = len(np.intersect1d(sets[a], sets[b]))
            return 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common)

        every = [(a, b) for a in range(len(sets)) for b in range(a) if linked(a, b)]
        assert components(tree_links(sets)) == components(every), trial
        across = [(b, a) for a, b in every if b < half <= a]
        if half:
            got = [(a, half + b) for a, b in tree_links(sets[:half], sets[half:])]
            assert set(got) <= set(across)
            assert components(got) == components(across), trial


def test_bounds_of_prefixes_hold():
    """Two linked sets share the needed number of shingles within their prefixes."""
    rng = np.random.default_rng(11)
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        common = int(rng.integers(least_overlap(n), n + 1))
        most = 5 * common // 4 - (n - common) - common
        if most < 0:
            continue
        m = common + int(rng.integers(0, most + 1))
        assert 5 * common >= 4 * (n + m - common)
        order = rng.permutation(n + m - common)
        a = np.sort(order[:n])
        b = np.sort(np.concatenate([order[:common], order[n:]]))
        both = np.intersect1d(a[: prefix_size(n)], b[: prefix_size(m)])
        assert len(both) >= max(needed_shared(n), needed_shared(m))


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5200)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r["node"], r["root"]) for r in got.collect()) == sorted((x, union.find(x)) for x in nodes)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op8_ngram_jaccard_join(spark, sf)) == plain(rows)


@pytest.mark.parametrize("seed, block", [(3, 512), (4, 5)])
def test_links_are_all_counted(documents, seed, block):
    """Also those of rows that other links connect already: five near copies have four each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = corpus(seed, 30) + [(9500 + k, " ".join([*base, f"end{k}"])) for k in range(5)]
    sets = [shingles(t) for _, t in rows]

    def linked(a, b):
        common = len(a & b)
        return common > 0 and 5 * common >= 4 * (len(a) + len(b) - common)

    want = [sum(linked(a, b) for k, b in enumerate(sets) if k != n) for n, a in enumerate(sets)]
    assert want[-5:] == [4] * 5
    got = similar_groups(documents(rows), block).collect()
    assert sorted(((r["doc_id"], r["n_links"]) for r in got), key=str) == sorted(
        ((d, n) for (d, _), n in zip(rows, want)), key=str
    )
