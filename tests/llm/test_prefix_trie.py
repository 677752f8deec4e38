"""The prefix trie against plain dictionaries, subtree totals against plain sums."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from roostline.llm import prefix_trie
from roostline.llm.forest import centroid_totals, subtree_sizes, subtree_totals
from roostline.llm.prefix_trie import OP12_SQL, op12_prefix_trie, rebuilt, trie, turns
from tests.comparing import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def shapes():
    draw = random.Random(3)
    yield "chain", [-1, *range(99)]
    yield "star", [-1] + [0] * 300
    yield "random", [-1 if i < 3 else draw.randrange(i) for i in range(400)]
    yield "deep", [-1 if i == 0 else max(0, i - draw.randrange(1, 4)) for i in range(400)]
    yield "star of chains", [-1] + [0 if i % 9 == 0 else i for i in range(300)]
    yield "broom", [-1, *range(150)] + [150] * 200
    yield "single", [-1]


def plain_totals(parents, values):
    totals = list(values)
    depth = [0] * len(parents)
    for i, p in enumerate(parents):
        depth[i] = depth[p] + 1 if p >= 0 else 0
    for i in sorted(range(len(parents)), key=lambda i: -depth[i]):
        if parents[i] >= 0:
            totals[parents[i]] += totals[i]
    return totals


@pytest.mark.parametrize("name, parents", list(shapes()))
def test_centroid_totals(name, parents):
    values = [(i * 37) % 11 - 3 for i in range(len(parents))]
    assert centroid_totals(parents, [values, [1] * len(parents)]) == [
        plain_totals(parents, values),
        plain_totals(parents, [1] * len(parents)),
    ]


@pytest.mark.parametrize("name, parents", [s for s in shapes() if s[0] in ("chain", "star", "broom")])
def test_subtree_totals_with_small_tasks(spark, name, parents):
    """Small limits, so that large nodes remain, chains are joined and the smaller forest is solved."""

    def key(i):
        return hashlib.md5(str(i).encode()).digest()

    values = [(i * 37) % 11 for i in range(len(parents))]
    rows = [(key(i), key(p) if p >= 0 else None, v, 1) for i, (p, v) in enumerate(zip(parents, values))]
    forest = spark.createDataFrame(rows, "node binary, parent binary, v bigint, one bigint").repartition(3)
    sizes = plain_totals(parents, [1] * len(parents))
    if name == "star":
        assert {bytes(r["node"]): r["size"] for r in subtree_sizes(forest).collect()} == dict(
            zip(map(key, range(len(parents))), sizes)
        )
    got = {bytes(r["node"]): (r["v"], r["one"]) for r in subtree_totals(forest, ["v", "one"], limit=40).collect()}
    want = zip(plain_totals(parents, values), sizes)
    assert got == dict(zip(map(key, range(len(parents))), want))


def plain(rows):
    """The contract's nodes from dictionaries; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), mark, (role, text)))
    own = {c: [t for _, _, t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = (own.get(c - c % 5, [])[:h] + own[c][h:]) if c % 5 else own[c]
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not children[node]
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(node))
        out.append(
            (min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node],
             saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def stored(spark, rows, folder):
    schema = "conv_id bigint, turn bigint, role string, text string, node string, depth string"
    spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3).write.parquet(
        f"{folder}/conversations.parquet"
    )
    return str(folder)


def found(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_conversations(spark, tmp_path):
    rows = [
        (0, 1, "user", "a"), (0, 0, "system", "s"), (0, None, None, "first"), (1, 0, "user", "ä" * 50_000),
        (1, 1, "user", None), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (3, 5, "", ""),
        (6, 0, "user", "x"), (7, 0, "user", "x"), (8, 0, "us", "erx"), (9, 0, "user", "x"), (None, 0, "user", "x"),
        *[(10, t, "user", f"t{t}") for t in range(12)], *[(11, t, "user", f"t{t}") for t in range(12)],
        *[(12, t, "user", f"t{t}") for t in range(3)], *[(14, t, "assistant", f"t{t}") for t in range(15)],
        (23, 0, "user", "nobody before"), (-5, 0, "user", "x"), (10**12, 0, "user", "x"),
    ]
    assert found(op12_prefix_trie(spark, stored(spark, rows, tmp_path))) == plain(rows)


def test_one_long_conversation_and_many_copies(spark, tmp_path, monkeypatch):
    """A conversation with most turns, very many equal ones, and pieces of few ids."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(0, t, "user", f"long {t}") for t in range(700)]
    rows += [(5 * i, t, "user", f"same {t}") for i in range(1, 150) for t in range(2)]
    rows += [(5 * i + 1, 0, "user", f"own {i}") for i in range(100)]
    conversations = stored(spark, rows, tmp_path)
    assert found(op12_prefix_trie(spark, conversations)) == plain(rows)


def test_turnless_empty_and_limits(spark, tmp_path):
    assert found(op12_prefix_trie(spark, stored(spark, [], tmp_path / "none"))) == []
    # Conversation 1 keeps turns after its seventh, borrows from 0, which is absent: it has none.
    rows = [(1, 0, "user", "x")]
    assert zlib.crc32(b"1") % 9 > 0
    assert found(op12_prefix_trie(spark, stored(spark, rows, tmp_path / "one"))) == plain(rows)
    draw = random.Random(1)
    rows = [(c, t, "user", f"{draw.randrange(2)}") for c in range(60) for t in range(draw.randrange(1, 9))]
    table = spark.read.parquet(f"{stored(spark, rows, tmp_path / 'some')}/conversations.parquet")
    got = trie(*rebuilt(turns(table)), limit=5)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert found(got.select(*names)) == plain(rows)


def test_the_query_equals_its_twin(spark):
    assert differences(spark, connect(SF_DIR), SF_DIR, op12_prefix_trie, OP12_SQL) == []
