"""Proportional stratified interleaving against a plain ranking, its law and its mixture."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roostline.llm.interleaving import OP13_SQL, interleave, op13_proportional_interleaving
from tests.comparing import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def draw(*parts) -> int:
    texts = ["-" if p is None else f"={p}" for p in parts]
    return int(hashlib.md5("|".join(texts).encode()).hexdigest()[:15], 16)


def plain(rows, shards, seed):
    """The same shards by sorting whole lists; rows are (id, source)."""
    seen, groups = Counter(), defaultdict(list)
    for i, s in rows:
        seen[i, s] += 1
        key = "-" if s is None else f"={s}"
        groups[key].append((draw(seed, i, s, seen[i, s]), (i is not None, i), seen[i, s], (i, s)))
    placed = []
    for key, members in groups.items():
        shift = (draw(seed, "source", key) + 1) / 2.0**60
        for rank, (h, order, nth, row) in enumerate(sorted(members, key=lambda m: m[:3]), 1):
            placed.append(((rank - shift) / len(members), key, h, order, nth, row))
    placed.sort(key=lambda p: p[:5])
    n, out = len(placed), []
    for place, p in enumerate(placed):
        shard = place * shards // n
        out.append((*p[5], shard, place - -(-shard * n // shards)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, source string").repartition(3)


def test_equals_a_plain_ranking(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}") for i in range(600)]
    rows += [(None, None), (5, None), (None, "s1"), (7, "s0"), (7, "s0"), (7, ""), (8, "|=")]
    got = interleave(frame(spark, rows), "source", 9, "x")
    assert got.columns == ["id", "source", "shard", "slot"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, 9, "x")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.none() | st.integers(0, 5), st.none() | st.sampled_from(["a", "b", ""])), min_size=1, max_size=40
    ),
    st.integers(1, 12),
)
def test_any_rows(spark, rows, shards):
    got = interleave(frame(spark, rows), "source", shards)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, shards, "mixture-1")


def test_mixture_and_law(spark):
    """A source with a third of the rows, and many sources of one row each."""
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}" if i % 3 == 1 else f"only{i}") for i in range(6000)]
    got = interleave(frame(spark, rows), "source", 40).collect()
    sizes = Counter(r["shard"] for r in got)
    assert sorted(sizes) == list(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(size))
    for source, share in Counter(s for _, s in rows).items():
        if share >= 40:
            held = Counter(r["shard"] for r in got if r["source"] == source)
            assert all(abs(held[k] - share / 40) <= 10 + 0.02 * share / 40 for k in range(40))


def test_copies_do_not_depend_on_order_or_files(spark):
    rows = [(1, "a")] * 3000 + [(i, "b") for i in range(500)]
    want = plain(rows, 7, "mixture-1")
    for given_rows in (frame(spark, rows), frame(spark, rows[::-1]).repartition(1)):
        got = interleave(given_rows, "source", 7).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_few_and_clashing_columns(spark):
    empty = interleave(frame(spark, []), "source", 5)
    assert empty.count() == 0 and empty.columns == ["id", "source", "shard", "slot"]
    few = interleave(frame(spark, [(1, "a"), (2, None)]), "source", 5).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (2, 0)]
    odd = spark.createDataFrame(
        [(1, "a", "x", 1, 2, 3, 4)], "id bigint, source string, shard string, `row` int, cell int, hash int, `we``ird.c` int"
    )
    row = interleave(odd, "source", 5).first()
    assert row["shard"] == 0 and (row["row"], row["cell"], row["hash"], row["we`ird.c"]) == (1, 2, 3, 4)


def test_the_query(spark, documents, tmp_path):
    texts = [(1, "abc"), (1, "abc"), (2, None), (None, ""), (3, "ä" * 100_000), (4, "abc")]
    odd = documents(texts).withColumn("size", F.lit("x")).withColumn("shard", F.lit("y"))
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_proportional_interleaving(spark, str(tmp_path)).collect()
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t in texts]
    found = [(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(texts)


def test_the_query_equals_its_twin(spark):
    assert differences(spark, connect(SF_DIR), SF_DIR, op13_proportional_interleaving, OP13_SQL) == []
