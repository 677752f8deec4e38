from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest

from roostline.llm.planes import (
    PlaneReader,
    PlaneWriter,
    join_planes,
    op5_bit_planes,
    read_planes,
    split_planes,
    write_planes,
)
from roostline.session import scratch_dir
from tests.llm.test_packing import TEXTS, reference

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert (join_planes(split_planes(ids, planes), n) == ids).all()


@pytest.mark.parametrize("planes", [4, 32])
def test_file_round_trip_and_ranges(planes):
    rng = np.random.default_rng(5)
    docs = [(None, 1), (3, 0), (4, 700), (5, 64), (5, 64), (9, 1)]
    ids = [rng.integers(0, 50_000, n, dtype=np.uint32) for _, n in docs]
    out = io.BytesIO()
    writer = PlaneWriter(out, planes, block=64)
    for (doc_id, _), part in zip(docs, ids):
        writer.add(doc_id, part.tobytes())
    writer.close()
    reader = PlaneReader(out, len(out.getvalue()))
    back = [(d, n, np.concatenate([*parts, np.zeros(0, np.uint32)])) for d, n, parts in reader.documents()]
    assert [(d, n) for d, n, _ in back] == docs
    assert all((a == b).all() for (_, _, a), b in zip(back, ids))
    every = np.concatenate(ids)
    for start, stop in ((0, 830), (63, 65), (500, 500), (829, 830)):
        assert (np.concatenate([*reader.ids(start, stop), np.zeros(0, np.uint32)]) == every[start:stop]).all()


def expected(rows):
    encode = reference(lower=True)
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*encode(text), 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents_come_back(spark, documents):
    rows = list(enumerate(TEXTS))
    folder = scratch_dir(spark, "planes")
    got = read_planes(write_planes(documents(rows), folder, PATH, True, 2), folder)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


def test_repeated_rows_null_ids_and_empty_tables(spark, documents):
    rows = [(None, "first"), (1, "same"), (1, "same")]
    folder = scratch_dir(spark, "planes")
    got = read_planes(write_planes(documents(rows), folder, PATH, True, 2, planes=32), folder).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected(rows)
    empty = documents(rows).filter("doc_id > 5")
    assert read_planes(write_planes(empty, folder, PATH, True, 2), folder).collect() == []


def test_rows_of_one_doc_id_have_an_order_and_are_spread(spark, documents):
    hashed = [(i, f"text number {i % 50}") for i in range(400)]
    rows = [(7, text) for _, text in hashed] + [(8, "after"), (6, "before")]
    docs = documents(rows)
    order = {
        r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()
    }
    placed = sorted(rows, key=lambda r: (r[0], order[r[1]]))
    for given in (docs, documents(rows[::-1]).repartition(3)):
        folder = scratch_dir(spark, "planes")
        files = write_planes(given, folder, PATH, True, 2)
        assert files.count() > 1 and max(r["n_docs"] for r in files.collect()) < 300
        got = sorted((tuple(r) for r in read_planes(files, folder).collect()), key=lambda r: r[1])
        assert got == expected(placed)
    # All rows alike: still more than one file.
    folder = scratch_dir(spark, "planes")
    files = write_planes(documents([(7, "same")] * 400), folder, PATH, True, 2)
    assert max(r["n_docs"] for r in files.collect()) < 300
    assert sorted(tuple(r) for r in read_planes(files, folder).collect()) == expected([(7, "same")] * 400)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(tuple(r) for r in op5_bit_planes(spark, sf).collect()) == expected([tuple(r) for r in rows])
