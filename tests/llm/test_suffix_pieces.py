from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from roostline.llm.suffix_pieces import (
    BORDER,
    Pieces,
    decode_documents,
    encode_documents,
    occurrences,
    op6_sentencepiece,
    suffix_array,
)

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "",
    "Hello world",
    "  two  spaces ",
    "\t tab\nnew line",
    "é ñ 日本語 😀",
    "a" * 500,
    "<s> </s> <0x0A> <unk>",
    " ",
    "\x00 nul \x01",
    "the the " * 5000,
    "K ﬁ Å é",
    "﻿ bom ​ zw 　 wide",
    "x" + " " * 40 + "y",
    "unbelievablyaffectionately" * 300,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_are_those_of_the_library_and_texts_come_back(library):
    coder = Pieces(PATH)
    encoded = coder.encode(TEXTS)
    for text, ids in zip(TEXTS, encoded):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), text[:40]
        assert coder.decode(ids) == text


def test_a_text_with_the_mark_is_read_as_with_spaces(library):
    coder = Pieces(PATH)
    text = "▁mark ▁▁ x"
    ids = coder.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
    assert coder.decode(ids) == library.decode(library.encode(text))


def test_ranges_of_the_suffix_array_are_all_places():
    rng = random.Random(4)
    text = "".join(rng.choices("abc", k=600))
    codes = np.array([BORDER if c == "c" and rng.random() < 0.3 else ord(c) for c in text], np.int64)
    order = suffix_array(codes, 6)
    wanted = ["".join(rng.choices("abc", k=k)) for k in (2, 3, 4, 5, 6) for _ in range(8)]
    table = np.zeros((len(wanted), 6), np.int64)
    for row, w in enumerate(wanted):
        table[row, : len(w)] = [ord(c) for c in w]
    lengths = np.array([len(w) for w in wanted])
    low, high = occurrences(codes, order, table, lengths)
    for w, a, b in zip(wanted, low, high):
        plain = [i for i in range(len(codes)) if codes[i : i + len(w)].tolist() == [ord(c) for c in w]]
        assert sorted(order[a:b].tolist()) == plain


def test_rows_nulls_and_empty_tables(documents, library):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "some text"), (3, "some text")]
    got = decode_documents(encode_documents(documents(rows), PATH), PATH).collect()
    assert len(got) == 5
    for r in got:
        ids = np.array(library.encode(r["text"]), "<u4")
        assert (r["n_tokens"], r["ids_crc32"], r["decoded"]) == (len(ids), zlib.crc32(ids.tobytes()), r["text"])
    assert decode_documents(encode_documents(documents(rows).filter("doc_id = 9"), PATH), PATH).collect() == []


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = {r["doc_id"]: r for r in op6_sentencepiece(spark, sf).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text or ""), "<u4")
        r = rows[doc_id]
        assert (r["n_tokens"], r["ids_crc32"], r["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True)


def test_ranges_hold_every_occurrence():
    """Each piece's range against a look at every position, past the ends and at the limits."""
    import numpy as np

    from roostline.llm.suffix_pieces import BORDER, occurrences, suffix_array

    rng = random.Random(1)
    letters = [97, 98, 99, 0x10FFFF, 0]
    for _ in range(200):
        codes = np.array([rng.choice([*letters, BORDER]) for _ in range(rng.randint(1, 60))], np.int64)
        pieces = [[rng.choice(letters) for _ in range(rng.randint(2, 7))] for _ in range(rng.randint(1, 30))]
        lengths = np.array([len(p) for p in pieces])
        table = np.zeros((len(pieces), lengths.max()), np.int64)
        for row, p in enumerate(pieces):
            table[row, : len(p)] = p
        order = suffix_array(codes, int(lengths.max()))
        for p, low, high in zip(pieces, *occurrences(codes, order, table, lengths)):
            places = [i for i in range(len(codes)) if codes[i : i + len(p)].tolist() == p]
            assert sorted(order[low:high].tolist()) == places
