from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb

from roostline.llm import line_templates
from roostline.llm.line_templates import OP10_SQL, line_dedup, op10_line_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain(rows, min_docs=3, min_tokens=4, depth=3, share=0.7):
    """The same rules, line by line."""
    lines = []
    for row, (doc, text) in enumerate(rows):
        for at, line in enumerate((text or "").split("\n")):
            tokens = re.sub("[0-9]+", "0", SPACE.sub(" ", line).strip(" ")).split(" ")
            if text is not None and len(tokens) >= min_tokens:
                leaf = (len(tokens), *("0" if "0" in t else t for t in tokens[:depth]))
                lines.append((row, doc, at, leaf, tuple(tokens)))
    leaf_docs = defaultdict(set)
    for _, doc, _, leaf, _ in lines:
        leaf_docs[leaf].add(doc)
    hot = [x for x in lines if len(leaf_docs[x[3]]) >= min_docs]
    variants = defaultdict(set)
    for _, doc, _, leaf, tokens in hot:
        variants[leaf, tokens].add(doc)
    support = Counter()
    for (leaf, tokens), docs in variants.items():
        for place, token in enumerate(tokens):
            support[leaf, place, token] += len(docs)
    values, of_place = Counter(), Counter()
    for (leaf, place, _), n in support.items():
        values[leaf, place] += 1
        of_place[leaf, place] += n
    named, template_docs = [], defaultdict(set)
    for row, doc, at, leaf, tokens in hot:
        kept = tuple(
            (p, t)
            for p, t in enumerate(tokens)
            if support[leaf, p, t] >= min_docs and (p < depth or values[leaf, p] ** 2 <= of_place[leaf, p])
        )
        enough = len(kept) >= share * len(tokens) and sum(p >= depth for p, _ in kept) >= 2
        if enough or len(variants[leaf, tokens]) >= min_docs:
            named.append((row, doc, at, (leaf, kept if enough else tokens, min_docs)))
    named += [(row, doc, at, (leaf, tokens, 2)) for row, doc, at, leaf, tokens in lines if len(tokens) >= 24]
    for _, doc, _, template in named:
        template_docs[template].add(doc)
    gone = defaultdict(set)
    for row, doc, at, template in named:
        docs = template_docs[template]
        known = [d for d in docs if d is not None]
        if len(docs) >= template[2] and (doc is None or doc != min(known)):
            gone[row].add(at)
    result = []
    for row, (doc, text) in enumerate(rows):
        if row in gone:
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[row])
        result.append((doc, len(gone[row]), text))
    return sorted(result, key=str)


ROWS = [
    (1, "Copyright 2021 by the authors\nmy own first line is here\n"),
    (2, "Copyright 2022 by the authors\nanother text of my own"),
    (3, "some words of the third\n  Copyright \t 7 by the authors"),
    (4, "Copyright 2022 by the authors"),
    (None, "Copyright 1 by the authors"),
    (5, "login by user alice from home\nlogin of user bob from work"),
    (6, "login by user carol from home\nThe.\n\n"),
    (7, "login by user dave from home\nThe.\n\n"),
    (8, "login by user alice from home\nThe."),
    (9, ""),
    (10, None),
    (11, "x" * 100_000),
    (4, "Copyright 2022 by the authors"),
    (12, "a b c d e f g h\n" * 3000),
    (13, " ".join(f"long{i}" for i in range(24)) + "\nshort and only in two texts"),
    (14, "before\n" + " ".join(f"long{i}" for i in range(24)) + "\nshort and only in two texts"),
    (15, " ".join(f"other{i}" for i in range(23))),
    (16, " ".join(f"other{i}" for i in range(23)) + "\r\n\x0b\x0clogin\tby  user eve from home"),
]


def got(df):
    return sorted(
        ((r["doc_id"], r["_n_dropped"], r["text"]) for r in df.collect()), key=str
    )


def test_equals_the_plain_form(documents):
    assert got(line_dedup(documents(ROWS))) == plain(ROWS)


def test_first_document_keeps_the_line_and_fields_are_generalised(documents):
    by_doc = {r["doc_id"]: r["text"] for r in line_dedup(documents(ROWS)).collect()}
    assert by_doc[1] == ROWS[0][1]
    assert by_doc[2] == "another text of my own"
    assert by_doc[4] == ""
    assert by_doc[6] == "The.\n\n"


def test_long_lines_go_from_their_second_document_on(documents):
    by_doc = {r["doc_id"]: r["text"] for r in line_dedup(documents(ROWS)).collect()}
    assert by_doc[13] == ROWS[-4][1] and by_doc[14] == "before\nshort and only in two texts"
    assert by_doc[15] == ROWS[-2][1] and by_doc[16].startswith("other0")


def test_columns_of_any_name(documents):
    docs = documents(ROWS).selectExpr("*", "1 AS _n_dropped", "2 AS `a``b`", "3 AS at", "4 AS row", "5 AS _dropped", "6 AS given")
    cleaned = line_dedup(docs, "n")
    assert cleaned.columns == [*docs.columns, "n"]
    assert {tuple(r[c] for c in ("_n_dropped", "a`b", "at", "row", "_dropped", "given")) for r in cleaned.collect()} == {
        (1, 2, 3, 4, 5, 6)
    }


def test_other_columns_pass_and_empty_tables_work(documents):
    docs = documents(ROWS)
    assert line_dedup(docs).columns == [*docs.columns, "_n_dropped"]
    assert line_dedup(docs.filter("doc_id = -1")).collect() == []


def test_sql_agrees_with_both(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    sql = sorted(con.execute(OP10_SQL).fetchall(), key=str)
    assert sql == plain(rows)
    assert sorted((tuple(r) for r in op10_line_dedup(spark, sf).collect()), key=str) == sql
    assert any(n for _, n, _ in sql)


def test_texts_are_normalised_and_cut_once(spark, documents, monkeypatch):
    """An expression in a lambda or below the cut into lines runs again at each place that names it."""
    docs = documents([(1, "a b c d\nx"), (2, "a b c d"), (3, "a b c d\ny")])
    rebuilt = line_dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(lines" in rebuilt and "lambdafunction(split" not in rebuilt
    # The text is carried once.
    assert not re.search(r"struct\([^)]*text", rebuilt)
    monkeypatch.setattr(line_templates, "written", lambda df, label: df)
    cut = line_templates._lines(docs, 4, 3)._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in cut.splitlines() if "Generate posexplode" in line)
    assert "regexp_replace" not in generate and "RLIKE" not in cut


def test_every_blank_and_digit_is_found_in_a_text(spark, documents):
    blanks = ["\t", "\x0b", "\x0c", "\r", "  ", "\x20\t", "\r\r"]
    rows = [(0, "one two three four")]
    rows += [(i, f"one{b}two three four") for i, b in enumerate(blanks, 1)]
    rows += [(20 + i, f"blue é {d}{9 - d}x green red") for i, d in enumerate(range(10))]
    rows += [(40, " one two three four "), (41, "one\u00a0two three four"), (42, "one two three\u2003four")]
    found = {r.doc_id: r._n_dropped for r in line_dedup(documents(rows)).collect()}
    assert found == {i: n for i, n, _ in plain(rows)}
    assert all(found[i] == 1 for i in [*range(1, len(blanks) + 1), *range(21, 30), 40])
