from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roostline.llm.toxicity import (
    EXACT,
    FUZZY,
    STEM,
    Lexicon,
    Trie,
    choose_terms,
    design,
    edits,
    features,
    fit,
    fit_weights,
    fold,
    kind_memo,
    labelled_texts,
    op9_toxicity,
    score,
    terms_of,
    tokens_of,
)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


TERMS = ["idiot", "moron", "pathetic", "disgusting", "worthless", "scum"]


def test_automaton_and_trie_find_what_comparing_all_terms_finds():
    trie = Trie(TERMS)
    letters = "adiomnrstx"
    words = {"".join(w) for w in itertools.product("imdx", "dor", "io", "ort", "ont")}
    words |= {t[:i] + c + t[i + 1 :] for t in TERMS for i in range(len(t)) for c in letters}
    words |= {t[:i] + t[i + 2 :] for t in TERMS for i in range(len(t))}
    for word in words:
        for limit in (0, 1, 2):
            near = min((distance(word, t), t) for t in TERMS)
            assert trie.within(word, limit) == (near if near[0] <= limit else None)


def test_kinds_equal_a_plain_comparison():
    lexicon = Lexicon(dict.fromkeys(TERMS, 2.0), {"vequ": 1.0}, frozenset({"idiom"}))
    words = {t[:i] + c + t[j:] for t in TERMS for i in range(len(t) + 1) for j in (i, i + 1, i + 2) for c in ("", "q")}
    for word in words | {"vequmo", "vequ", "veq", "idiom", "scun", "idiots"}:
        if word in TERMS:
            want = EXACT
        elif word.startswith("vequ"):
            want = STEM
        elif word == "idiom":
            want = None
        else:
            d, term = min((distance(word, t), t) for t in TERMS if len(t) > 4)
            want = FUZZY if d <= edits(len(term)) else None
        assert (lexicon.kind(word) or [None])[0] == want, word


def test_quotation_and_abuse_are_told_apart():
    lexicon = Lexicon(dict.fromkeys(TERMS, 2.0))
    memo = kind_memo(lexicon)

    def counts(text):
        tokens = tokens_of(text)
        return features(tokens, memo.load(tokens))

    abuse, quoted, misspelt = counts("you are an idiot here"), counts('he "idiot" cried'), counts("you idiott idit")
    assert abuse[1] > 0 and abuse[4] == 0
    assert quoted[1] == 0 and quoted[4] > 0
    assert counts("the report said idiot")[4] > 0
    assert misspelt[3] > 0 and misspelt[1] == 0


def test_terms_are_chosen_by_what_they_explain():
    # Term 1 stands beside term 0 in all its texts and explains nothing more; term 4 stands
    # beside different terms and is taken although it explains nothing more.
    texts = [[0, 1]] * 5 + [[0]] * 2 + [[2, 3]] * 2 + [[2]] + [[0, 4], [2, 4]]
    assert choose_terms(texts, [1.0] * 5) == [0, 2, 4]


def labelled(spark, documents, n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [f"w{(i * 7 + k * 13) % 90}x" for k in range(30)]
        if toxic:
            words[i % 30] = TERMS[i // 4 % 5]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_scores_and_edge_rows(spark, documents):
    docs, labels = labelled(spark, documents)
    extra = labels.union(spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 0, 0)], labels.schema))
    model = fit(docs, extra)
    assert {"idiot", "moron", "pathetic"} <= set(model.lexicon.words)
    odd = documents(
        [(None, "you idiot"), (1, None), (2, ""), (3, "w1x " * 100_000), (4, "a morron and an idiott"), (4, "w1x w2x")]
    )
    got = sorted((r["doc_id"] or 0, r["predicted"], r["held_out"]) for r in score(odd, model).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 0), (4, 1)]
    assert [g[2] for g in got] == [False] + [zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2, 3, 4, 4)]
    assert score(odd.filter("doc_id = 99"), model).collect() == []


@pytest.mark.parametrize("toxic, want", [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_labels_of_one_kind(spark, documents, toxic, want):
    docs = documents([(i, "some text") for i in range(20)])
    rows = [] if toxic is None else [(i, 1, toxic) for i in range(20)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in score(docs, fit(docs, labels)).collect()} == {want}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in op9_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect()
    held = [(rows[r["doc_id"]], r["toxic"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert len(held) > 500
    caught = sum(r["predicted"] for r, t in held if t) / sum(t for _, t in held)
    wrong = sum(r["predicted"] for r, t in held if not t) / sum(1 - t for _, t in held)
    # Some seven in a hundred toxic labels lie on texts without any sign of it.
    assert caught >= 0.87 and wrong <= 0.01, (caught, wrong)


def test_a_term_out_of_its_limit_hides_no_other():
    """Both terms are two edits away; only the longer one allows two."""
    terms = {"abcdefgh": 1.0, "abcdefghij": 3.0}
    word = "abcdefghxy"
    assert [distance(word, t) for t in terms] == [2, 2]
    assert Lexicon(terms).kind(word) == (FUZZY, 3.0)
    for word in ("abcdefgxy", "abcdefg", "abcdefghi", "abcdefxhij", "xbcdefgh", "xycdefghij"):
        want = any(distance(word, t) <= edits(len(t)) for t in terms)
        assert ((Lexicon(terms).kind(word) or [None])[0] == FUZZY) == want, word


def test_repeated_rows_are_one_and_the_sample_is_bounded(spark, documents):
    learned = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in learned], "doc_id bigint, quality int, toxic int")
    rows = [(i, f"text {i}") for i in learned] + [(learned[0], f"text {learned[0]}")] * 500
    sample = labelled_texts(documents(rows), labels, 1000).collect()
    assert sorted((r["text"], r["toxic"]) for r in sample) == sorted((f"text {i}", i % 2) for i in learned)
    rows += [(learned[1], f"other text {k}") for k in range(300)]
    assert labelled_texts(documents(rows), labels, 50).count() == 50


def test_very_long_words_count_as_terms():
    word = "ab" * 40
    lexicon = Lexicon(dict.fromkeys([*terms_of([word])], 2.0))
    assert lexicon.kind(word)[0] == EXACT and lexicon.kind("ab" * 41) is None


def test_misspelt_toxic_texts_are_found_like_those_spelt_right(spark):
    """An edit in every term of the held-out toxic texts that are found by their words."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = fit(docs, labels)
    held = labels.filter("toxic = 1").filter(fold(F.col("doc_id")) == 0).select("doc_id")
    texts = [r["text"] for r in docs.join(held, "doc_id").select("text").collect()]
    memo = kind_memo(model.lexicon)
    found = planted = 0
    for text in texts:
        tokens = tokens_of(text)
        terms = {t for t in tokens if t in model.lexicon.words and edits(len(t)) and "#" not in t}
        rest = [t for t in tokens if t not in terms]
        alone = " ".join([*rest[:50], *terms])
        if not terms or model.scores([tokens_of(alone)], memo)[0] < 0.5:
            continue
        if model.scores([rest[:50]], memo)[0] >= 0.5:
            continue
        found += 1
        wrong = " ".join([*rest[:50], *(t[: len(t) // 2] + t[len(t) // 2] * 2 + t[len(t) // 2 + 1 :] for t in terms)])
        planted += model.scores([tokens_of(wrong)], memo)[0] >= 0.5
    assert found >= 40 and planted >= 0.9 * found, (planted, found)


def test_the_whole_result_equals_a_plain_one(spark, documents):
    """Fit and score in one process: terms by their counts, misspellings by comparing all terms."""
    docs, labels = labelled(spark, documents)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    learned = [(terms_of(tokens_of(t)), tokens_of(t), toxic[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    n = Counter(y for _, _, y in learned)
    counts = {y: Counter(t for terms, _, own in learned if own == y for t in terms) for y in (0, 1)}
    lifts = {}
    for term, with_term in counts[1].items():
        other = counts[0][term]
        lift = math.log((with_term + 0.5) / (n[1] + 1)) - math.log((other + 0.5) / (n[0] + 1))
        parts = [(with_term, n[1]), (other, n[0])]
        chance = (with_term + other) / (n[0] + n[1])
        if lift >= 1.5 and 2 * sum(k * math.log(k / (chance * size)) for k, size in parts if k) >= 30:
            lifts[term] = lift
    order = sorted(lifts, key=lambda t: (t.endswith("*"), -len(t), t))
    held = [[order.index(t) for t in sorted(terms & set(order), key=order.index)] for terms, _, y in learned if y]
    chosen = [order[t] for t in choose_terms(held, [lifts[t] for t in order])]
    words = {t: lifts[t] for t in chosen if not t.endswith("*")}
    stems = {t[:-1]: lifts[t] for t in chosen if t.endswith("*")}
    common = {
        t for t, k in counts[0].items()
        if k >= 2 and not t.endswith("*")
        and math.log((counts[1][t] + 0.5) / (n[1] + 1)) - math.log((k + 0.5) / (n[0] + 1)) < 1.5
    }

    def kind(word):
        if word in words:
            return EXACT, words[word]
        for k in (7, 6, 5, 4):
            if len(word) >= k and word[:k] in stems:
                return STEM, stems[word[:k]]
        near = [(distance(word, t), t) for t in words if 0 < edits(len(t)) and distance(word, t) <= edits(len(t))]
        if word in common or not near:
            return None
        return FUZZY, words[min(near)[1]]

    def described(tokens):
        return features(tokens, {t: kind(t) for t in tokens})

    x = design([described(tokens) for _, tokens, _ in learned])
    y = np.array([y for _, _, y in learned], float)
    by_row = np.lexsort((*x.T, y))
    weights = np.asarray(fit_weights(x[by_row], y[by_row]))
    more = rows + [(900, "an idiott and a morron"), (901, 'he said "idiot" twice'), (902, ""), (903, None)]
    want = {}
    for i, text in more:
        z = design([described(tokens_of(text or ""))]) @ weights
        want[i] = 1 / (1 + math.exp(-z[0]))
    got = {r["doc_id"]: r["score"] for r in score(documents(more), fit(docs, labels)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
