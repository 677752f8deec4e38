"""Toxicity from a learned lexicon, misspellings included, scored in context.

The lexicon (words and word stems) is learned from labelled documents: terms far commoner in
toxic texts than in others, first those that explain toxic texts which the terms before them
leave unexplained, then those that do not always stand beside one of these. It lies in a trie. A word of a text that is no term itself is run
as a Levenshtein automaton against the trie, which finds terms within one edit (two for long
words) without comparing the word to every term. Each hit is then read in its window of words:
quotation marks or words of reporting around it make it a quotation, otherwise it is abuse.
A logistic scorer over the weights of the hits gives the score. As labelled texts hardly show
misspellings and quotations, these have no weight of their own that could be learned as nothing: a
misspelt hit counts as a ``MISSPELT`` part of its term, and a quoted one as a ``QUOTED`` part.

Learning uses at most ``FIT_ROWS`` labelled rows, taken by the hash of their doc_id, never
those with crc32(doc_id) mod 5 = 0. Inputs of a score are the words of the text alone.

Defined cases: a null text is an empty one; an empty text is scored like a text without hits;
repeated rows get equal scores; a row without a doc_id is scored and not held out; repeated
labels of one document count once, toxic if any of them is; without labels of both kinds every
score is the share of toxic ones (0 without labels); an empty table gives no rows; columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roostline.llm.common import Memo, bounded_batches, table, texts, worker_cache, written
from roostline.session import scratch_scope

FIT_ROWS = 40_000
# A term needs a log-ratio of its shares in toxic and other texts, and this likelihood ratio
# (G squared) against chance, as very many words are tried.
LEAST_LIFT = 1.5
LEAST_EVIDENCE = 30.0
# Terms are chosen while they explain at least this many more toxic texts.
LEAST_NEW_TEXTS = 3
# A term that explains nothing new joins them unless this share of its texts holds one and the
# same chosen term, as for the words of a text with many near copies.
MOST_BESIDE = 0.7
# What is left of the weight of a term that is misspelt, and of one in a quotation.
MISSPELT = 0.8
QUOTED = 0.2
# Longer words are known by their md5.
LONG_WORD = 40
STEM_LENGTHS = (4, 5, 6, 7)
WINDOW = 6
HELD_OUT_FOLDS = 5

TOKEN = re.compile(r"\w+(?:[*@$!]\w+)*|[\"“”„«»]")
QUOTES = frozenset("\"“”„«»")
# Words that report what somebody else said.
REPORTING = frozenset(
    "said says say quote quoted quotes wrote written writes called calls word words term phrase "
    "sagte sagt schrieb nannte wort zitat dit écrit appelé mot citation dijo escribió llamó "
    "palabra cita".split()
)


class LevenshteinAutomaton:
    """The automaton of one word: a state is the row of edit distances to its prefixes, with
    everything beyond the limit as one value; states and their steps are kept."""

    def __init__(self, word: str, limit: int):
        self.word, self.limit = word, limit
        self.start = tuple(min(i, limit + 1) for i in range(len(word) + 1))
        self.steps: dict[tuple, tuple] = {}

    def step(self, state: tuple, letter: str) -> tuple:
        key = (state, letter)
        if key not in self.steps:
            beyond = self.limit + 1
            row = [min(state[0] + 1, beyond)]
            for i, own in enumerate(self.word):
                row.append(min(state[i] + (own != letter), state[i + 1] + 1, row[i] + 1, beyond))
            self.steps[key] = tuple(row)
        return self.steps[key]

    def alive(self, state: tuple) -> bool:
        return min(state) <= self.limit


class Trie:
    def __init__(self, terms):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term

    def within(self, word: str, limit: int, own=lambda term: None) -> tuple[int, str] | None:
        """The nearest term within ``limit`` edits and within its own limit, if ``own`` gives one;
        ties go to the smaller term."""
        automaton = LevenshteinAutomaton(word, limit)
        best = None
        open_nodes = [(self.root, automaton.start)]
        while open_nodes:
            node, state = open_nodes.pop()
            for letter, child in node.items():
                if letter == "":
                    most = own(child)
                    fits = state[-1] <= (limit if most is None else most)
                    if fits and (best is None or (state[-1], child) < best):
                        best = (state[-1], child)
                    continue
                after = automaton.step(state, letter)
                if automaton.alive(after):
                    open_nodes.append((child, after))
        return best


def edits(length: int) -> int:
    """Edits allowed in a term of this length."""
    return 0 if length < 5 else 1 if length < 9 else 2


EXACT, STEM, FUZZY = 0, 1, 2


@dataclass
class Lexicon:
    """Words and stems, each with its log-ratio (its weight)."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    # Words near a term that are known from texts without abuse.
    innocent: frozenset[str] = frozenset()
    _made: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "innocent": self.innocent, "_made": {}}

    def _prepare(self) -> None:
        terms = sorted(w for w in self.words if edits(len(w)) and not w.startswith("#"))
        pieces = set()
        lengths = set()
        for term in terms:
            limit = edits(len(term))
            lengths.update(range(len(term) - limit, len(term) + limit + 1))
            # One of limit + 1 pieces of a term survives that many edits.
            cuts = [len(term) * i // (limit + 1) for i in range(limit + 2)]
            pieces.update(term[a:b] for a, b in zip(cuts, cuts[1:]))
        self._made["trie"] = Trie(terms)
        self._made["lengths"] = frozenset(lengths)
        self._made["most"] = max(map(edits, map(len, terms)), default=0)
        self._made["piece"] = re.compile("|".join(map(re.escape, sorted(pieces)))) if pieces else None

    def kind(self, word: str) -> tuple[int, float] | None:
        """How a word hits the lexicon, and the weight of the term that it hits."""
        if named(word) in self.words:
            return EXACT, self.words[named(word)]
        for n in reversed(STEM_LENGTHS):
            if len(word) >= n and word[:n] in self.stems:
                return STEM, self.stems[word[:n]]
        if not self._made:
            self._prepare()
        piece = self._made["piece"]
        if piece is None or len(word) not in self._made["lengths"] or word in self.innocent:
            return None
        if not piece.search(word):
            return None
        near = self._made["trie"].within(word, self._made["most"], lambda term: edits(len(term)))
        return (FUZZY, self.words[near[1]]) if near else None


def named(word: str) -> str:
    """A word as a term: itself, or a hash of a very long one."""
    return word if len(word) <= LONG_WORD else "#" + hashlib.md5(word.encode("utf-8", "surrogatepass")).hexdigest()


def features(tokens: list[str], kinds: dict[str, tuple[int, float] | None]) -> list[float]:
    """1, the weights of abuse by kind (exact, stem, misspelt), of quotations, and the number of
    words, from the hits and their windows. A word counts once however often it is repeated."""
    hits = [(i, *kinds[t]) for i, t in enumerate(tokens) if kinds.get(t) is not None]
    abuse = [0.0, 0.0, 0.0]
    quoted = 0.0
    counted: set[tuple[str, bool]] = set()
    for i, kind, weight in hits:
        before = tokens[max(0, i - WINDOW) : i]
        after = tokens[i + 1 : i + 1 + WINDOW]
        marks = QUOTES.intersection(before) and QUOTES.intersection(after)
        quotation = bool(marks or REPORTING.intersection(before) or REPORTING.intersection(after[:2]))
        if (tokens[i], quotation) in counted:
            continue
        counted.add((tokens[i], quotation))
        if quotation:
            quoted += weight
        else:
            abuse[kind] += weight
    return [1.0, abuse[EXACT], abuse[STEM], abuse[FUZZY], quoted, float(len(tokens))]


def design(rows: list[list[float]]) -> np.ndarray:
    """What the scorer weighs: one abuse of words, however they are spelt, and that of stems."""
    x = np.asarray(rows, float).reshape(-1, 6)
    spelt, stem = x[:, 1 + EXACT] + MISSPELT * x[:, 1 + FUZZY], x[:, 1 + STEM]
    word = spelt + QUOTED * x[:, 4]
    share = np.log1p(word + stem) / (np.log1p(x[:, 5]) + 1.0)
    return np.column_stack([x[:, 0], np.log1p(word), np.log1p(stem), spelt > 0, stem > 0, share])


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def terms_of(tokens: list[str]) -> set[str]:
    """The words of a text and, marked by a star, the stems of its longer words."""
    found = {t for t in tokens if len(t) >= 3}
    return {named(t) for t in found} | {t[:n] + "*" for t in found for n in STEM_LENGTHS if len(t) > n}


@dataclass
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...] | None
    prior: float

    def scores(self, all_tokens: list[list[str]], memo: Memo) -> list[float]:
        if self.weights is None:
            return [self.prior] * len(all_tokens)
        rows = []
        for tokens in all_tokens:
            rows.append(features(tokens, memo.load(tokens)))
        logits = design(rows) @ np.asarray(self.weights)
        return (1.0 / (1.0 + np.exp(-np.clip(logits, -40, 40)))).tolist()


def kind_memo(lexicon: Lexicon) -> Memo:
    return Memo(lambda fresh: [lexicon.kind(t) for t in fresh], 500_000)


def fold(doc_id):
    """The remainder that separates rows to learn from (not 0) and held-out ones (0)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT_FOLDS))


def labelled_texts(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled texts, in a table. The labels are bounded by that
    parameter before they are broadcast to the documents. Rows with equal doc_id and text are
    one; where a doc_id has several texts, the bound holds for the distinct rows, by their hash."""
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.filter(fold(F.col("label_id")) != 0)
    chosen = (
        known.groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(fit_rows)
    )
    chosen = written(chosen, "chosen-labels")
    keyed = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    joined = keyed.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    # Hashes alone are sorted; texts are read for what is left.
    rows = (
        joined.select("label_id", "text_hash", "toxic")
        .distinct()
        .orderBy(F.xxhash64("label_id", "text_hash"), "label_id", "text_hash")
        .limit(fit_rows)
    )
    rows = written(rows, "chosen-rows").withColumnRenamed("text_hash", "row_hash")
    sample = keyed.join(
        F.broadcast(rows), (F.col("doc_id") == F.col("label_id")) & (F.col("text_hash") == F.col("row_hash"))
    ).dropDuplicates(["label_id", "text_hash"])
    return written(sample.select("text", "toxic"), "labelled-texts")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[int]] = {}
    worker_cache("toxicity")

    def flush():
        rows = pa.RecordBatch.from_pydict(
            {
                "term": pa.array(list(counts), pa.string()),
                "n_toxic": pa.array([c[1] for c in counts.values()], pa.int64()),
                "n_other": pa.array([c[0] for c in counts.values()], pa.int64()),
            }
        )
        counts.clear()
        return rows

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for term in terms_of(tokens_of(text)):
                counts.setdefault(term, [0, 0])[toxic] += 1
        if len(counts) > 300_000:
            yield flush()
    if counts:
        yield flush()


def choose_terms(incidence: list[list[int]], lifts: list[float]) -> list[int]:
    """Terms that explain the toxic texts: each the one with the largest lift times number of
    texts not yet explained. Then terms that are not just beside a chosen one."""
    holders: list[list[int]] = [[] for _ in lifts]
    for text, terms in enumerate(incidence):
        for t in terms:
            holders[t].append(text)
    open_texts = np.ones(len(incidence), bool)
    gains = {t: len(h) for t, h in enumerate(holders) if h}
    chosen: list[int] = []
    while gains:
        best = max(gains, key=lambda t: (gains[t] * lifts[t], -t))
        now = int(open_texts[holders[best]].sum())
        if now < LEAST_NEW_TEXTS:
            del gains[best]
        elif now < gains[best]:  # counts only fall: look again
            gains[best] = now
        else:
            chosen.append(best)
            open_texts[holders[best]] = False
            del gains[best]
    first = set(chosen)
    for t, held in enumerate(holders):
        if t not in first and held:
            beside = Counter(c for text in held for c in incidence[text] if c in first)
            if max(beside.values(), default=0) <= MOST_BESIDE * len(held):
                chosen.append(t)
    return chosen


def learn_lexicon(sample: DataFrame, n_toxic: int, n_other: int) -> Lexicon:
    counts = written(
        sample.mapInArrow(_counted, "term string, n_toxic bigint, n_other bigint")
        .groupBy("term")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other")),
        "term-counts",
    )
    lift = F.log((F.col("n_toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("n_other") + 0.5) / (n_other + 1))
    texts_with = F.col("n_toxic") + F.col("n_other")
    evidence = 2 * (
        F.col("n_toxic") * F.log(F.col("n_toxic") / (texts_with * n_toxic / (n_toxic + n_other)))
        + F.when(
            F.col("n_other") > 0,
            F.col("n_other") * F.log(F.col("n_other") / (texts_with * n_other / (n_toxic + n_other))),
        ).otherwise(0.0)
    )
    telling = (F.col("n_toxic") > 0) & (lift >= LEAST_LIFT) & (evidence >= LEAST_EVIDENCE)
    found = (
        counts.filter(telling)
        .select("term", lift.alias("lift"), evidence.alias("evidence"))
        .collect()
    )
    # Of a stem and a word that explain the same texts, the word comes first, then long stems.
    found.sort(key=lambda r: (r["term"].endswith("*"), -len(r["term"]), r["term"]))
    numbers = {r["term"]: n for n, r in enumerate(found)}
    lifts = [r["lift"] for r in found]

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                sorted(numbers[t] for t in terms_of(tokens_of(text)) if t in numbers)
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict({"terms": pa.array(rows, pa.list_(pa.int32()))})

    toxic = sample.filter("toxic = 1").select("text").distinct()
    held = [list(r["terms"]) for r in toxic.mapInArrow(incidence, "terms array<int>").collect()]
    chosen = [found[t] for t in choose_terms(held, lifts)]
    plain_words = {r["term"]: r["lift"] for r in chosen if not r["term"].endswith("*")}
    stems = {r["term"][:-1]: r["lift"] for r in chosen if r["term"].endswith("*")}
    lexicon = Lexicon(plain_words, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t for t in batch.column("term").to_pylist() if (lexicon.kind(t) or [None])[0] == FUZZY]
            yield pa.RecordBatch.from_pydict({"term": pa.array(found, pa.string())})

    usual = counts.filter((F.col("n_other") >= 2) & (lift < LEAST_LIFT)).filter(~F.col("term").endswith("*"))
    innocent = frozenset(r["term"] for r in usual.select("term").mapInArrow(near, "term string").collect())
    return Lexicon(plain_words, stems, innocent)


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 0.5) -> tuple[float, ...]:
    """Logistic regression by Newton steps, halved until the penalised loss falls. The bias,
    the first weight, is not penalised."""
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (ridge * w) @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        while (after := loss(w - step)) > now and np.abs(step).max() > 1e-10:
            step /= 2
        w, before, now = w - step, now, min(now, after)
        if before - now < 1e-9 * max(1.0, before):
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    bounded_batches(docs.sparkSession)
    with scratch_scope(docs.sparkSession):
        return _fitted(docs, labels, fit_rows)


def _fitted(docs: DataFrame, labels: DataFrame, fit_rows: int) -> Model:
    sample = labelled_texts(docs, labels, fit_rows)
    sizes = Counter({r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()})
    prior = sizes[1] / max(1, sizes[0] + sizes[1])
    if not sizes[0] or not sizes[1]:
        return Model(Lexicon(), None, prior)
    lexicon = learn_lexicon(sample, sizes[1], sizes[0])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kind_memo(lexicon)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                tokens = tokens_of(text)
                rows.append(features(tokens, memo.load(tokens)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"]
            )

    rows = sample.mapInArrow(described, "x array<double>, toxic int").collect()
    x = design([r["x"] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    order = np.lexsort((*x.T, y))
    return Model(lexicon, fit_weights(x[order], y[order]), prior)


def score_rows(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score in one more column."""
    bounded_batches(docs.sparkSession)

    at = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        memo = kind_memo(model.lexicon)
        for batch in batches:
            values = []
            for text in batch.column(at).to_pylist():
                values += model.scores([tokens_of(text or "")], memo)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, "score"]
            )

    # Plain names on the way: Python functions over rows do not take names with back-ticks.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = T.StructType([*numbered.schema.fields, T.StructField("score", T.DoubleType())])
    return numbered.mapInArrow(scored, schema).toDF(*docs.columns, name)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return score_rows(texts(docs), model, "score").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
