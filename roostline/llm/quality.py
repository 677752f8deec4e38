"""A quality classifier from weak labels.

Heuristic labellers look at a text and vote good (1), bad (0) or abstain (-1). No label table
is read. Expectation-maximisation over the counts of vote patterns estimates how often each
labeller is right when it votes and how common good texts are; its posterior is the label of a
pattern. A linear scorer over hashed word features learns those labels from
at most ``FIT_ROWS`` texts, chosen by the hash of their content, and scores every document.

Defined cases: a null text is an empty one; a text without words is bad with score 0; repeated
rows get equal scores; an empty table gives no rows; when all votes agree the prior decides;
columns other than id and text are ignored. Whole texts are read, one at a time.
"""

from __future__ import annotations

import re
import string
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.llm.common import Memo, bounded_batches, mixed, table, texts, written

FIT_ROWS = 20_000
BUCKETS = 1 << 14
EPOCHS = 12

GOOD, BAD, ABSTAIN = 1, 0, -1
MARKS = re.compile(rb"[#*$%&|<>{}\[\]\\^~=_@!]")
PLAIN = re.compile(rb"[A-Za-z\x80-\xff'-]+[.,;:?!]?")
START = 0.9
# Votes that the belief in a labeller counts as, however many it casts.
BELIEF = 100


MARKED, LONE, SHOUTED, PLAIN_WORD, ENDS = 1, 2, 4, 8, 16
HASH, FLAGS, LETTERS, CAPITALS, SIZE, FEATURES = range(6)


def _bucket(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key) % BUCKETS


SHAPES: dict[bytes, int] = {}
# Classes of bytes in shapes: capitals, digits, other letters and bytes beyond ASCII, marks.
CLASSES = bytes(
    65 if chr(c) in string.ascii_uppercase else 48 if chr(c) in string.digits
    else 97 if chr(c) in string.ascii_lowercase or c >= 128 else c
    for c in range(256)
)
RUN = re.compile(rb"(.)\1+", re.DOTALL)


def _shape_bucket(shape: bytes) -> int:
    if len(shape) > 40:
        return _bucket(b"s" + shape)
    if shape not in SHAPES:
        if len(SHAPES) > 100_000:
            SHAPES.clear()
        SHAPES[shape] = _bucket(b"s" + shape)
    return SHAPES[shape]


def _described(word: bytes) -> tuple[int, int, int, bytes]:
    """Flags, letters, capitals and shape of any word."""
    text = word.decode("utf-8", "replace")
    flags = MARKED * (MARKS.search(word) is not None)
    flags |= LONE * (not any(c >= 128 or chr(c).isalnum() for c in word))
    flags |= SHOUTED * word.endswith(b"!")
    flags |= PLAIN_WORD * (PLAIN.fullmatch(word) is not None)
    flags |= ENDS * word.endswith((b".", b"?", b".\""))
    shape = RUN.sub(rb"\1", word.translate(CLASSES))
    return flags, sum(map(str.isalpha, text)), sum(map(str.isupper, text)), shape


def word_records(fresh: list[bytes]) -> list[bytes]:
    """What is known of a word, as six 64-bit integers: its hash, its flags, its letters and
    capitals, its size and the two feature buckets of its ending and its shape."""
    out = []
    for word in fresh:
        # Most words are lower-case letters, perhaps after one capital and before one mark.
        mark = word[-1:] if word[-1] in b".,;:?" else b""
        stem = word[: len(word) - len(mark)].decode("utf-8", "replace")
        if stem.isalpha() and (stem.islower() or stem[1:].islower()):
            initial = stem[0].isupper()
            flags = PLAIN_WORD | ENDS * (mark in (b".", b"?"))
            letters, capitals = len(stem), int(initial)
            shape = (b"Aa" if initial and stem[0].isascii() else b"a") + mark
        else:
            flags, letters, capitals, shape = _described(word)
        buckets = _bucket(b"e" + word.lower()[-3:]) | _shape_bucket(shape) << 32
        digest = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        out.append(struct.pack("<6q", digest, flags, letters, capitals, len(word), buckets))
    return out


RECORDS = Memo(word_records)


class View:
    """What the labellers and the scorer look at: a text's words as records, and its lines."""

    def __init__(self, raw: bytes, found: list[bytes], known: dict[bytes, bytes]):
        self.raw = raw
        self.records = np.frombuffer(b"".join(map(known.__getitem__, found)), "<i8").reshape(-1, 6)
        self.n = len(found)

    @classmethod
    def of(cls, all_texts: list[str]) -> Iterator[View]:
        """The views of many texts; the memo is asked once for some 200,000 words."""
        group: list[tuple[bytes, list[bytes]]] = []
        size = 0
        for n, text in enumerate(all_texts):
            raw = text.encode("utf-8", "surrogatepass")
            group.append((raw, raw.split()))
            size += len(group[-1][1])
            if size >= 200_000 or n == len(all_texts) - 1:
                known = RECORDS.load(chain.from_iterable(found for _, found in group))
                yield from (cls(raw, found, known) for raw, found in group)
                group, size = [], 0

    def share(self, flag: int) -> float:
        return np.count_nonzero(self.records[:, FLAGS] & flag) / self.n

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def distinct_pairs(self) -> float:
        """Share of distinct pairs of neighbouring words; texts under 20 words count as varied."""
        if self.n < 20:
            return 1.0
        hashes = self.records[:, HASH].view(np.uint64)
        pairs = mixed(hashes[:-1]) + hashes[1:]
        return len(np.unique(pairs)) / (self.n - 1)


def bad_if(found: bool) -> int:
    """The vote of a labeller that knows one kind of bad text and says nothing of others."""
    return BAD if found else ABSTAIN


def marked_words(v: View) -> int:
    return bad_if(v.share(MARKED) > 0.25)


def separators(v: View) -> int:
    """Words without letter or digit, as between the items of menus and tables."""
    return bad_if(v.share(LONE) > 0.15)


def capitals(v: View) -> int:
    letters = int(v.records[:, LETTERS].sum())
    return bad_if(letters >= 40 and int(v.records[:, CAPITALS].sum()) > 0.4 * letters)


def exclamations(v: View) -> int:
    return bad_if(v.share(SHOUTED) > 0.2)


def plain_words(v: View) -> int:
    """Words of letters alone, with at most a mark behind them, in a text that goes on."""
    share = v.share(PLAIN_WORD)
    if share < 0.6:
        return BAD
    return GOOD if share >= 0.85 and v.distinct_pairs >= 0.6 else ABSTAIN


def sentence_length(v: View) -> int:
    """Words per mark that ends a sentence."""
    per_end = v.n / (np.count_nonzero(v.records[:, FLAGS] & ENDS) + 0.5)
    return bad_if(v.n >= 20 and (per_end < 2 or per_end > 150))


def repeated_lines(v: View) -> int:
    return bad_if(len(v.lines) >= 4 and len(set(v.lines)) < 0.6 * len(v.lines))


def repeated_pairs(v: View) -> int:
    return bad_if(v.distinct_pairs < 0.5)


def runs(v: View) -> int:
    """One word again and again, or two words in turns."""
    hashes = v.records[:, HASH]
    return bad_if(v.n >= 20 and np.count_nonzero(hashes[:-2] == hashes[2:]) > 0.15 * v.n)


def word_length(v: View) -> int:
    mean = int(v.records[:, SIZE].sum()) / v.n
    return bad_if(mean < 2.5 or mean > 14)


LABELLERS = (
    marked_words,
    separators,
    capitals,
    exclamations,
    plain_words,
    sentence_length,
    repeated_lines,
    repeated_pairs,
    runs,
    word_length,
)


def votes(text: str) -> tuple[int, ...] | None:
    return votes_of(next(View.of([text])))


def votes_of(view: View) -> tuple[int, ...] | None:
    return tuple(label(view) for label in LABELLERS) if view.n else None


@dataclass(frozen=True)
class LabelModel:
    """The share of good texts and each labeller's accuracy where it votes."""

    good: float
    accuracy: np.ndarray

    def posteriors(self, patterns: np.ndarray) -> np.ndarray:
        strength = np.log(self.accuracy) - np.log1p(-self.accuracy)
        signed = np.where(patterns == GOOD, 1, np.where(patterns == BAD, -1, 0))
        logit = np.log(self.good) - np.log1p(-self.good) + signed @ strength
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        return float(self.posteriors(np.array([pattern]))[0])


def estimate(
    patterns: dict[tuple[int, ...], int], rounds: int = 200, belief: float | None = None
) -> LabelModel:
    """Expectation-maximisation. A labeller starts as right in ``START`` of its votes; this
    belief counts as ``belief`` votes, by default as much as its votes do, so that one large
    class cannot turn a labeller of a small one around."""
    keys = np.array(sorted(patterns))
    weight = np.array([patterns[tuple(k)] for k in keys.tolist()], float)
    model = LabelModel(0.5, np.full(keys.shape[1], START))
    for _ in range(rounds):
        good = model.posteriors(keys)
        right = np.where(keys == GOOD, good[:, None], np.where(keys == BAD, 1 - good[:, None], 0))
        cast = (weight[:, None] * (keys != ABSTAIN)).sum(axis=0)
        held = cast + 1 if belief is None else belief
        accuracy = ((weight[:, None] * right).sum(axis=0) + held * START) / (
            2 * cast + 1 if belief is None else cast + belief
        )
        share = float(np.clip((weight * good).sum() / weight.sum(), 0.1, 0.9))
        new = LabelModel(share, np.clip(accuracy, 0.55, 0.98))
        done = np.abs(new.accuracy - model.accuracy).max() + abs(new.good - model.good) < 1e-9
        model = new
        if done:
            break
    return model


def counted(view: View) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashed features of a text: the buckets of its words, how often each occurs, and the
    bucket for the share of distinct pairs of neighbouring words."""
    packed = view.records[:, FEATURES]
    at, counts = np.unique(np.concatenate([packed & 0xFFFFFFFF, packed >> 32]), return_counts=True)
    return at, counts, _bucket(b"pairs%d" % (10 * view.distinct_pairs))


def vector(at: np.ndarray, counts: np.ndarray, variety: int) -> tuple[np.ndarray, np.ndarray]:
    """Features with their values: those of the words, of length one together, and the variety."""
    values = counts / np.sqrt((counts.astype(float) ** 2).sum())
    return np.append(at, variety), np.append(values, 1.0)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels by adaptive gradient steps; both classes weigh the
    same. The last weight is the bias."""
    w = np.zeros(BUCKETS + 1)
    speed = np.full(BUCKETS + 1, 1e-6)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for n in order.permutation(len(rows)):
            at, values = rows[n]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ values + w[-1], -30, 30)))
            weight = labels[n] / share + (1 - labels[n]) / (1 - share)
            slope = (p - labels[n]) * min(weight, 10.0)
            gradient = slope * values + 1e-6 * w[at]
            speed[at] += gradient**2
            w[at] -= 0.5 * gradient / np.sqrt(speed[at])
            speed[-1] += slope**2
            w[-1] -= 0.5 * slope / np.sqrt(speed[-1])
    return w


def described(docs: DataFrame) -> DataFrame:
    """What one reading of the texts gives, as a table: doc_id, ``key`` (the text's hash), the
    pattern of votes (null without words), and the counted features ``at``, ``counts`` (arrays
    of little-endian integers of two and four bytes) and ``variety``."""
    bounded_batches(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for view in View.of(batch.column("text").to_pylist()):
                if view.n:
                    at, counts, variety = counted(view)
                    rows.append((votes_of(view), at.astype("<u2").tobytes(), counts.astype("<i4").tobytes(), variety))
                else:
                    rows.append((None, b"", b"", None))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *map(pa.array, columns, KINDS)], NAMES
            )

    KINDS = [pa.list_(pa.int8()), pa.binary(), pa.binary(), pa.int32()]
    NAMES = ["doc_id", "key", "pattern", "at", "counts", "variety"]
    source = texts(docs).select("doc_id", F.xxhash64("text").alias("key"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key bigint, pattern array<tinyint>, at binary, counts binary, variety int"
    return written(source.mapInArrow(describe, schema), "described-texts")


def fit_described(seen: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[LabelModel, np.ndarray] | None:
    """The label model over all documents and the scorer from at most ``fit_rows`` of them.
    The driver gets one row per vote pattern (at most 3 to the number of labellers), and the
    features of the texts with the smallest ``fit_rows`` hashes."""
    worded = seen.filter("pattern is not null")
    patterns = {
        tuple(r["pattern"]): r["n"] for r in worded.groupBy("pattern").agg(F.count("*").alias("n")).collect()
    }
    if not patterns:
        return None
    model = estimate(patterns, belief=BELIEF)
    smallest = worded.select("key").distinct().orderBy("key").limit(fit_rows)
    last = smallest.agg(F.max("key")).first()[0]
    picked = worded.filter(F.col("key") <= last).drop("doc_id").dropDuplicates(["key"])
    rows = sorted(picked.collect(), key=lambda r: r["key"])
    labels = np.array([model.posterior(tuple(r["pattern"])) for r in rows])
    features = [
        vector(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<i4"), r["variety"])
        for r in rows
    ]
    return model, train(features, labels)


def score_described(seen: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """doc_id, score and kept of every described text."""
    bounded_batches(seen.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = np.zeros(n)
            found = batch.column("at").to_pylist()
            sizes = np.array([len(x) // 2 for x in found], np.int64)
            if weights is not None and sizes.any():
                at = np.frombuffer(b"".join(found), "<u2")
                counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<i4").astype(float)
                row = np.repeat(np.arange(n), sizes)
                length = np.sqrt(np.bincount(row, counts * counts, n))
                variety = batch.column("variety").fill_null(0).to_numpy(zero_copy_only=False)
                worded = sizes > 0
                logit = np.bincount(row, weights[at] * counts, n)[worded] / length[worded]
                logit += weights[variety[worded]] + weights[-1]
                values[worded] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    source = seen.select("doc_id", "at", "counts", "variety")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scored, f"doc_id {kind}, score double").withColumn("kept", F.col("score") >= 0.5)


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[LabelModel, np.ndarray] | None:
    """:func:`fit_described` of documents."""
    return fit_described(described(docs), fit_rows)


def score(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """:func:`score_described` of documents, which need not be those of the fit."""
    return score_described(described(docs), weights)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score (0 to 1, higher is better) and kept of every document. Texts are read
    once; the fit and the scores use what that reading wrote."""
    seen = described(table(spark, sf_dir, "documents"))
    fitted = fit_described(seen)
    return score_described(seen, fitted[1] if fitted else None)
