"""SentencePiece encoding and decoding by suffix-array matching.

A text becomes units: a run of word marks (for spaces) with the word behind it. No piece of
the vocabulary crosses units. The new units of a batch are joined to one text, whose suffix
array is built as deep as the longest piece. A binary search per piece gives the range of
suffixes that begin with it, and so all its places: the edges. Edges are sorted by position,
and each unit is relaxed over its edges. The model is a byte-pair one, so relaxing means: of
the edges that join two neighbouring symbols, the one with the best score (the leftmost of
equal ones) is taken, until none is left; the sum of scores along a path has no meaning in
such a model. A character without a piece becomes its bytes. Units met before are remembered.

Defined cases: a null or empty text has no ids; repeated rows get equal ids; a unit of any
length is encoded whole; an empty table gives no rows; columns other than id and text are
ignored. Decoding gives back the text exactly, unless it holds the mark itself, which the
model reads as a space.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roostline.llm.common import Memo, bounded_batches, table, texts, worker_cache

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# Longer units are relaxed one by one with a queue, shorter ones all at once.
SHORT_UNIT = 64
# Between units in the joined text: no character.
BORDER = 0x110000
# Leading characters that are compared as one number, of so many bits each.
LEAD, CODE_BITS = 3, 21


class Vocabulary:
    """Pieces, their ids and scores, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [
            i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.control = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        # What each id stands for in a decoded text.
        self.spelled = [
            b"" if i in self.control else bytes((int(p[3:5], 16),)) if model.is_byte(i) else p.encode()
            for i, p in enumerate(self.pieces)
        ]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses words")
        # Rank of a piece: the better its score, the smaller.
        long = [i for i in normal if len(self.pieces[i]) > 1]
        self.long_ids = np.array(sorted(long, key=lambda i: (-model.get_score(i), i)), np.int64)
        scores = np.array([model.get_score(int(i)) for i in self.long_ids])
        self.ranks = np.searchsorted(-scores, -scores, "left")
        self.lengths = np.array([len(self.pieces[i]) for i in self.long_ids], np.int64)
        self.depth = int(self.lengths.max(initial=1))
        self.table = np.zeros((len(self.long_ids), self.depth), np.int64)
        for row, i in enumerate(self.long_ids):
            piece = self.pieces[i]
            self.table[row, : len(piece)] = [ord(c) for c in piece]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the next ``depth`` characters, by doubling of known ranks."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    known = 1
    while known < depth:
        behind = np.zeros_like(rank)
        behind[:-known] = rank[known:] + 1
        rank = np.unique(rank * (len(rank) + 2) + behind, return_inverse=True)[1].astype(np.int64)
        known *= 2
    return np.argsort(rank, kind="stable")


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, lengths: np.ndarray):
    """Per piece the range of the suffix array whose suffixes begin with it. A first binary
    search compares up to three leading characters, as one number; a second one goes on with
    the others, inside the range of the first."""
    depth = pieces.shape[1]
    padded = np.concatenate([codes, np.full(depth, -1, np.int64)])
    lead = min(LEAD, depth)
    keys = np.zeros(len(order), np.int64)
    wanted_keys = np.zeros(len(pieces), np.int64)
    for k in range(lead):
        keys = keys << CODE_BITS | (padded[order + k] + 1)
        wanted_keys = wanted_keys << CODE_BITS | np.where(k < lengths, pieces[:, k] + 1, 0)
    # So many keys begin with a piece that is shorter than the key.
    alike = np.int64(1) << CODE_BITS * (lead - np.minimum(lengths, lead))
    low = np.searchsorted(keys, wanted_keys)
    high = np.searchsorted(keys, wanted_keys + alike)
    columns = np.arange(lead, depth)
    longer = np.flatnonzero((lengths > lead) & (low < high))

    def first(low: np.ndarray, high: np.ndarray, after_equal: bool) -> np.ndarray:
        """The first suffix not below its piece, or above all that begin with it."""
        low, high = low.copy(), high.copy()
        while True:
            open_rows = np.flatnonzero(low < high)
            if not len(open_rows):
                return low
            middle = (low[open_rows] + high[open_rows]) // 2
            window = padded[order[middle][:, None] + columns]
            wanted = pieces[longer[open_rows], lead:]
            differs = (window != wanted) & (columns < lengths[longer[open_rows], None])
            at = differs.argmax(axis=1)
            row = np.arange(len(at))
            some = differs[row, at]
            below = np.where(some, window[row, at] < wanted[row, at], after_equal)
            low[open_rows[below]] = middle[below] + 1
            high[open_rows[~below]] = middle[~below]

    if len(longer):
        begin = first(low[longer], high[longer], False)
        high[longer] = first(begin, high[longer], True)
        low[longer] = begin
    return low, high


def edges(codes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and piece (its row in the vocabulary's table) of every place of a piece of
    two or more characters, sorted by position."""
    order = suffix_array(codes, vocabulary.depth)
    low, high = occurrences(codes, order, vocabulary.table, vocabulary.lengths)
    counts = high - low
    piece = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = order[np.repeat(low, counts) + inner]
    sort = np.lexsort((vocabulary.lengths[piece], begin))
    begin, piece = begin[sort], piece[sort]
    return begin, begin + vocabulary.lengths[piece], piece


def relax(length: int, joins: dict[tuple[int, int], tuple[int, int]]) -> list[tuple[int, int]]:
    """Borders (begin, end) of the symbols of a unit. ``joins`` gives the rank and the id of
    the piece between two borders."""
    after = list(range(1, length + 1))
    before = list(range(-1, length - 1))
    waiting = []
    for i in range(length - 1):
        if (i, i + 2) in joins:
            waiting.append((joins[i, i + 2][0], i, i + 1, i + 2))
    heapq.heapify(waiting)
    live = [True] * length
    # after[i] is where the symbol that begins at i ends.
    while waiting:
        _, left, middle, end = heapq.heappop(waiting)
        if not live[left] or not live[middle] or after[left] != middle or after[middle] != end:
            continue
        live[middle] = False
        after[left] = end
        if end < length:
            before[end] = left
            key = (left, after[end])
            if key in joins:
                heapq.heappush(waiting, (joins[key][0], left, end, after[end]))
        previous = before[left]
        if previous >= 0:
            key = (previous, end)
            if key in joins:
                heapq.heappush(waiting, (joins[key][0], previous, left, end))
    symbols = []
    at = 0
    while at < length:
        symbols.append((at, after[at]))
        at = after[at]
    return symbols


def relax_all(begin, end, ranks, starts, lengths, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Borders of the symbols of many units at once, as (begins, ends) arrays in parts.

    ``begin``, ``end`` and ``ranks`` are the edges sorted by position; a unit lies at its start
    with its length. In each round every unit takes its best join; finished units leave.
    """
    none = np.iinfo(np.int64).max
    keys = begin * (depth + 1) + end - begin
    owner = np.repeat(np.arange(len(starts)), lengths)
    first = np.repeat(starts, lengths) + np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    last = first + 1

    def rank_of(k: np.ndarray) -> np.ndarray:
        """Ranks of the joins of symbols k and k + 1."""
        found = np.full(len(k), none, np.int64)
        inside = np.flatnonzero(k + 1 < len(first))
        inside = inside[owner[k[inside]] == owner[k[inside] + 1]]
        size = last[k[inside] + 1] - first[k[inside]]
        inside, size = inside[size <= depth], size[size <= depth]
        wanted = first[k[inside]] * (depth + 1) + size
        at = np.searchsorted(keys, wanted)
        hit = at < len(keys)
        hit[hit] = keys[at[hit]] == wanted[hit]
        found[inside[hit]] = ranks[at[hit]]
        return found

    done: list[tuple[np.ndarray, np.ndarray]] = []
    best = rank_of(np.arange(len(first)))
    while len(first):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(best, heads)
        sizes = np.diff(np.r_[heads, len(first)])
        open_unit = np.repeat(least != none, sizes)
        if not open_unit.all():
            done.append((first[~open_unit], last[~open_unit]))
            first, last, owner, best = first[open_unit], last[open_unit], owner[open_unit], best[open_unit]
            if not len(first):
                break
            sizes = sizes[least != none]
            least = least[least != none]
            heads = np.cumsum(sizes) - sizes
        # The leftmost of the best joins of each unit.
        equal = np.flatnonzero(best == np.repeat(least, sizes))
        chosen = equal[np.searchsorted(equal, heads)]
        last[chosen] = last[chosen + 1]
        stay = np.ones(len(first), bool)
        stay[chosen + 1] = False
        first, last, owner, best = first[stay], last[stay], owner[stay], best[stay]
        merged = chosen - np.arange(len(chosen))
        best[merged] = rank_of(merged)
        before = merged[merged > 0] - 1
        best[before] = rank_of(before)
    return done


class Pieces:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.memo = Memo(self._encode_units, 300_000)

    def _single(self, letter: str) -> list[int]:
        known = self.vocabulary.ids.get(letter)
        if known is not None:
            return [known]
        return [self.vocabulary.bytes[b] for b in letter.encode("utf-8", "replace")]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        result: list[bytes] = []
        group: list[str] = []
        size = 0
        for n, unit in enumerate(units):
            group.append(unit)
            size += len(unit) + 1
            if size >= 300_000 or n == len(units) - 1:
                result += self._encode_group(group)
                group, size = [], 0
        return result

    def _encode_group(self, units: list[str]) -> list[bytes]:
        v = self.vocabulary
        lengths = np.array([len(u) for u in units], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        joined = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.full(int(lengths.sum()) + len(units), BORDER, np.int64)
        codes[np.arange(len(joined)) + np.repeat(np.arange(len(units)), lengths)] = joined
        begin, end, piece = edges(codes, v)
        short = lengths <= SHORT_UNIT
        symbols = relax_all(begin, end, v.ranks[piece], starts, np.where(short, lengths, 0), v.depth)
        for n in np.flatnonzero(~short).tolist():
            a, b = np.searchsorted(begin, (starts[n], starts[n] + lengths[n]))
            joins = {
                (x, y): (r, 0)
                for x, y, r in zip(
                    (begin[a:b] - starts[n]).tolist(), (end[a:b] - starts[n]).tolist(), v.ranks[piece[a:b]].tolist()
                )
            }
            found = np.array(relax(int(lengths[n]), joins), np.int64) + starts[n]
            symbols.append((found[:, 0], found[:, 1]))
        first = np.concatenate([x for x, _ in symbols])
        last = np.concatenate([y for _, y in symbols])
        order = np.argsort(first)
        first, last = first[order], last[order]
        # Ids: of the edge between two borders, or of the one character.
        keys = begin * (v.depth + 1) + end - begin
        at = np.minimum(np.searchsorted(keys, first * (v.depth + 1) + last - first), max(len(keys) - 1, 0))
        letters, which = np.unique(codes[first], return_inverse=True)
        single = [self._single(chr(c)) for c in letters.tolist()]
        single_ids = np.array([x[0] if len(x) == 1 else -1 for x in single], np.int64)[which]
        ids = single_ids if not len(keys) else np.where(last - first > 1, v.long_ids[piece[at]], single_ids)
        bounds = np.searchsorted(first, [*starts.tolist(), len(codes)])
        raw = ids.astype("<u4").tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for n in np.unique(np.searchsorted(bounds, np.flatnonzero(ids < 0), "right") - 1).tolist():
            spelled: list[int] = []
            for k in range(bounds[n], bounds[n + 1]):
                spelled += [int(ids[k])] if ids[k] >= 0 else single[which[k]]
            out[n] = np.array(spelled, "<u4").tobytes()
        return out

    def encode(self, all_texts: list[str]) -> list[bytes]:
        result: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for n, text in enumerate(all_texts):
            group.append(UNIT.findall(MARK + text.replace(" ", MARK)) if text else [])
            size += len(group[-1])
            # One search per many texts, and never more units than the memo can hold.
            if size >= 200_000 or n == len(all_texts) - 1:
                known = self.memo.load(u for units in group for u in units)
                result += [b"".join(map(known.__getitem__, units)) for units in group]
                group, size = [], 0
        return result

    def decode(self, ids: bytes) -> str:
        parts = map(self.vocabulary.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist())
        text = b"".join(parts).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """The worker's coder of a model file, kept between tasks."""
    kept = worker_cache("pieces")
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text and ids (little-endian unsigned 32-bit) of every document."""
    bounded_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(path)
        for batch in batches:
            ids = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(encode, f"doc_id {kind}, text string, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, text, ids) with the decoded text in place of the ids, and their
    number and checksum."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([coder.decode(i) for i in ids], pa.string()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                ],
                ["doc_id", "text", "decoded", "n_tokens", "ids_crc32"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(
        decode, f"doc_id {kind}, text string, decoded string, n_tokens bigint, ids_crc32 bigint"
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: number and checksum of its ids, and whether the
    decoded text is the text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = decode_documents(encode_documents(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", "n_tokens", "ids_crc32", (F.col("decoded") == F.col("text")).alias("round_trip")
    )
