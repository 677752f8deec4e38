"""Similarity join on word shingles with signature trees.

Two documents link when the Jaccard similarity of their sets of five-word shingles is 0.8 or
more. Equal sets are one class. Classes that can have a partner are found by counting:

1. A class and a partner share all but a fifth of its shingles, so among its smallest hashes
   (three tenths of the set) a known number must occur in another class. Few classes pass.
2. Of those the whole sets are taken, and each keeps, rarest first, the shingles that a
   partner cannot all miss. Classes that share one of these are in one candidate group.
3. Groups are cut into blocks of sets alike in size and least hash. Of each block the OR and
   the AND of its members' token bitmaps and their range of sizes are kept, and pairs of blocks
   whose greatest possible overlap is too small are dropped before any set moves.
4. A task takes two blocks (or a block with itself, or many small groups) and builds a signature
   tree of each, whose nodes hold the same of their members. A traversal of both trees at once
   drops pairs of nodes by the same bound; pairs of sets that remain are compared exactly.

All pairs that could link meet in one task, so the components are exact, up to equal 64-bit
hashes of different shingles or sets. The query compares every pair that the traversal keeps and
sums the links of each class where they are found, a class weighing as many rows as it has; so
counts are shuffled and not pairs. The pipeline needs components alone: there a pair whose
members are already connected is not compared. Links themselves are returned as far as they
connect something new in their task.

Defined cases: a null or empty text has an empty set and links with nothing, its component is
its own doc_id; n_links counts all other rows that a row links with, its copies and rows
without a doc_id among them; texts under five words are one shingle; repeated rows belong to one component;
rows without a doc_id join their component, whose id is the smallest doc_id that is not null;
an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.llm.common import (
    Memo,
    bounded_batches,
    fresh_name,
    hash_words,
    mixed,
    table,
    texts,
    window_hashes,
    written,
)
from roostline.llm.components import connected_components
from roostline.operators import running
from roostline.session import scratch_scope

SHINGLE = 5
# Link when PART_OF * intersection >= PARTS * union.
PARTS, PART_OF = 4, 5
SLACK = 10
# Bits of the filter that spares most texts the second reading: 8 MB whatever the input. Above
# some tens of millions of classes it lets more texts through, which the join after it removes.
FILTER_BITS = 26
BLOCK = 512
# Bits of the bitmaps of blocks.
BLOCK_BITS = 4096
# Sizes of sets that link differ by a factor of 1.25 at most, so they lie in one band of this
# width or in neighbouring ones.
BAND = 1.3
# Shingles compared with one set at a time.
COMPARED = 1 << 20
FANOUT = 8


def shingle_set(found: list[bytes], hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles, or of the whole short sequence."""
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter((hashes[w] for w in found), np.uint64, len(found))
    size = min(SHINGLE, len(found))
    windows = window_hashes(ids, size)
    return np.unique(mixed(windows + np.uint64(size)))


def least_overlap(n):
    """Shingles that a set of n shares with any partner, at least."""
    return -(-n * PARTS // PART_OF)


def prefix_size(n: int) -> int:
    return min(n, n - least_overlap(n) + 1 + n // SLACK)


def needed_shared(n: int) -> int:
    """Shingles of the prefix that a partner's prefix holds too: the first common shingles are
    within both prefixes, as many as the smaller possible partner's slack allows."""
    return 1 + least_overlap(n) // SLACK


def _sets(batches: Iterator[pa.RecordBatch], memo: Memo):
    """Each batch with the sets of its texts."""
    for batch in batches:
        found = [t.encode("utf-8", "surrogatepass").lower().split() for t in batch.column("text").to_pylist()]
        sets = []
        for words in found:
            sets.append(shingle_set(words, memo.load(words)))
        yield batch, sets


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(tokens) & 0xFFFF) - (1 << 63)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def prefixes(docs: DataFrame) -> DataFrame:
    """Per document: the key of its class, the size of its set and the prefix of the set."""

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, Memo(hash_words)):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([s[: prefix_size(len(s))] for s in sets]),
                ],
                ["doc_id", "text_hash", "class", "n", "prefix"],
            )

    source = texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(
        source.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            prepared, "doc_id bigint, text_hash bigint, class bigint, n bigint, prefix array<bigint>"
        ),
        "shingle-prefixes",
    )


def suspects(prefixed: DataFrame) -> DataFrame:
    """Classes that share enough of their prefix with other classes, each with the hash of one
    of its texts."""
    tokens = prefixed.filter("n > 0").select("class", F.explode("prefix").alias("token"))
    shared = (
        tokens.groupBy("token")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .filter("low <> high")
        .select("token")
    )
    one = prefixed.filter("n > 0").groupBy("class").agg(
        F.min("text_hash").alias("text_hash"), F.max("n").alias("n")
    )
    # Copies repeat the rows of their class, so distinct pairs are counted.
    passing = (
        tokens.join(shared, "token")
        .distinct()
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    need = F.lit(1) + F.floor(F.ceil(F.col("n") * PARTS / PART_OF) / SLACK)
    return (
        one.join(passing, "class")
        .filter(F.col("shared") >= need)
        .select("class", "text_hash")
    )


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """One bit per value of the low bits of ``hash``; at most 2^20 words reach the driver."""
    slot = F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def whole_sets(docs: DataFrame, suspected: DataFrame) -> DataFrame:
    """(class, n, tokens) of the suspected classes. Texts are filtered where they are read;
    only sets are shuffled."""
    spark = docs.sparkSession
    marked = spark.sparkContext.broadcast(bit_filter(suspected.select(F.col("text_hash").alias("hash"))))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marked.value
        for batch in batches:
            low = batch.column("text_hash").to_numpy() & ((1 << FILTER_BITS) - 1)
            keep = (bits[low >> 6] >> (low & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(keep.astype(bool)))

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(chosen(batches), Memo(hash_words)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists(sets),
                ],
                ["class", "n", "tokens"],
            )

    source = texts(docs).select("text", F.xxhash64("text").alias("text_hash"))
    sets = source.mapInArrow(prepared, "class bigint, n bigint, tokens array<bigint>")
    known = sets.join(suspected.select("class"), "class", "left_semi")
    return written(known.dropDuplicates(["class"]), "shingle-sets")


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose connected components are the candidate groups.

    A shingle that only one class has comes first in the order of rarity, then the rarer ones.
    Of n shingles a partner misses at most n - least_overlap(n); the one after these must be
    reached among the common ones.
    """
    tokens = sets.select("class", "n", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    shared = tokens.join(often, "token")
    of_class = Window.partitionBy("class")
    ranked = shared.select(
        "class",
        "token",
        F.row_number().over(of_class.orderBy("often", "token")).alias("rank"),
        F.count(F.lit(1)).over(of_class).alias("common"),
        F.ceil(F.col("n") * PARTS / PART_OF).alias("least"),
    )
    kept = ranked.filter(F.col("rank") <= F.col("common") - F.col("least") + 1).select("class", "token")
    kept = written(kept, "rare-shingles")
    hubs = (
        kept.groupBy("token")
        .agg(F.min("class").alias("hub"), F.max("class").alias("other"))
        .filter("hub <> other")
        .select("token", "hub")
    )
    return (
        kept.join(hubs, "token")
        .filter("class <> hub")
        .select(F.col("class").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


class SignatureTree:
    """Levels of nodes over sets sorted by size: OR and AND bitmaps and the range of sizes.
    Level 0 holds the sets themselves."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        n = len(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        maps = np.zeros((n, bits // 8), np.uint8)
        for row, s in enumerate(sets):
            at = (s % np.uint64(bits)).astype(np.int64)
            np.bitwise_or.at(maps[row], at >> 3, (1 << (at & 7)).astype(np.uint8))
        words = maps.view(np.uint64)
        self.levels = [(words, words, sizes, sizes)]
        while len(self.levels[-1][2]) > 1:
            some, every, low, high = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(some, starts, axis=0),
                    np.bitwise_and.reduceat(every, starts, axis=0),
                    np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts),
                )
            )


def _possible(x, y, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of nodes can hold a link: the greatest overlap of two members, from sizes
    and from bits that all members of one node have and none of the other has."""
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 4096):
        a, b = i[at : at + 4096], j[at : at + 4096]
        low = x[2][a] + y[2][b]
        overlap = np.minimum(x[3][a], y[3][b])
        wide = overlap * (PARTS + PART_OF) >= low * PARTS
        a, b = a[wide], b[wide]
        missed = np.bitwise_count(x[1][a] & ~y[0][b]).sum(axis=1, dtype=np.int64)
        lacking = np.bitwise_count(y[1][b] & ~x[0][a]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(x[3][a] - missed, y[3][b] - lacking)
        keep[at + np.flatnonzero(wide)] = overlap * (PARTS + PART_OF) >= low[wide] * PARTS
    return keep


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return PART_OF * common >= PARTS * (len(a) + len(b) - common)


def kept_pairs(left: list[np.ndarray], right: list[np.ndarray] | None):
    """The pairs that a traversal keeps, as positions in the two trees, and for each tree its
    sets and their positions in the lists."""

    def planted(sets):
        order = sorted(range(len(sets)), key=lambda k: (len(sets[k]), int(sets[k][0])))
        return order, SignatureTree([sets[k] for k in order], bits)

    longest = max((len(s) for s in [*left, *(right or [])]), default=1)
    bits = int(np.clip(1 << (4 * longest - 1).bit_length(), 512, 1 << 15))
    within = right is None
    order_x, x = planted(left)
    order_y, y = (order_x, x) if within else planted(right)
    level_x, level_y = len(x.levels) - 1, len(y.levels) - 1
    i = j = np.zeros(1, np.int64)
    while True:
        keep = _possible(x.levels[level_x], y.levels[level_y], i, j)
        i, j = i[keep], j[keep]
        if level_x == level_y == 0 or not len(i):
            break
        # The higher tree goes down alone until both are level, then both at once.
        down_x, down_y = level_x >= level_y, level_y >= level_x
        step = np.arange(FANOUT)
        if down_x:
            level_x -= 1
            i, j = (i[:, None] * FANOUT + step).ravel(), np.repeat(j, FANOUT)
            real = i < len(x.levels[level_x][2])
            i, j = i[real], j[real]
        if down_y:
            level_y -= 1
            i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + step).ravel()
            real = j < len(y.levels[level_y][2])
            i, j = i[real], j[real]
        if within:
            ordered = i <= j
            i, j = i[ordered], j[ordered]
    if within:
        i, j = i[i < j], j[i < j]
    return i, j, x.sets, y.sets, order_x, order_y


def tree_links(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links between two lists of sets, or within one, that connect something new: their
    components are those of all links. Positions are those in the lists."""
    i, j, x_sets, y_sets, order_x, order_y = kept_pairs(left, right)
    within = right is None
    shift = 0 if within else len(left)
    component = np.arange(len(left) + (0 if within else len(right)))
    links = []
    pairs = np.stack([i, j + shift]) if len(i) else np.zeros((2, 0), np.int64)
    at = 0
    while at < pairs.shape[1]:
        a, b = int(pairs[0, at]), int(pairs[1, at])
        at += 1
        if component[a] == component[b]:
            continue
        if similar(x_sets[a], y_sets[b - shift]):
            links.append((order_x[a], order_y[b - shift]))
            component[component == component[b]] = component[a]
            rest = pairs[:, at:]
            pairs, at = rest[:, component[rest[0]] != component[rest[1]]], 0
    return links


def counted_links(
    left: list[np.ndarray], right: list[np.ndarray] | None, weights: np.ndarray, others: np.ndarray
) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Links as those of ``tree_links``, and for each set of both lists the summed weights of all
    sets that it links with. Every pair that the traversal keeps is compared."""
    i, j, x_sets, y_sets, order_x, order_y = kept_pairs(left, right)
    within = right is None
    # Positions in the lists; within one list both counts are the same array.
    at_x, at_y = np.asarray(order_x, np.int64), np.asarray(order_y, np.int64)
    counts = np.zeros(len(left), np.int64)
    opposite = counts if within else np.zeros(len(right), np.int64)
    shift = 0 if within else len(left)
    component = np.arange(len(left) + (0 if within else len(right)))
    sizes = np.array([len(s) for s in y_sets], np.int64)
    links = []
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
    for start, end in zip(starts, [*starts[1:], len(i)]):
        one, partners = int(i[start]), j[start:end]
        own = x_sets[one]
        common = np.empty(len(partners), np.int64)
        # So many shingles at a time, however large the sets are.
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes[partners]) // COMPARED)) + 1
        for part in np.split(np.arange(len(partners)), cuts):
            some = partners[part]
            flat = np.concatenate([y_sets[k] for k in some])
            at = np.searchsorted(own, flat)
            at[at == len(own)] = 0
            common[part] = np.add.reduceat((own[at] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes[some])[:-1]])
        linked = partners[PART_OF * common >= PARTS * (len(own) + sizes[partners] - common)]
        if not len(linked):
            continue
        a, b = at_x[one], at_y[linked]
        counts[a] += others[b].sum()
        opposite[b] += weights[a]
        labels, first = np.unique(component[b + shift], return_index=True)
        new = labels != component[a]
        links += [(int(a), int(k)) for k in b[first[new]]]
        component[np.isin(component, labels[new])] = component[a]
    return links, counts, opposite


def bitmaps(sets: DataFrame) -> DataFrame:
    """class, n, the least hash and the token bitmap of every set."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            flat = tokens.flatten().to_numpy().view(np.uint64)
            ends = tokens.offsets.to_numpy().astype(np.int64)
            ends -= ends[0]
            maps = np.zeros((len(batch), BLOCK_BITS // 8), np.uint8)
            at = (flat % np.uint64(BLOCK_BITS)).astype(np.int64)
            rows = np.repeat(np.arange(len(batch)), np.diff(ends))
            np.bitwise_or.at(maps, (rows, at >> 3), (1 << (at & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class"),
                    batch.column("n"),
                    pa.array(flat[ends[:-1]].view(np.int64)),
                    pa.array([m.tobytes() for m in maps], pa.binary()),
                ],
                ["class", "n", "least", "bits"],
            )

    return sets.select("class", "n", "tokens").mapInArrow(mapped, "class bigint, n bigint, least bigint, bits binary")


def band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(BAND))


def paired_blocks(sets: DataFrame, members: DataFrame, block: int) -> DataFrame:
    """Units of the groups of several blocks: every set by class with each pair of blocks
    (first, second) that its block (side) takes part in and that may hold a link."""
    mapped = members.join(bitmaps(sets), "class").withColumn("band", band(F.col("n")))
    order = [F.col(c) for c in ("band", "least", "n", "class")]
    placed = written(
        running(mapped, order, ["group"], "place").withColumn(
            "own", F.floor((F.col("place") - 1) / block).cast("bigint")
        ),
        "placed-sets",
    )

    def summed(frame):
        import pandas as pd

        maps = np.frombuffer(b"".join(frame["bits"]), "<i8").reshape(len(frame), -1)
        row = {
            "group": frame["group"].iloc[0],
            "own": frame["own"].iloc[0],
            "low": frame["n"].min(),
            "high": frame["n"].max(),
            "some": np.bitwise_or.reduce(maps, axis=0),
            "every": np.bitwise_and.reduce(maps, axis=0),
        }
        return pd.DataFrame([row])

    schema = "group bigint, own bigint, low bigint, high bigint, some array<bigint>, every array<bigint>"
    blocks = written(placed.groupBy("group", "own").applyInPandas(summed, schema), "block-signatures")
    pairs = written(possible_pairs(blocks), "block-pairs")
    sides = pairs.select("group", F.col("first").alias("own"), "first", "second").unionByName(
        pairs.filter("first <> second").select("group", F.col("second").alias("own"), "first", "second")
    )
    return placed.select("class", "group", "own").join(sides, ["group", "own"]).select(
        "class", "group", F.col("own").alias("side"), F.col("group").alias("unit"), "first", "second"
    )


def possible_pairs(blocks: DataFrame) -> DataFrame:
    """(group, first, second) of the blocks that can hold a link, by the bound of the trees.
    Blocks meet in the bands of their sizes, so those of distant sizes are never paired."""
    low, high = band(F.col("low")), band(F.col("high"))
    left = blocks.withColumn("band", F.explode(F.sequence(low, high)))
    right = blocks.select(
        "group",
        F.explode(F.sequence(low - 1, high + 1)).alias("band"),
        *[F.col(c).alias(f"{c}_2") for c in ("own", "low", "high", "some", "every")],
    )

    def missed(every: str, some: str) -> Column:
        lacking = F.zip_with(every, some, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))).cast("bigint"))
        return F.aggregate(lacking, F.lit(0).cast("bigint"), lambda total, x: total + x)

    overlap = F.least(F.col("high") - missed("every", "some_2"), F.col("high_2") - missed("every_2", "some"))
    return (
        left.join(right, ["group", "band"])
        .filter(F.col("own") <= F.col("own_2"))
        .filter(F.least("high", "high_2") * (PARTS + PART_OF) >= (F.col("low") + F.col("low_2")) * PARTS)
        .filter(overlap * (PARTS + PART_OF) >= (F.col("low") + F.col("low_2")) * PARTS)
        .select("group", F.col("own").alias("first"), F.col("own_2").alias("second"))
        .distinct()
    )


def block_links(sets: DataFrame, groups: DataFrame, block: int = BLOCK, counted: bool = False) -> DataFrame:
    """Links (a, b) between classes of one candidate group. ``groups`` holds (class, group).
    When ``counted``, ``sets`` has the number of ``copies`` of each class, and rows without b
    tell how many rows a class links with in a task (links; null in the rows of links).

    A group of several blocks has one task per pair of blocks that may hold a link; a set goes to
    the pairs of its block. Small groups share tasks.
    """
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    small = F.col("size") <= block
    n_small, n_large = sizes.agg(F.sum(F.when(small, F.col("size"))), F.count(F.when(~small, 1))).first()
    shared_units = max(1, (n_small or 0) // block)
    sized = groups.join(sizes, "group")
    alone = F.lit(-1).cast("bigint")
    units = sized.filter(small).select(
        "class",
        "group",
        alone.alias("side"),
        F.pmod(F.xxhash64("group"), F.lit(shared_units)).alias("unit"),
        alone.alias("first"),
        alone.alias("second"),
    )
    if n_large:
        units = units.unionByName(paired_blocks(sets, sized.filter(~small).select("class", "group"), block))
    copies = F.col("copies") if counted else F.lit(1).cast("bigint").alias("copies")
    rows = units.join(sets.select("class", "tokens", copies), "class")

    def joined(frame):
        import pandas as pd

        found, totals = [], []

        def links_of(left, right=None):
            """Links and, when counted, the totals of the sets at these positions of a part."""
            others = None if right is None else [sets_here[k] for k in right]
            if not counted:
                return tree_links([sets_here[k] for k in left], others)
            links, own, opposite = counted_links(
                [sets_here[k] for k in left], others, copies[left], copies[left if right is None else right]
            )
            sides = [(left, own)] if right is None else [(left, own), (right, opposite)]
            totals.extend((keys[k], n) for at, total in sides for k, n in zip(at, total) if n)
            return links

        for _, part in frame.groupby("group", sort=True):
            part = part.sort_values("class")
            keys, copies = part["class"].to_numpy(), part["copies"].to_numpy()
            sets_here = [np.asarray(t, np.int64).view(np.uint64) for t in part["tokens"]]
            first, second = int(part["first"].iloc[0]), int(part["second"].iloc[0])
            if first == second:
                found += [(keys[a], keys[b]) for a, b in links_of(np.arange(len(keys)))]
                continue
            side = part["side"].to_numpy()
            left, right = np.flatnonzero(side == first), np.flatnonzero(side == second)
            if len(left) and len(right):
                found += [(keys[left[a]], keys[right[b]]) for a, b in links_of(left, right)]
        links = pd.DataFrame(found, columns=["a", "b"], dtype="Int64")
        if not counted:
            return links
        sums = pd.DataFrame(totals, columns=["a", "links"], dtype="Int64")
        return pd.concat([links, sums]).reindex(columns=["a", "b", "links"]).astype("Int64")

    schema = "a bigint, b bigint" + ", links bigint" * counted
    return rows.groupBy("unit", "first", "second").applyInPandas(joined, schema)


def class_links(docs: DataFrame, prefixed: DataFrame, block: int = BLOCK, counted: bool = False) -> DataFrame:
    suspected = written(suspects(prefixed), "suspects")
    sets = whole_sets(docs, suspected)
    counts = copies_of(prefixed) if counted else None
    groups = connected_components(candidate_edges(sets), "candidate-groups").select(
        F.col("node").alias("class"), F.col("root").alias("group")
    )
    weighted = sets.join(counts, "class") if counted else sets
    return written(block_links(weighted, written(groups, "groups"), block, counted), "class-links")


def copies_of(prefixed: DataFrame) -> DataFrame:
    return prefixed.filter("n > 0").groupBy("class").agg(F.count(F.lit(1)).alias("copies"))


def grouped_rows(docs: DataFrame, block: int = BLOCK, counted: bool = False) -> DataFrame:
    """Every document row by doc_id and text_hash, with the size of its set, the least class
    of its component (root, null for empty sets) and the component's smallest doc_id; when
    ``counted``, with the number of rows it links with (null for empty sets)."""
    bounded_batches(docs.sparkSession)
    with scratch_scope(docs.sparkSession) as keep:
        prefixed = keep(prefixes(docs))
        named = keep(_named_classes(docs, prefixed, block, counted))
    return prefixed.select("doc_id", "text_hash", "class", "n").join(named, "class", "left").drop("class")


def _named_classes(docs: DataFrame, prefixed: DataFrame, block: int, counted: bool) -> DataFrame:
    """class, root, component_id and, when ``counted``, n_links of every class with shingles."""
    found = class_links(docs, prefixed, block, counted)
    links = found.filter("b is not null").select("a", "b")
    roots = connected_components(links, "linked-classes")
    classes = (
        prefixed.filter("n > 0")
        .groupBy("class")
        .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    )
    rooted = classes.join(roots, classes["class"] == roots["node"], "left").select(
        "class", "least", "copies", F.coalesce("root", "class").alias("root")
    )
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    kept = ["class", "root", "component_id"]
    named = rooted.join(components, "root")
    if counted:
        totals = found.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"))
        named = named.join(totals, F.col("class") == F.col("a"), "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0))
        )
        kept.append("n_links")
    return written(named.select(*kept), "class-roots")


def similar_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document."""
    return grouped_rows(docs, block, counted=True).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def one_per_group(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without words, and one row of each group: of its smallest doc_id.
    Columns of any name may be there."""
    with scratch_scope(docs.sparkSession) as keep:
        keys = keep(_group_members(docs, block))
    doc, text_hash, first, copies, key = (
        fresh_name(docs, name) for name in ("_doc", "_hash", "_first", "_copies", "_key")
    )
    keys = keys.withColumnsRenamed({"_doc": doc, "_hash": text_hash, "_first": first, "_copies": copies})
    source = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    known = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(text_hash))
    joined = source.join(keys, known, "left")
    own = [quoted(c) for c in docs.columns]
    one = F.col(first) & (F.col(copies) == 1)
    single = joined.filter(F.col(first).isNull() | one).select(*own)
    repeated = joined.filter(F.col(first) & (F.col(copies) > 1)).dropDuplicates([doc, text_hash])
    return single.unionByName(repeated.select(*own))


def _group_members(docs: DataFrame, block: int) -> DataFrame:
    """doc_id, text hash and copies of the rows of groups of several, and which one stays."""
    rows = written(grouped_rows(docs, block).filter("n > 0").drop("n", "component_id"), "grouped-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    several = (
        rows.groupBy("root")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("first"))
        .filter("rows > 1")
    )
    # Rows with equal doc_id and text are one key; `copies` tells how many they are.
    return written(
        rows.groupBy("root", "doc_id", "text_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(several, "root")
        .select(
            F.col("doc_id").alias("_doc"),
            F.col("text_hash").alias("_hash"),
            (order == F.col("first")).alias("_first"),
            F.col("copies").alias("_copies"),
        ),
        "group-members",
    )


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))
