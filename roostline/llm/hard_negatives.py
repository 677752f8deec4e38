"""Hard-negative mining by segment summaries.

A vector is cut into 1, 2, 4 and 8 segments, and the mean and deviation of each are stored beside
it. Over a segment of length L an inner product lies within L (mean x mean' +- dev x dev'), so
the sums over a level's segments bound a score from both sides, more tightly from level to level.

The vectors are stored once, with their summaries, in ranges of label and mean. Anchors are taken a
bounded number at a time and sent to the stored rows, which stay where they are. A task walks over
its rows in blocks. The ranges of a block's summaries rule out whole anchors, each level of bounds
rules out pairs, anchors and rows, and what is left is scored exactly, in integers. The best rows so
far tighten the bounds on the way: for positives the lowest score that still counts, for negatives
the open part of each positive's window. The best few of each task are merged at the end.

Defined cases: rows without an id or a label, and vectors that are null or hold null or non-finite
components, take no part; a repeated id counts once, with its smallest label and vector; vectors of
different lengths never meet; an empty vector scores 0; copies and equal scores are ordered by the
id; vectors whose scaled length is 2^31 or more take no part, as their scores are no long; fewer
rows than asked give fewer; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.functions.amenities import quoted
from roostline.llm.common import bounded_batches, table, written
from roostline.session import remove_scratch, scratch_dir

POSITIVES = 5
NEGATIVES = 5
# A negative's score lies within this part of the positive's, in hundredths.
LOWEST, HIGHEST = 80, 100
SCALE = 256
LEVELS = (1, 2, 4, 8)
SLICES = [slice(sum(LEVELS[:i]), sum(LEVELS[: i + 1])) for i in range(len(LEVELS))]
SEGMENTS = sum(LEVELS)
# Anchors sent to the tasks at a time, by number and by bytes of their vectors.
ANCHORS_AT_ONCE = 4096
ANCHOR_BYTES = 16 << 20
# Anchors and rows of one matrix of bounds.
ANCHOR_BLOCK, ROW_BLOCK = 512, 2048
# Above this share of pairs left, a block is scored as a whole.
DENSE = 0.1
ENDLESS = float("inf")


def lengths(dim: int) -> np.ndarray:
    """The lengths of all segments, level after level."""
    edges = [np.arange(s + 1) * dim // s for s in LEVELS]
    return np.concatenate([np.diff(e) for e in edges]).astype(float)


def summarize(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of each vector."""
    n, dim = vectors.shape
    means, deviations = np.zeros((n, SEGMENTS)), np.zeros((n, SEGMENTS))
    place = 0
    for segments in LEVELS:
        edges = np.arange(segments + 1) * dim // segments
        for a, b in zip(edges, edges[1:]):
            if b > a:
                part = vectors[:, a:b].astype(float)
                means[:, place] = part.mean(axis=1)
                deviations[:, place] = part.std(axis=1)
            place += 1
    return means, deviations


class Side:
    """Vectors of one length with their ids, labels and summaries."""

    def __init__(self, ids, labels, vectors, means, deviations):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.means, self.deviations = means, deviations
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))

    def take(self, which) -> Side:
        return Side(
            self.ids[which], self.labels[which], self.vectors[which], self.means[which], self.deviations[which]
        )

    @classmethod
    def by_length(cls, columns: dict) -> dict[int, Side]:
        """One side per vector length, from columns of stored rows."""
        dims = np.asarray(columns["dim"])
        sides = {}
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)

            def matrix(name, kind, width):
                raw = b"".join(columns[name][i] for i in rows)
                return np.frombuffer(raw, kind).reshape(len(rows), width)

            sides[dim] = cls(
                np.asarray(columns["vec_id"], np.int64)[rows],
                np.asarray(columns["label"], np.int64)[rows],
                matrix("vector", "<i8", dim),
                matrix("means", "<f8", SEGMENTS),
                matrix("deviations", "<f8", SEGMENTS),
            )
        return sides


def surviving(anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, allowed: np.ndarray):
    """Numbers of anchors and of rows, and the matrix of their allowed pairs whose score may lie
    within [low, high] of the anchor."""
    size = lengths(rows.vectors.shape[1])
    # Bounds are rounded, scores are not: give way by far more than the rounding.
    slack = 1e-6 + 1e-9 * anchors.norms * rows.norms.max()
    low, high = low - slack, high + slack
    finest = SLICES[-1]
    scaled, spread = anchors.means[:, finest] * size[finest], anchors.deviations[:, finest] * size[finest]
    least, most = rows.means[:, finest].min(axis=0), rows.means[:, finest].max(axis=0)
    widest = spread @ rows.deviations[:, finest].max(axis=0)
    upper = np.maximum(scaled * least, scaled * most).sum(axis=1) + widest
    lower = np.minimum(scaled * least, scaled * most).sum(axis=1) - widest
    left = np.flatnonzero((upper >= low) & (lower <= high) & allowed.any(axis=1))
    at, mask = np.arange(len(rows.ids)), allowed[left]
    for level in SLICES:
        if not mask.any():
            return left[:0], at[:0], mask[:0, :0]
        middle = (anchors.means[left, level] * size[level]) @ rows.means[at, level].T
        apart = (anchors.deviations[left, level] * size[level]) @ rows.deviations[at, level].T
        mask = mask & (middle + apart >= low[left, None]) & (middle - apart <= high[left, None])
        some, any_row = mask.any(axis=1), mask.any(axis=0)
        left, at, mask = left[some], at[any_row], mask[some][:, any_row]
    return left, at, mask


def exact(anchors: Side, rows: Side, left, at, mask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs of the mask. Floating point is used where it is exact."""
    a, r = np.nonzero(mask)
    if len(a) > DENSE * mask.size:
        one, two = anchors.vectors[left], rows.vectors[at]
        if anchors.norms.max() * rows.norms.max() < 2.0**52:
            product = np.rint(one.astype(float) @ two.T.astype(float)).astype(np.int64)
        else:
            product = one @ two.T
        return left[a], at[r], product[a, r]
    scores = np.empty(len(a), np.int64)
    for start in range(0, len(a), 1 << 15):
        part = slice(start, start + (1 << 15))
        scores[part] = (anchors.vectors[left[a[part]]] * rows.vectors[at[r[part]]]).sum(axis=1)
    return left[a], at[r], scores


class Best:
    """The first ``keep`` (score, id) of each owner: higher scores first, ties by smaller ids."""

    def __init__(self, owners: int, keep: int):
        self.keep = keep
        self.owner = self.score = self.ids = np.zeros(0, np.int64)
        # The lowest score that may still enter.
        self.least = np.full(owners, -ENDLESS)

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        owner, score = np.concatenate([self.owner, owner]), np.concatenate([self.score, score])
        ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
        place = np.arange(len(owner)) - np.repeat(new, np.diff(np.r_[new, len(owner)]))
        kept = place < self.keep
        self.owner, self.score, self.ids = owner[kept], score[kept], ids[kept]
        last = place == self.keep - 1
        self.least[owner[last]] = score[last]


def blocks(batches, sides: dict[int, Side]):
    """(anchors, numbers of these anchors, rows) of every block of rows with anchors of its length."""
    for batch in batches:
        for dim, rows in Side.by_length(batch.to_pydict()).items():
            anchors = sides.get(dim)
            for start in range(0, len(rows.ids) if anchors is not None else 0, ROW_BLOCK):
                part = rows.take(slice(start, start + ROW_BLOCK))
                for first in range(0, len(anchors.ids), ANCHOR_BLOCK):
                    numbers = np.arange(first, min(first + ANCHOR_BLOCK, len(anchors.ids)))
                    yield dim, anchors.take(numbers), numbers, part


def nearest_of_label(sides, keep: int):
    """A task's best rows of each anchor's label."""

    def search(batches):
        import pyarrow as pa

        found = {dim: Best(len(s.ids), keep) for dim, s in sides.value.items()}
        for dim, anchors, numbers, rows in blocks(batches, sides.value):
            best = found[dim]
            allowed = (anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids)
            low = best.least[numbers]
            left, at, mask = surviving(anchors, rows, low, np.full(len(low), ENDLESS), allowed)
            a, r, score = exact(anchors, rows, left, at, mask)
            best.add(numbers[a], score, rows.ids[r])
        for dim, best in found.items():
            owner = sides.value[dim].ids[best.owner]
            yield pa.RecordBatch.from_pydict({"anchor_id": owner, "positive_id": best.ids, "score": best.score})

    return search


class Windows:
    """The scores that negatives may have, for each different positive score of each anchor."""

    def __init__(self, side: Side, tops: dict, width: int, lowest: int, highest: int):
        shape = (len(side.ids), width)
        self.positive, self.known = np.zeros(shape, np.int64), np.zeros(shape, bool)
        self.least, self.most = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for n, anchor in enumerate(side.ids.tolist()):
            for column, top in enumerate(tops.get(anchor, ())):
                self.positive[n, column], self.known[n, column] = top, True
                self.least[n, column] = -(-lowest * top // 100)
                self.most[n, column] = highest * top // 100


def nearest_below(sides, windows, keep: int):
    """A task's best rows of other labels within the windows of each anchor's positives."""

    def search(batches):
        import pyarrow as pa

        found = {dim: Best(w.known.size, keep) for dim, w in windows.value.items()}
        for dim, anchors, numbers, rows in blocks(batches, sides.value):
            window, best = windows.value[dim], found[dim]
            known, width = window.known[numbers], window.known.shape[1]
            if not known.any():
                continue
            entry = best.least.reshape(-1, width)[numbers]
            opened = np.where(known, np.maximum(entry, window.least[numbers]), ENDLESS)
            closed = np.where(known, window.most[numbers], -ENDLESS)
            allowed = (anchors.labels[:, None] != rows.labels) & (anchors.ids[:, None] != rows.ids)
            left, at, mask = surviving(anchors, rows, opened.min(axis=1), closed.max(axis=1), allowed)
            a, r, score = exact(anchors, rows, left, at, mask)
            # Entry scores are floating point; give way by more than their rounding.
            entry = entry - 1 - 1e-9 * np.abs(np.where(np.isfinite(entry), entry, 0))
            for column in range(width):
                inside = known[a, column] & (score >= entry[a, column])
                inside &= (score >= window.least[numbers[a], column]) & (score <= window.most[numbers[a], column])
                best.add(numbers[a[inside]] * width + column, score[inside], rows.ids[r[inside]])
        for dim, best in found.items():
            window = windows.value[dim]
            anchor, column = np.divmod(best.owner, window.known.shape[1])
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor_id": sides.value[dim].ids[anchor],
                    "positive_score": window.positive[anchor, column],
                    "negative_id": best.ids,
                    "score": best.score,
                }
            )

    return search


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label and the scaled whole-number vector of the rows that take part."""
    parts = quoted(vector_column).cast("array<double>")
    rows = vectors.select(
        quoted(id_column).cast("bigint").alias("vec_id"),
        quoted(label_column).cast("bigint").alias("label"),
        parts.alias("parts"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("parts").isNotNull())
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(ENDLESS)))
    squares = F.aggregate(
        "parts", F.lit(0.0), lambda s, x: s + (F.abs(x) * SCALE + 1) * (F.abs(x) * SCALE + 1)
    )
    scaled = F.transform("parts", lambda x: F.floor(x * F.lit(float(SCALE))))
    return (
        rows.filter(finite)
        .filter(squares < F.lit(2.0**62))
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", scaled.alias("vector"))).alias("row"))
        .select("vec_id", "row.label", "row.vector")
    )


def stored(rows: DataFrame) -> DataFrame:
    """The table of vectors with their summaries, in ranges of length, label and mean."""

    def add(batches):
        import pyarrow as pa

        for batch in batches:
            vectors = batch.column("vector")
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<i8")
            starts = np.r_[0, np.cumsum(dims)]
            means, deviations = np.zeros((len(dims), SEGMENTS)), np.zeros((len(dims), SEGMENTS))
            for dim in np.unique(dims):
                which = np.flatnonzero(dims == dim)
                matrix = flat[starts[which][:, None] + np.arange(dim)]
                means[which], deviations[which] = summarize(matrix)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "dim": pa.array(dims.astype(np.int32)),
                    "mean": pa.array(means[:, 0]),
                    "vector": pa.array([flat[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary()),
                    "means": pa.array([m.tobytes() for m in means], pa.binary()),
                    "deviations": pa.array([d.tobytes() for d in deviations], pa.binary()),
                }
            )

    schema = "vec_id bigint, label bigint, dim int, mean double, vector binary, means binary, deviations binary"
    order = ["dim", "label", "mean", "vec_id"]
    summarized = rows.mapInArrow(add, schema)
    return written(summarized.repartitionByRange(*order).sortWithinPartitions(*order), "segment-summaries")


def ranked(found: DataFrame, group: list[str], by: str, keep: int) -> DataFrame:
    best = Window.partitionBy(*group).orderBy(F.desc("score"), by)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)


def mine(
    vectors: DataFrame,
    anchors_where: str,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for every row
    that satisfies ``anchors_where`` (over vec_id): its best rows of the same label, and for each
    of them the best rows of other labels between ``lowest`` and ``highest`` hundredths of its score.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = stored(usable(vectors, id_column, vector_column, label_column))
    chosen = rows.filter(anchors_where)
    count, parts = chosen.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    rounds = max(1, -(-count // anchors_at_once), -(-parts * 8 // ANCHOR_BYTES))
    # A fixed hash deals the anchors to rounds of about equal size.
    turn = F.pmod(F.xxhash64("vec_id"), F.lit(rounds)).cast("int")
    dealt_folder, near_folder, far_folder = (scratch_dir(spark, f"mining-{n}") for n in ("anchors", "near", "far"))
    dealt = chosen.withColumn("turn", turn)
    dealt.write.partitionBy("turn").parquet(dealt_folder)
    near_schema = "anchor_id bigint, positive_id bigint, score bigint"
    far_schema = "anchor_id bigint, positive_score bigint, negative_id bigint, score bigint"
    for number in range(rounds if count else 0):
        part = spark.read.schema(dealt.schema).parquet(dealt_folder).filter(F.col("turn") == number)
        sides = Side.by_length(part.toArrow().to_pydict())
        if not sides:
            continue
        sent = spark.sparkContext.broadcast(sides)
        near = rows.mapInArrow(nearest_of_label(sent, positives), near_schema)
        near = written(ranked(near, ["anchor_id"], "positive_id", positives).drop("rank"), "mining-positives")
        near.write.parquet(f"{near_folder}/round={number}")
        tops = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set("score")).alias("tops")).collect()
        own = {r["anchor_id"]: r["tops"] for r in tops}
        windows = spark.sparkContext.broadcast(
            {dim: Windows(side, own, positives, lowest, highest) for dim, side in sides.items()}
        )
        far = rows.mapInArrow(nearest_below(sent, windows, negatives), far_schema)
        ranked(far, ["anchor_id", "positive_score"], "negative_id", negatives).write.parquet(
            f"{far_folder}/round={number}"
        )
        sent.destroy()
        windows.destroy()
    remove_scratch(spark, dealt_folder)
    if not count:
        return spark.createDataFrame(
            [],
            "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
            "negative_score bigint",
        )
    near = spark.read.schema(near_schema).parquet(near_folder)
    far = spark.read.schema(far_schema + ", rank int").parquet(far_folder)
    pairs = near.select("anchor_id", "positive_id", F.col("score").alias("positive_score"))
    return pairs.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), "vec_id % 100 = 0")


OP11_SQL = """
WITH labelled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vectors AS (
  SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, vector) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.vector, r.vector), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id AND len(a.vector) = len(r.vector)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN (SELECT * FROM scored WHERE NOT same) n USING (anchor_id)
WHERE 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
