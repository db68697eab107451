"""Hard negatives by rotated one-bit codes.

A row's vector is made of whole numbers. It is rotated (signs flipped at random, then a Hadamard
transform), and the signs of the result are its code: a unit vector u of the rotated cube's corners. The row keeps
the code and its alignment a = <x, u>; what is left, x - a u, is coded the same way by the next rotation, and after
``CODES`` codes the length of the remainder r is kept. All this is computed once and stored. For an anchor q

    <q, x> = sum a_i <q, u_i> + <q, r>,   |<q, r>| <= |q| |r|   (Cauchy-Schwarz),

so every score lies in a known interval. The inner products <q, u_i> are whole numbers over a
constant: they are counted exactly, bit plane by bit plane of the rotated anchor, by popcounts. Candidates
whose interval cannot reach the results are passed over; the others are scored in whole numbers. Results
are exact, the codes only save work.

Anchors and rows meet in tiles of blocks, twice: first for an anchor's positives, then, with their scores
known, for the negatives. A tile sends on only the best few of an anchor (and positive), and windows
merge the tiles' lists. No block holds one label or one vector only, so neither can overfill a tile.

Results in special cases: rows with a NULL id or label, a NULL vector, or a NULL or non-finite component take no part,
nor do rows with a component so large that scores might leave a long; every other row counts, also those that
repeat an id or a vector (a row is never its own positive); ties go to the smaller id; vectors of different length
are not compared, and those without components score 0; an anchor without positives gives no rows, nor does a positive without
negatives in its band; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import staged
from .batches import pick

POSITIVES, NEGATIVES = 5, 5
# A negative's score lies between LOWEST and HIGHEST hundredths of its positive's.
LOWEST, HIGHEST = 80, 100
CODES = 4
ANCHOR_TILE, ROW_TILE = 4096, 4096
# Scores of a tile held at once.
CELLS = 1 << 19
SEED = 20
# Relative error of double arithmetic in the intervals, far above what it can be.
SLACK = 1e-9
# Scores and their hundredfold fit in a long if no squared length is above this.
LARGEST = 1 << 55


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and vector (longs) of the rows that take part."""
    plain = pick(vectors, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    within = F.sqrt(F.lit(float(LARGEST)) / F.greatest(F.size("x"), F.lit(1)))
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale + 1 <= within)
    rows = plain.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("x", fits), F.lit(False)))
    return rows.select("vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("x"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


@lru_cache(maxsize=4)
def rotations(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The Hadamard matrix of the padded size, and the signs flipped before it by each rotation."""
    order = 64
    while order < size:
        order *= 2
    hadamard = np.ones((1, 1))
    while len(hadamard) < order:
        hadamard = np.block([[hadamard, hadamard], [hadamard, -hadamard]])
    return hadamard, np.random.default_rng(SEED).choice([-1.0, 1.0], (CODES, order))


def rotated(rows: np.ndarray, hadamard: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The rows times sqrt(order), rotated; whole numbers stay whole."""
    padded = np.zeros((len(rows), len(hadamard)))
    padded[:, : rows.shape[1]] = rows
    return (padded * signs) @ hadamard


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


class Codes:
    """One-bit codes of rows, the alignment of each, the length of what they leave, and that of the rows."""

    def __init__(self, words: np.ndarray, alignment: np.ndarray, remainder: np.ndarray, length: np.ndarray):
        self.words, self.alignment, self.remainder, self.length = words, alignment, remainder, length

    @classmethod
    def of(cls, rows: np.ndarray) -> Codes:
        hadamard, signs = rotations(rows.shape[1])
        order = len(hadamard)
        rest = np.zeros((len(rows), order))
        rest[:, : rows.shape[1]] = rows
        words, alignment = [], []
        for flip in signs:
            turned = (rest * flip) @ hadamard  # sqrt(order) times the rotated remainder
            bits = turned >= 0
            corner = np.where(bits, 1.0, -1.0)  # sqrt(order) times the unit vector u
            words.append(packed(bits))
            alignment.append(np.abs(turned).sum(axis=1) / order)
            rest -= alignment[-1][:, None] * (corner @ hadamard) * flip / order
        return cls(np.stack(words, axis=1), np.stack(alignment, axis=1), np.linalg.norm(rest, axis=1), np.linalg.norm(rows.astype(float), axis=1))

    @classmethod
    def stored(cls, table: pa.Table) -> Codes:
        words = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint64).reshape(len(table), CODES, -1)
        return cls(words, _matrix(table["alignment"]), table["remainder"].to_numpy(), table["length"].to_numpy())


class Anchors:
    """Anchors as bit planes of their rotations."""

    def __init__(self, rows: np.ndarray):
        hadamard, signs = rotations(rows.shape[1])
        self.order = len(hadamard)
        self.length = np.linalg.norm(rows.astype(float), axis=1)
        self.planes, self.total = [], []
        for flip in signs:
            turned = rotated(rows, hadamard, flip).astype(np.int64)
            lowest = int(turned.min(initial=0))
            self.total.append(turned.sum(axis=1))
            raised = turned - lowest  # not negative: sum over set bits = sum of planes + lowest * set bits
            count = int(raised.max(initial=0)).bit_length()
            self.planes.append((lowest, [packed((raised >> b) & 1 == 1) for b in range(count)]))

    def intervals(self, part: slice, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of some anchors and all coded rows."""
        estimate = np.zeros((len(self.length[part]), len(codes.length)))
        for n, ((lowest, planes), total) in enumerate(zip(self.planes, self.total, strict=True)):
            words, alignment = codes.words[:, n], codes.alignment[:, n]
            # <turned, corner> = 2 * (sum where the bit is set) - sum of all
            inner = lowest * np.bitwise_count(words).sum(axis=1, dtype=np.int64)[None, :] + np.zeros(estimate.shape, np.int64)
            for b, plane in enumerate(planes):
                both = sum(np.bitwise_count(plane[part, w, None] & words[None, :, w]).astype(np.int64) for w in range(words.shape[1]))
                inner += both << b
            estimate += (2 * inner - total[part][:, None]) * (alignment / self.order)[None, :]
        width = self.length[part][:, None] * (codes.remainder + SLACK * codes.length)[None, :] + SLACK
        return estimate - width, estimate + width


CODED = "code binary, alignment array<double>, remainder double, length double"


def coded(rows: DataFrame) -> DataFrame:
    """The rows with their codes, alignments and lengths, in columns of their own."""
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(CODED).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = pc.list_value_length(table["x"])
            for size in pc.unique(sizes).to_pylist():
                part = table.filter(pc.equal(sizes, size))
                codes = Codes.of(_matrix(part["x"]))
                flat = pa.array(codes.alignment.ravel())
                added = [
                    pa.array([row.tobytes() for row in codes.words], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * CODES), flat),
                    pa.array(codes.remainder),
                    pa.array(codes.length),
                ]
                for column, values in zip(("code", "alignment", "remainder", "length"), added, strict=True):
                    part = part.append_column(column, values)
                yield from part.combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in whole numbers."""
    return np.einsum("ij,ij->i", left, right)


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def _best(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each anchor: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, anchor))
    anchor = anchor[order]
    return order[np.arange(len(order)) - np.searchsorted(anchor, anchor) < k]


def _scored(anchors: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The wanted pairs of a matrix of flags and their scores, in bounded pieces."""
    i, j = np.nonzero(wanted)
    step = max(1, CELLS // max(1, rows.shape[1]))
    parts = [scores(anchors[i[s : s + step]], rows[j[s : s + step]]) for s in range(0, len(i), step)]
    return i, j, np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _tile(asked: pa.Table, given: pa.Table) -> tuple:
    """Anchors and rows of a tile as (uid, label, vectors) each, with the ids of the rows and both sides' codes."""
    mine, theirs = _matrix(asked["x"]), _matrix(given["x"])
    uid, label = asked["uid"].to_numpy(), asked["label"].to_numpy()
    return uid, label, mine, given["uid"].to_numpy(), given["label"].to_numpy(), theirs, given["vec_id"].to_numpy(), Anchors(mine), Codes.stored(given)


def positive_tile(asked: pa.Table, given: pa.Table, k: int) -> pa.Table:
    """The k first rows of each anchor's label in the tile."""
    names = ["anchor", "vec_id", "score"]
    out = []
    if len(asked) and len(given):
        uid, label, mine, row_uid, row_label, theirs, ids, planes, codes = _tile(asked, given)
        step = max(1, CELLS // len(ids))
        for low in range(0, len(uid), step):
            part = slice(low, low + step)
            lower, upper = planes.intervals(part, codes)
            fit = (label[part][:, None] == row_label) & (uid[part][:, None] != row_uid)
            least = _kth_largest(np.where(fit, lower, -np.inf), k)
            i, j, score = _scored(mine[part], theirs, fit & (upper >= least[:, None]))
            first = _best(i, score, ids[j], k)
            out.append((uid[part][i[first]], ids[j[first]], score[first]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def negative_tile(asked: pa.Table, given: pa.Table, k: int, lowest: int, highest: int) -> pa.Table:
    """The k first rows of other labels in the band of each of the anchor's positive scores in the tile."""
    names = ["anchor", "positive_score", "vec_id", "score"]
    out = []
    if len(asked) and len(given):
        uid, label, mine, row_uid, row_label, theirs, ids, planes, codes = _tile(asked, given)
        goals = asked["goals"].to_pylist()
        most = max(map(len, goals))
        filled = np.array([g + [0] * (most - len(g)) for g in goals], dtype=np.int64)
        has = np.array([[n < len(g) for n in range(most)] for g in goals])
        step = max(1, CELLS // len(ids))
        for low in range(0, len(uid), step):
            part = slice(low, low + step)
            lower, upper = planes.intervals(part, codes)
            other = label[part][:, None] != row_label
            wanted = np.zeros(lower.shape, bool)
            for goal, here in zip(filled[part].T, has[part].T, strict=True):
                floor, ceiling = (goal * lowest / 100)[:, None], (goal * highest / 100)[:, None]
                near = other & here[:, None] & (upper >= floor - 1) & (lower <= ceiling + 1)
                surely = near & (lower >= floor + 1) & (upper <= ceiling - 1)
                least = _kth_largest(np.where(surely, lower, -np.inf), k)
                wanted |= near & (upper >= least[:, None])
            i, j, score = _scored(mine[part], theirs, wanted)
            for n in range(most):
                goal = filled[part][i, n]
                fit = np.nonzero(has[part][i, n] & (100 * score >= lowest * goal) & (100 * score <= highest * goal))[0]
                first = fit[_best(i[fit], score[fit], ids[j[fit]], k)]
                out.append((uid[part][i[first]], goal[first], ids[j[first]], score[first]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = 256,
    label: Column | None = None,
) -> DataFrame:
    """Of every anchor and each of its first positives the first negatives in the band.

    ``label`` may state the label anew from vec_id and label. Columns: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    rows = usable(vectors, scale)
    if label is not None:
        rows = rows.withColumn("label", label)
    # rows are told apart by their number, which is stored with them
    rows = staged(coded(rows.withColumn("uid", F.monotonically_increasing_id())), "negatives-rows").withColumn("size", F.size("x"))
    asked = rows.where(is_anchor).drop("code", "alignment", "remainder", "length")
    many = rows.count() // ROW_TILE + 1
    few = asked.count() // ANCHOR_TILE + 1
    block = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["size", "ab", "rb"]
    given = rows.withColumn("rb", block(2, many)).withColumn("ab", every(few)).groupBy(*key)

    def tiles(anchors: DataFrame, work, kind: str) -> DataFrame:
        fresh = anchors.select(*(F.col(c).alias(c) for c in anchors.columns))  # both sides come from the same rows
        dealt = fresh.withColumn("ab", block(1, few)).withColumn("rb", every(many))
        return dealt.groupBy(*key).cogroup(given).applyInArrow(work, kind)

    in_order = [F.desc("score"), F.asc("vec_id")]
    found = tiles(asked, lambda a, g: positive_tile(a, g, positives), "anchor long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*in_order))
    found = found.withColumn("place", place).where(F.col("place") <= positives)
    found = staged(found.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    goals = found.groupBy(F.col("anchor").alias("uid")).agg(F.array_sort(F.collect_set("positive_score")).alias("goals"))
    mined = tiles(
        asked.join(goals, "uid"),
        lambda a, g: negative_tile(a, g, negatives, lowest, highest),
        "anchor long, positive_score long, vec_id long, score long",
    )
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_score").orderBy(*in_order))
    mined = mined.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = asked.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        found.join(mined, ["anchor", "positive_score"])
        .join(named, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def moved_label() -> Column:
    """The label, moved on by one (modulo ten) in every seventh row."""
    label = F.col("label")
    return F.when(F.col("vec_id") % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)


# Every anchor against every row.
NEGATIVES_SQL = """
WITH fit AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x, row_number() OVER () AS uid
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid, a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
           list_inner_product(a.x, r.x)::BIGINT AS score
    FROM fit a JOIN fit r ON a.uid <> r.uid AND len(a.x) = len(r.x) WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.uid, p.place ORDER BY n.score DESC, n.vec_id) AS place
    FROM positive p JOIN scored n ON p.uid = n.uid AND NOT n.same
     AND 100 * n.score BETWEEN 80 * p.score AND 100 * p.score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, place::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 5
"""
