"""Language identification by nearest centroid.

A text is a vector of hashed n-grams (1 to 3 bytes of its letters, words parted by one space; letters are
a-z and all bytes beyond ASCII, capitals of ASCII and the Latin-1 block in lower case), square roots of counts times inverse document frequency, scaled to length 1. Every language
has ``CLUSTERS`` centroids from spherical k-means over at most ``SAMPLE`` of its training documents
(those of smallest id hash); document frequencies count all training documents. The language of
the centroid of largest cosine is predicted, ties to the smaller name.

A text is rejected if it has no letters, or if its distance (1 - cosine) from the nearest centroid
is beyond what training members of its language show, widened by ``MARGIN``. The reach of a language
is learnt per length class, since short texts lie further out, from the distances of each half of its
sample to centroids of the other half. A class of fewer than ``ENOUGH`` members takes those of all
languages in the class, and if these are fewer than ``LEAST_MEMBERS`` the reach of the next shorter class;
the shortest has ``FURTHEST`` then. No class reaches less far than a longer one, none beyond ``FURTHEST``.

Results in special cases: a NULL text, and one without letters, is ``und`` with score 0 and rejected;
without any labelled training document every text is; a row with a NULL id is a training row, one with
a NULL language is not; repeated rows give one result each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import words
from .batches import chunks, in_remainder, pick, small_batches

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
CLUSTERS = 4
SAMPLE = 500
ROUNDS = 10
# Most languages a model may have, and shares a language's rows are dealt into when sampling.
LANGUAGES = 1000
SHARES = 64
MARGIN = 0.15
# No language reaches further: texts in other scripts lie beyond.
FURTHEST = 0.95
# Length classes end at these numbers of n-grams.
LENGTHS = np.array([60, 120, 250, 500, 1000, 4000])
LEAST_MEMBERS, ENOUGH = 5, 30
UNKNOWN = "und"
ROWS = 256

_MAY_BE_LETTER = re.compile(r"[^\W\d_]")
_KEPT = np.zeros(256, dtype=bool)
_KEPT[0x61:0x7B] = True
_KEPT[0x80:] = True


def has_letters(text: str) -> bool:
    """Whether the text has a letter; other numerals than digits are none."""
    return any(m[0].isalpha() for m in _MAY_BE_LETTER.finditer(text))


def counts(column: pa.Array) -> np.ndarray:
    """Counts of hashed n-grams, one row per text."""
    data, offsets = words.buffer(column)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, DIMENSIONS), dtype=np.float32)
    accented = np.zeros(len(data), dtype=bool)  # capital letters of the Latin-1 block
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = data + np.where(accented, 32, 0).astype(np.uint8)
    letter = _KEPT[data]
    gap = ~letter
    gap[1:] &= letter[:-1]  # only the first byte of a gap is kept, as a space
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    gap[starts] = ~letter[starts]  # whatever text stands before
    kept = np.flatnonzero(letter | gap)
    text_of = (np.searchsorted(offsets, kept, side="right") - 1).astype(np.int64)
    byte = np.where(letter[kept], data[kept], 0x20).astype(np.uint32)
    out = np.zeros(n * DIMENSIONS, dtype=np.float32)
    code = np.zeros(len(byte), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        size = len(byte) - order + 1
        if size <= 0:
            break
        code = (code[:size] << np.uint32(8)) | byte[order - 1 :]
        if order not in ORDERS:
            continue
        hashed = (code + np.uint32(order << 28)) * np.uint32(0x9E3779B1)
        place = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(20)
        same = text_of[:size] == text_of[order - 1 :]
        index = text_of[:size] * DIMENSIONS + place
        out += np.bincount(index[same], minlength=len(out)).astype(np.float32)
    return out.reshape(n, DIMENSIONS)


def vectors(counted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted rows of length 1; a row without n-grams stays zero."""
    weighted = np.sqrt(counted) * idf
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(length > 0, length, 1)


def spherical_clusters(rows: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of at most k clusters: seeds evenly spaced by nearness to the mean, then rounds."""
    order = np.argsort(rows @ rows.mean(axis=0), kind="stable")
    k = min(k, len(rows))
    centroids = rows[order[(2 * np.arange(k) + 1) * len(rows) // (2 * k)]]
    for _ in range(ROUNDS):
        member = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, member, rows)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    return centroids.astype(np.float32)


def distances(rows: np.ndarray, sizes: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Per length class the number of rows, and the largest distance of one from centroids it did not help to make."""
    many, far = np.zeros(len(LENGTHS) + 1, dtype=np.int64), np.zeros(len(LENGTHS) + 1)
    for half in (0, 1):
        own, other = rows[half::2], rows[1 - half :: 2]
        if len(own) and len(other):
            length = np.searchsorted(LENGTHS, sizes[half::2])
            np.add.at(many, length, 1)
            np.maximum.at(far, length, 1 - (own @ spherical_clusters(other, clusters).T).max(axis=1))
    return many, far


def reaches(many: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Per language and length class how far a text may lie, from the members of each and their largest distances."""
    out = np.full(many.shape, FURTHEST)
    for k in range(many.shape[1]):
        shared = far[:, k].max() + MARGIN if many[:, k].sum() >= LEAST_MEMBERS else None
        for i in range(len(many)):
            if many[i, k] >= ENOUGH:
                out[i, k] = far[i, k] + MARGIN
            elif shared is not None:
                out[i, k] = shared
            elif k:
                out[i, k] = out[i, k - 1]
    return np.minimum(np.maximum.accumulate(out[:, ::-1], axis=1)[:, ::-1], FURTHEST)


@dataclass
class Model:
    """Languages by name, their centroids, and how far each centroid reaches."""

    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    reach: np.ndarray
    idf: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine and acceptance of each text."""
        texts = column.to_pylist()
        has_letter = np.array([t is not None and has_letters(t) for t in texts], dtype=bool)
        counted = counts(column)
        if not len(self.languages):
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        cosine = vectors(counted, self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)  # centroids stand in order of their language's name
        score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
        length = np.searchsorted(LENGTHS, counted.sum(axis=1))
        accepted = has_letter & (1 - score <= self.reach[best, length])
        names = [self.languages[o] if ok else UNKNOWN for o, ok in zip(self.owner[best].tolist(), has_letter, strict=True)]
        return names, np.where(has_letter, score, 0.0).tolist(), accepted.tolist()


def _frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each dimension occurs, and the number of documents.

    Every task sends one row per dimension at most, and the sums have a fixed number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for part in chunks(batch, "text"):
                for low in range(0, part.num_rows, ROWS):
                    total += (counts(part.column("text").slice(low, ROWS)) > 0).sum(axis=0)
                n += part.num_rows
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": np.append(place, -1), "n": np.append(total[place], n)})

    summed = training.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r["place"]: r["n"] for r in summed.collect()}
    out = np.zeros(DIMENSIONS)
    for place, n in found.items():
        if place >= 0:
            out[place] = n
    return out, int(found.get(-1, 0))


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learn from the documents of ``docs`` (doc_id, text, lang) that have a language and are not held out."""
    small_batches(docs)
    labelled = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_remainder(F.col("doc_id"), 4, 2)
    )
    frequency, n = _frequencies(labelled)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    # the sample's bound per language first, on narrow rows: of each share of a language, however large,
    # at most ``sample`` rows go on, so a language brings SHARES x sample rows together
    order = F.xxhash64("doc_id")
    share = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(SHARES))
    shares = labelled.select("lang", order.alias("h"), share.alias("share"))
    for keys in (["lang", "share"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
        shares = shares.withColumn("rank", rank).where(F.col("rank") <= sample)
    bounds = shares.groupBy("lang").agg(F.max("h").alias("bound")).limit(LANGUAGES + 1).collect()
    if len(bounds) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    # one row per language: the texts below the bounds need no shuffle by language
    bound = docs.sparkSession.createDataFrame([tuple(r) for r in bounds], "lang string, bound long")
    chosen = labelled.withColumn("h", order).join(F.broadcast(bound), "lang").where("h <= bound").select("lang", "h", "text")
    first = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    chosen = chosen.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample)

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        texts = pa.array(frame["text"], pa.string())
        counted = np.concatenate([counts(texts.slice(low, ROWS)) for low in range(0, len(texts), ROWS)])
        rows = vectors(counted, idf)
        some = np.linalg.norm(rows, axis=1) > 0
        if not some.any():
            return pd.DataFrame({"lang": [], "centroid": [], "many": [], "far": []})
        centroids = spherical_clusters(rows[some], clusters)
        many, far = distances(rows[some], counted[some].sum(axis=1), clusters)
        n = len(centroids)
        return pd.DataFrame(
            {"lang": frame["lang"].iloc[0], "centroid": list(centroids), "many": [list(many)] * n, "far": [list(far)] * n}
        )

    kind = "lang string, centroid array<float>, many array<long>, far array<double>"
    learnt = chosen.groupBy("lang").applyInPandas(learn, kind)
    rows = sorted(learnt.collect(), key=lambda r: r["lang"])  # languages x clusters rows
    languages = sorted({r["lang"] for r in rows})
    owner = np.array([languages.index(r["lang"]) for r in rows], dtype=np.int64)
    first_of = {r["lang"]: r for r in reversed(rows)}
    many, far = (np.array([first_of[x][c] for x in languages]).reshape(-1, len(LENGTHS) + 1) for c in ("many", "far"))
    return Model(
        languages,
        owner,
        np.array([r["centroid"] for r in rows], dtype=np.float32).reshape(len(rows), DIMENSIONS),
        reaches(many, far)[owner] if len(rows) else np.zeros((0, len(LENGTHS) + 1)),
        idf,
    )


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, lang_pred, score, and whether the text is accepted."""
    small_batches(docs)
    frame = pick(docs, "doc_id", "text")
    shared = frame.sparkSession.sparkContext.broadcast(model)  # languages x clusters x DIMENSIONS numbers
    fields = [
        frame.schema["doc_id"],
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _small(batches, "text"):
            names, score, accepted = shared.value.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    return frame.mapInArrow(run, T.StructType(fields))


def _small(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, text):
            for low in range(0, part.num_rows, ROWS):
                yield part.slice(low, ROWS)


def keep_known(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is accepted as one of the languages learnt from ``docs``; same columns."""
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _small(batches, text):
            yield part.filter(pa.array(shared.value.predict(part.column(text))[2], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_report(docs: DataFrame) -> DataFrame:
    """Predictions of all documents, with whether each was held out from training."""
    made = identify(docs, fit(docs))
    return made.select(
        "doc_id", in_remainder(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "accepted"
    )
