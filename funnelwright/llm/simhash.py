"""SimHash near-duplicates by anchor-point covering.

The 64 bits are three blocks. Two fingerprints within ``distance`` bits differ in at most a third of
it in some block. The anchors of a block are a covering code: the perfect Hamming (15, 11) code on
its first 15 bits (covering radius 1), every value on the others (radius 0). Each fingerprint has
one home anchor per block, the codeword nearest to it, and is sent to every anchor within covering
radius plus threshold. So of two near fingerprints the second always comes to the first one's home,
where they are compared in full. Equal fingerprints are one before all this.

At an anchor only a spanning forest of the links leaves the task. An anchor with more than
``CELL`` fingerprints is cut into chunks, and each pair of chunks is a cell of its own.

Fingerprints: texts in lower case (A-Z), words between ASCII white space, shingles of ``SHINGLE``
words joined by one space (repeats count; fewer words: the whole sequence), XXH64 of each with seed 42.
A bit is set if it is set in over half of the hashes.

Results in special cases: a NULL, empty or wordless text has fingerprint zero and is linked like
any other; repeated rows give one result each; rows with a NULL id belong to their group but
do not name it (its id is NULL if all ids are); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from . import words
from .batches import chunks, pick, small_batches
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42

# Widths of the blocks; each holds a Hamming code of 15 bits and free bits.
BLOCKS = [(0, 22), (22, 21), (43, 21)]
HAMMING = 15
# Shingles hashed at once.
BLOCK = 1 << 18
# Fingerprints compared in one cell at most, and up to which an anchor's pairs are formed at once.
CELL = 8192
SMALL = 512


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """XXH64 of all shingles of all texts, and the text of each, ``BLOCK`` shingles at a time."""
    import xxhash

    member = words.NOT_SPACE[data]
    starts, ends = words.runs(member, offsets)
    counts = np.diff(words.per_text(starts, offsets))
    # one space after each word, so a shingle is one stretch
    gaps = ends[ends < len(data)]
    gaps = gaps[~member[gaps]]
    kept = member.copy()
    kept[gaps] = True
    spaced = data.copy()
    spaced[gaps] = 0x20
    places = np.cumsum(kept) - 1
    starts, ends = places[starts], places[ends - 1] + 1
    compact = memoryview(spaced[kept].tobytes())
    del places, spaced, kept, member
    n_shingles = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    begins, first_word = np.cumsum(n_shingles) - n_shingles, np.cumsum(counts) - counts
    digest = xxhash.xxh64_intdigest
    for low in range(0, int(n_shingles.sum()), BLOCK):
        number = np.arange(low, min(low + BLOCK, int(n_shingles.sum())))
        text_of = np.searchsorted(begins + n_shingles, number, side="right")
        first = first_word[text_of] + number - begins[text_of]
        last = np.minimum(first + size, first_word[text_of] + counts[text_of]) - 1
        made = (digest(compact[s:e], SEED) for s, e in zip(starts[first].tolist(), ends[last].tolist(), strict=True))
        yield np.fromiter(made, dtype=np.uint64, count=len(first)), text_of


def fingerprint_texts(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """The fingerprints of texts, as unsigned 64-bit numbers."""
    data, offsets = words.buffer(column)
    ones = np.zeros((len(column), 64), dtype=np.int64)
    n = np.zeros(len(column), dtype=np.int64)
    for hashed, text_of in _shingle_hashes(data, offsets, size):
        bits = np.unpackbits(hashed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.flatnonzero(np.concatenate([[True], text_of[1:] != text_of[:-1]]))
        ones[text_of[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
        n[text_of[begins]] += np.diff(np.append(begins, len(text_of)))
    majority = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""
    small_batches(docs)
    frame = pick(docs, "doc_id", "text")
    schema = T.StructType([frame.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                made = fingerprint_texts(part.column("text"), size).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made)], names=["doc_id", "fp"])

    return frame.mapInArrow(run, schema)


def _syndromes() -> np.ndarray:
    """Of every 15-bit word the place (1 to 15) of the bit to flip to reach a codeword, 0 for codewords."""
    values = np.arange(1 << HAMMING, dtype=np.int64)
    syndrome = np.zeros_like(values)
    for place in range(1, HAMMING + 1):
        syndrome ^= np.where((values >> (place - 1)) & 1, place, 0)
    return syndrome


def _flip(place: np.ndarray) -> np.ndarray:
    return np.where(place > 0, np.int64(1) << np.maximum(place - 1, 0), 0)


def home_anchors(fps: np.ndarray, syndromes: np.ndarray) -> list[np.ndarray]:
    """Each fingerprint's anchor in every block: the nearest codeword beside its free bits."""
    out = []
    for number, (shift, width) in enumerate(BLOCKS):
        block = ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        coded = block & ((1 << HAMMING) - 1)
        out.append((np.int64(number) << 32) | (block ^ _flip(syndromes[coded])))
    return out


def visited_anchors(fps: np.ndarray, distance: int, syndromes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor): all anchors within covering radius plus threshold, for any split of the
    threshold between the coded and the free bits of a block."""
    threshold = distance // len(BLOCKS)
    index, anchors = [], []
    at = np.arange(len(fps))
    for number, (shift, width) in enumerate(BLOCKS):
        block = ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        coded, free = block & ((1 << HAMMING) - 1), block >> HAMMING
        found_index, found = [], []
        for changed in range(threshold + 1):  # bits that may differ in the free part
            near = _codewords_within(coded, threshold - changed, syndromes)
            for places in itertools.combinations(range(width - HAMMING), changed):
                other = free ^ sum(1 << p for p in places)
                for i, word in near:
                    found_index.append(at[i])
                    found.append((np.int64(number) << 32) | (other[i] << HAMMING) | word)
        i, a = np.concatenate(found_index), np.concatenate(found)
        pairs = np.unique(np.stack([i, a], axis=1), axis=0) if threshold > 1 else np.stack([i, a], axis=1)
        index.append(pairs[:, 0])
        anchors.append(pairs[:, 1])
    return np.concatenate(index), np.concatenate(anchors)


def _codewords_within(coded: np.ndarray, extra: int, syndromes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Codewords within 1 + ``extra`` of each coded part, each once: those reached by flipping ``extra``
    bits and then the bit that decoding names."""
    nearest = coded ^ _flip(syndromes[coded])
    out = [(np.arange(len(coded)), nearest)]
    seen = [nearest]
    for changed in range(1, extra + 1):
        for places in itertools.combinations(range(HAMMING), changed):
            word = coded ^ sum(1 << p for p in places)
            word = word ^ _flip(syndromes[word])
            new = np.ones(len(word), dtype=bool)
            for known in seen:
                new &= word != known
            out.append((np.flatnonzero(new), word[new]))
            seen.append(word)
    return out


def _forest(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the places a and b reduced to one link from each place to the first of its class."""
    label = np.arange(len(fps))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _grown(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the near pairs of many fingerprints: classes grow one member at a time,
    and what a class has taken in is never compared again."""
    left = fps
    ones, others = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = np.bitwise_count(left ^ one) <= distance
            if near.any():
                taken = left[near]
                left = left[~near]
                ones.append(np.full(len(taken), one))
                others.append(taken)
                queue += list(taken)
    if not ones:
        return fps[:0], fps[:0]
    return np.concatenate(ones), np.concatenate(others)


def anchor_links(
    anchor: np.ndarray, fps: np.ndarray, distance: int, syndromes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each run of equal anchors, as a forest per run."""
    begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    ends = np.concatenate([begins[1:], [len(anchor)]])
    sizes = ends - begins
    ones, others = [], []
    for g in np.flatnonzero(sizes > SMALL).tolist():
        a, b = _grown(np.unique(fps[begins[g] : ends[g]]), distance)
        ones.append(a)
        others.append(b)
    # smaller runs: every fingerprint that is at home here against all of the run
    small = np.repeat(sizes <= SMALL, sizes)
    home = np.zeros(len(fps), dtype=bool)
    for block in home_anchors(fps, syndromes):
        home |= block == anchor
    at = np.flatnonzero(home & small)
    run = np.searchsorted(begins, at, side="right") - 1
    width = sizes[run]
    cut = np.searchsorted(np.cumsum(width), np.arange(0, int(width.sum()) + 1, 1 << 20))
    for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True):
        if low == high:
            continue
        w = width[low:high]
        left = np.repeat(at[low:high], w)
        right = np.arange(len(left)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(begins[run[low:high]], w)
        differ = np.bitwise_count(fps[left] ^ fps[right])
        near = (differ <= distance) & (differ > 0)
        if near.any():
            places, inverse = np.unique(np.concatenate([left[near], right[near]]), return_inverse=True)
            half = len(inverse) // 2
            a, b = _forest(fps[places], inverse[:half], inverse[half:])
            ones.append(a)
            others.append(b)
    if not ones:
        return fps[:0], fps[:0]
    return np.concatenate(ones), np.concatenate(others)


def _visits(nodes: DataFrame, distance: int) -> DataFrame:
    """(anchor, fp) for every anchor that a fingerprint is sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        syndromes = _syndromes()
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            index, anchors = visited_anchors(fps, distance, syndromes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(fps[index].view(np.int64))], names=["anchor", "fp"]
            )

    return nodes.select("fp").mapInArrow(run, "anchor long, fp long")


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that connect all fingerprints of ``nodes`` (column fp, distinct) within ``distance``."""
    small_batches(nodes)
    visits = _visits(nodes, distance)
    crowded = visits.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(CELL // 2)), F.lit(1)).cast("int")
    placed = visits.join(crowded, "anchor", "left").withColumn("parts", parts)
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # chunk c meets chunk j in the cell of the smaller and the larger of the two
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.least(j, F.col("own")) * F.lit(65536).cast("long") + F.greatest(j, F.col("own")),
    )
    dealt = placed.withColumn("own", own).select("anchor", F.explode(cells).alias("cell"), "fp")
    sorted_ = dealt.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        syndromes = _syndromes()
        for anchor, fps in _whole_groups(batches):
            a, b = anchor_links(anchor, fps, distance, syndromes)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    return sorted_.mapInArrow(run, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch], least: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted rows in pieces that end where a cell ends. Cells are bounded, so pieces are."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    total = 0

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def split(anchor: np.ndarray, cell: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # an anchor of one cell is told from another cell of the same anchor by a run of its own
        change = np.flatnonzero((anchor[1:] == anchor[:-1]) & (cell[1:] != cell[:-1])) + 1
        for low, high in zip([0, *change.tolist()], [*change.tolist(), len(anchor)], strict=True):
            yield anchor[low:high], fps[low:high]

    for batch in batches:
        anchor, cell = batch.column("anchor").to_numpy(), batch.column("cell").to_numpy()
        held.append((anchor, cell, batch.column("fp").to_numpy().view(np.uint64)))
        total += len(anchor)
        if total >= least:
            anchor, cell, fps = joined()
            new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1]))
            if len(new):
                end = int(new[-1]) + 1
                yield from split(anchor[:end], cell[:end], fps[:end])
                held = [(anchor[end:], cell[end:], fps[end:])]
                total = len(held[0][0])
            else:
                held = [(anchor, cell, fps)]
    if total:
        yield from split(*joined())


def _groups(marked: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of the stored rows ``marked`` (doc_id, fp)."""
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "nodes")
    roots = components(links(nodes, distance))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    placed = staged(placed, "roots")
    named = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return placed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row: doc_id, ``fp``, ``root`` (the smallest fingerprint of its group) and ``component_id``
    (the smallest doc_id of its group)."""
    marked = staged(fingerprints(docs, size), "fingerprints")
    return marked.join(_groups(marked, distance), "fp")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# Names of the columns that keep_one adds for itself.
_DOC, _FP, _ROW = "_simhash_doc", "_simhash_fp", "_simhash_row"


def keep_one(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group stays: that with the smallest doc_id, of rows that share it the first.

    The rows are written once with their fingerprint and a row number. Both are read back from
    there, so settings or executors that change in between change nothing, and texts are
    shuffled once, by row number, whatever the size of a group.
    """
    marked = staged(_with_fingerprint(docs, size).withColumn(_ROW, F.monotonically_increasing_id()), "marked")
    narrow = marked.select(F.col(_DOC).alias("doc_id"), F.col(_FP).alias("fp"), _ROW)
    groups = narrow.join(_groups(narrow, distance), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(_ROW).alias("row"))
    stay = groups.groupBy("root").agg(F.min(order)["row"].alias(_ROW)).select(_ROW)
    return marked.join(stay, _ROW, "left_semi").select(*docs.columns)


def _with_fingerprint(docs: DataFrame, size: int) -> DataFrame:
    """All columns, and doc_id and fingerprint under names of their own."""
    small_batches(docs)
    names = docs.columns
    text, doc = (names.index(c) for c in ("text", "doc_id"))
    added = [T.StructField(_DOC, docs.schema.fields[doc].dataType), T.StructField(_FP, T.LongType())]
    schema = T.StructType(docs.schema.fields + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, batch.schema.names[text]):
                made = pa.array(fingerprint_texts(part.column(text), size).view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, part.column(doc), made], names=schema.names)

    return docs.mapInArrow(run, schema)


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprint in hexadecimal and the id of the group."""
    return near_duplicates(docs).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
