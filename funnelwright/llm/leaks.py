"""Benchmark decontamination with suffix arrays over the training documents.

Each shard (some megabytes of whole documents of one task) gets a suffix array of its words.
Every suffix of the benchmark that begins a window is looked up by binary search, which gives the documents and places
of each window. Only suffixes that begin with a benchmark word
are sorted, and a word outside the benchmark ends a suffix: no match can hold one.

How far a match goes on is found from the other side: every place found is looked up in the suffix array of
the benchmark, whose neighbours there share the most words with it, whatever the number of items with a passage. A
document's longest verbatim match is the longest such; the first of equal ones in the document counts, and of items
with the same words there the one whose id comes first as text. ``longest_matches`` answers per suffix of
the benchmark.

The benchmark is read by the tasks in blocks of bounded size from the shared folder. Words are
compared by 64-bit hashes (see ``words``).

Results in special cases: NULL or wordless texts have no words and hit nothing; a benchmark item
of fewer words than the window is one window; an item without words has none; items with a NULL
id count as hits but are not listed; repeated items count once; repeated documents give one result
each; an empty benchmark hits nothing; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .batches import merged, pick, small_batches
from .files import read_block, written_blocks

WINDOW = 10
SHARD_BYTES = 6 << 20
BLOCK_BYTES = 8 << 20


@dataclass
class Sequence:
    """Word numbers of texts on end, a zero after each text; 0 is also any word not in the vocabulary."""

    ids: np.ndarray
    text_of: np.ndarray
    first: np.ndarray


def _sequence(ids: np.ndarray, counts: np.ndarray, pad: int) -> Sequence:
    n = len(counts)
    text_of_word = np.repeat(np.arange(n), counts)
    out = np.zeros(len(ids) + n + pad, dtype=np.int64)
    out[np.arange(len(ids)) + text_of_word] = ids
    first = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(counts + 1, out=first[1:])
    text_of = np.repeat(np.arange(n), counts + 1)
    return Sequence(out, text_of, first)


class Packed:
    """The words at each place, ``per_key`` at a time, as one number that sorts as they do."""

    def __init__(self, ids: np.ndarray, bits: int):
        self.bits, self.per_key = bits, max(1, 62 // bits)
        n = len(ids)
        self.key = ids.copy()
        self.full = ids > 0  # whether no word of the key is 0; what follows a 0 is not looked at
        for j in range(1, self.per_key):
            self.key <<= bits
            self.key[: n - j] |= np.where(self.full[: n - j], ids[j:], 0)
            self.full[: n - j] &= ids[j:] > 0
            self.full[n - j :] = False


def suffix_array(ids: np.ndarray, packed: Packed) -> np.ndarray:
    """Places of non-zero words in the order of their suffixes, by prefix doubling.

    A suffix ends at the next zero. Only suffixes that still tie are sorted again.
    """
    places = np.flatnonzero(ids)
    if not len(places):
        return places
    keys = packed.key[places]
    order = np.argsort(keys)
    sorted_places, keys = places[order], keys[order]
    del order
    new = np.empty(len(keys), dtype=bool)
    new[0] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    group = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    rank = np.full(len(ids), -1, dtype=np.int64)
    rank[sorted_places] = group
    depth = packed.per_key
    zeros = np.flatnonzero(ids == 0)
    tied = ~new
    tied[:-1] |= ~new[1:]
    open_at = np.flatnonzero(tied & packed.full[sorted_places])
    while len(open_at):
        at = sorted_places[open_at]
        group = rank[at]
        nxt = rank[at + depth] + 1
        order = np.lexsort((nxt, group))
        at, group, nxt = at[order], group[order], nxt[order]
        sorted_places[open_at] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        rank[at] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        depth *= 2
        left = zeros[np.searchsorted(zeros, at)] - at  # words until the suffix ends
        open_at = open_at[tied & (left >= depth)]
    return sorted_places


def _bound(
    array: np.ndarray, data: Packed, test: Packed, starts: np.ndarray, lengths: np.ndarray, after: bool
) -> np.ndarray:
    """First entry of the suffix array not below (``after``: above) the given words of the test."""
    low = np.zeros(len(starts), dtype=np.int64)
    high = np.full(len(starts), len(array), dtype=np.int64)
    while len(busy := np.flatnonzero(low < high)):
        middle = (low[busy] + high[busy]) >> 1
        sign = _compare(array[middle], data, starts[busy], test, lengths[busy])
        below = sign < 0 if not after else sign <= 0
        low[busy[below]] = middle[below] + 1
        high[busy[~below]] = middle[~below]
    return low


def _compare(p: np.ndarray, data: Packed, q: np.ndarray, test: Packed, lengths: np.ndarray) -> np.ndarray:
    """Sign of data suffix against the first ``lengths`` words of the test suffix."""
    k, bits = data.per_key, data.bits
    sign = np.zeros(len(p), dtype=np.int8)
    active = np.arange(len(p))
    done = 0
    while len(active):
        rest = np.clip(k - (lengths[active] - done), 0, k) * bits
        a = data.key[p[active] + done] >> rest
        b = test.key[q[active] + done] >> rest
        sign[active] = (a > b).astype(np.int8) - (a < b)
        more = (a == b) & (lengths[active] > done + k) & data.full[p[active] + done]
        active = active[more]
        done += k
    return sign


def _shared_length(p: np.ndarray, data: Packed, q: np.ndarray, test: Packed) -> np.ndarray:
    """Number of words that the suffixes have in common."""
    k = data.per_key
    length = np.zeros(len(p), dtype=np.int64)
    active = np.arange(len(p))
    while len(active):
        at = length[active]
        a, b = data.key[p[active] + at], test.key[q[active] + at]
        same = (a == b) & data.full[p[active] + at]
        part = active[~same]
        a, b = a[~same], b[~same]
        running = np.ones(len(part), dtype=bool)
        for j in range(k - 1, -1, -1):
            x, y = (a >> (j * data.bits)) & ((1 << data.bits) - 1), (b >> (j * data.bits)) & ((1 << data.bits) - 1)
            running &= (x == y) & (x > 0)
            length[part] += running
        active = active[same]
        length[active] += k
    return length


class Benchmark:
    """One block of items: vocabulary, word numbers and windows."""

    def __init__(self, item_ids: list, column: pa.Array, window: int):
        data, offsets = words.buffer(column)
        starts, ends = words.runs(words.ALNUM[data], offsets)
        hashed = words.hashes(data, starts, ends)
        counts = np.diff(words.per_text(starts, offsets))
        self.vocabulary, ids = np.unique(hashed, return_inverse=True)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.pad = 62 // self.bits + 1
        self.sequence = _sequence(ids.astype(np.int64) + 1, counts, self.pad)
        self.packed = Packed(self.sequence.ids, self.bits)
        self.item_ids = item_ids
        self._array: np.ndarray | None = None
        begin, length = [], []
        for first, n in zip(self.sequence.first[:-1].tolist(), counts.tolist(), strict=True):
            if n:
                begin.append(np.arange(first, first + max(1, n - window + 1)))
                length.append(np.full(len(begin[-1]), min(n, window)))
        self.begin = np.concatenate(begin) if begin else np.empty(0, dtype=np.int64)
        self.length = np.concatenate(length) if length else np.empty(0, dtype=np.int64)

    def array(self) -> np.ndarray:
        """The suffix array of the items, made once."""
        if self._array is None:
            self._array = suffix_array(self.sequence.ids, self.packed)
        return self._array

    def longest(self, shard: Shard, places: np.ndarray) -> np.ndarray:
        """How many words each place of a shard has in common with some item, from there on."""
        array = self.array()
        whole = np.full(len(places), np.iinfo(np.int64).max)
        low = _bound(array, self.packed, shard.packed, places, whole, False)
        best = np.zeros(len(places), dtype=np.int64)
        for side in (low - 1, low):
            neighbour = array[np.clip(side, 0, len(array) - 1)]
            best = np.maximum(best, _shared_length(neighbour, self.packed, places, shard.packed))
        return best

    def first_item(self, shard: Shard, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The first item that holds so many words of each place."""
        array = self.array()
        low = _bound(array, self.packed, shard.packed, places, lengths, False)
        high = _bound(array, self.packed, shard.packed, places, lengths, True)
        ranges, of = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
        least = [int(self.sequence.text_of[array[a:b]].min()) for a, b in ranges.T.tolist()]
        return np.array(least, dtype=np.int64)[of.reshape(-1)]

    def number(self, hashed: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words from 1, and 0 for words outside."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), dtype=np.int64)
        at = np.searchsorted(self.vocabulary, hashed)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)


class Shard:
    """Whole documents with the suffix array of their words."""

    def __init__(self, hashed: np.ndarray, counts: np.ndarray, bench: Benchmark):
        self.bench = bench
        self.sequence = _sequence(bench.number(hashed), counts, bench.pad)
        self.packed = Packed(self.sequence.ids, bench.bits)
        self.array = suffix_array(self.sequence.ids, self.packed)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Benchmark windows that occur: their index and their range of the suffix array."""
        b = self.bench
        low = _bound(self.array, self.packed, b.packed, b.begin, b.length, False)
        found = np.flatnonzero(low < len(self.array))
        hits = _compare(self.array[low[found]], self.packed, b.begin[found], b.packed, b.length[found]) == 0
        found = found[hits]
        high = _bound(self.array, self.packed, b.packed, b.begin[found], b.length[found], True)
        return found, low[found], high

    def longest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every benchmark suffix: its place, its longest match here, and the place of that match."""
        b = self.bench
        at = np.flatnonzero(b.sequence.ids)
        if not len(self.array) or not len(at):
            return at, np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        whole = np.full(len(at), np.iinfo(np.int64).max)
        low = _bound(self.array, self.packed, b.packed, at, whole, False)
        best, place = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for side in (low - 1, low):
            p = self.array[np.clip(side, 0, len(self.array) - 1)]
            length = _shared_length(p, self.packed, at, b.packed)
            place = np.where(length > best, p, place)
            best = np.maximum(best, length)
        return at, best, place


@functools.lru_cache(maxsize=1)
def _benchmark(address: str, window: int) -> Benchmark:
    table = read_block(address).combine_chunks()
    table = table.take(pc.sort_indices(table["item_id"].cast(pa.string())))  # NULL ids last
    return Benchmark(table["item_id"].to_pylist(), pa.chunked_array(table["text"]).combine_chunks(), window)


def _concat(ranges_low: np.ndarray, ranges_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges on end, and the range each belongs to."""
    sizes = ranges_high - ranges_low
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + ranges_low[owner], owner


def _document_hits(column: pa.Array, blocks: list[str], window: int) -> dict[str, list]:
    data, offsets = words.buffer(column)
    starts, ends = words.runs(words.ALNUM[data], offsets)
    hashed = words.hashes(data, starts, ends)
    counts = np.diff(words.per_text(starts, offsets))
    del data, starts, ends
    n = len(counts)
    covered = np.zeros(int((counts + 1).sum()) + 1, dtype=np.int64)
    items: list[set] = [set() for _ in range(n)]
    longest: list = [None] * n  # negative length, place, whether the item has no id, its id as text
    for address in blocks:
        bench = _benchmark(address, window)
        shard = Shard(hashed, counts, bench)
        found, low, high = shard.windows()
        if not len(found):
            continue
        ranges, first, of = np.unique(
            np.stack([low, high, bench.length[found]]), axis=1, return_index=True, return_inverse=True
        )
        at, owner = _concat(ranges[0], ranges[1])
        place = shard.array[at]
        width = ranges[2][owner]
        np.add.at(covered, place, 1)
        np.add.at(covered, place + width, -1)
        # which items: distinct (range, document) pairs against the items that share the range
        pairs = np.unique(owner * n + shard.sequence.text_of[place])
        sharing: dict[int, set] = {}
        item_of = bench.sequence.text_of[bench.begin[found]]
        for r, i in zip(of.reshape(-1).tolist(), item_of.tolist(), strict=True):
            sharing.setdefault(r, set()).add(bench.item_ids[i])
        for r, d in zip((pairs // n).tolist(), (pairs % n).tolist(), strict=True):
            items[d] |= sharing[r]
        # the longest match of each document among the places found: of a window or more with any item, else a short item
        widest = np.lexsort((-width, place))
        widest = widest[np.unique(place[widest], return_index=True)[1]]
        place, owner = place[widest], owner[widest]
        shared = bench.longest(shard, place)
        length = np.where(shared >= window, shared, width[widest])
        doc = shard.sequence.text_of[place]
        order = np.lexsort((place, -length, doc))
        best = order[np.unique(doc[order], return_index=True)[1]]
        item = bench.first_item(shard, place[best], length[best])
        for d, size, i, r, p in zip(
            doc[best].tolist(), length[best].tolist(), item.tolist(), owner[best].tolist(),
            (place[best] - shard.sequence.first[doc[best]]).tolist(), strict=True,
        ):
            names = [bench.item_ids[i]] if size >= window else sharing[r]
            found_now = min((-size, p, name is None, str(name)) for name in names)
            if longest[d] is None or found_now < longest[d]:
                longest[d] = found_now
    hit = np.cumsum(covered)[:-1] > 0
    bounds = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(counts + 1, out=bounds[1:])
    totals = np.concatenate([[0], np.cumsum(hit)])
    return {
        "n_words": counts.tolist(),
        "n_hit": (totals[bounds[1:]] - totals[bounds[:-1]]).tolist(),
        "items": [sorted(str(i) for i in s if i is not None) for s in items],
        "longest": [0 if m is None else -m[0] for m in longest],
        "longest_item": [None if m is None or m[2] else m[3] for m in longest],
        "longest_at": [None if m is None else m[1] for m in longest],
    }


HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
        T.StructField("longest_item", T.StringType()),
        T.StructField("longest_at", T.LongType()),
    ]
)


def benchmark_blocks(benchmark: DataFrame) -> list[str]:
    """The benchmark in the shared folder, as files of about BLOCK_BYTES of text."""
    items = pick(benchmark, "item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return written_blocks(items, "benchmark", total // BLOCK_BYTES + 1)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW
) -> DataFrame:
    """Per document: the kept columns, its words, the words inside an occurring window, the items, and
    the longest verbatim match that holds a window (words, item, first word)."""
    small_batches(docs)
    blocks = benchmark_blocks(benchmark)
    frame = pick(docs, *dict.fromkeys([*keep, "text"]))
    schema = T.StructType([frame.schema[c] for c in keep] + HITS.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for part in merged(batches, "text", SHARD_BYTES):
            made = _document_hits(part.column("text"), blocks, window)
            columns = [part.column(c) for c in keep]
            columns += [pa.array(made[f.name], arrow.field(f.name).type) for f in HITS.fields]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return frame.mapInArrow(run, schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per suffix of a benchmark item: the longest verbatim match in any shard, a document that holds it,
    and the word where it begins there. Suffixes whose first word occurs nowhere have no row."""
    small_batches(docs)
    blocks = benchmark_blocks(benchmark)
    frame = pick(docs, "doc_id", "text")
    key, item = frame.schema["doc_id"].dataType.simpleString(), pick(benchmark, "item_id").schema["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in merged(batches, "text", SHARD_BYTES):
            data, offsets = words.buffer(part.column("text"))
            starts, ends = words.runs(words.ALNUM[data], offsets)
            hashed = words.hashes(data, starts, ends)
            counts = np.diff(words.per_text(starts, offsets))
            for address in blocks:
                bench = _benchmark(address, window)
                shard = Shard(hashed, counts, bench)
                at, best, place = shard.longest()
                at, best, place = at[best > 0], best[best > 0], place[best > 0]
                if not len(at):
                    continue
                owner, doc = bench.sequence.text_of[at], shard.sequence.text_of[place]
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": [bench.item_ids[i] for i in owner.tolist()],
                        "item_at": at - bench.sequence.first[owner],
                        "n_words": best,
                        "doc_id": part.column("doc_id").take(pa.array(doc)),
                        "doc_at": place - shard.sequence.first[doc],
                    }
                )

    found = frame.mapInArrow(
        run, f"item_id {item.dataType.simpleString()}, item_at long, n_words long, doc_id {key}, doc_at long"
    )
    # longest first, then the smallest id, a NULL one before all, then the first word
    best = F.min(F.struct((-F.col("n_words")).alias("short"), "doc_id", "doc_at"))
    return (
        found.groupBy("item_id", "item_at")
        .agg(best.alias("b"))
        .select("item_id", "item_at", (-F.col("b.short")).alias("n_words"), "b.doc_id", "b.doc_at")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window in their text; same columns."""
    small_batches(docs)
    blocks = benchmark_blocks(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in merged(batches, text, SHARD_BYTES):
            clean = pa.array([n == 0 for n in _document_hits(part.column(text), blocks, window)["n_hit"]])
            yield part.filter(clean)

    return docs.mapInArrow(run, docs.schema)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts and the digest of the hit items per document."""
    found = find_leaks(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
        "longest_item",
        "longest_at",
    )


# Windows as joined texts, met by equality; words inside any of them counted once.
LEAK_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id AS id, text, TRUE AS is_doc FROM documents
    UNION ALL SELECT -row_number() OVER (), item_id, text, FALSE FROM benchmark
), split AS MATERIALIZED (
    SELECT row, id, is_doc, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
), windows AS MATERIALIZED (
    SELECT row AS item, spot AS item_spot, id, least(len(words), {WINDOW}) AS size,
           array_to_string(words[spot : spot + least(len(words), {WINDOW}) - 1], ' ') AS line
    FROM (SELECT *, unnest(range(1, greatest(len(words) - {WINDOW} + 1, least(len(words), 1)) + 1)) AS spot FROM split WHERE NOT is_doc)
), sizes AS (SELECT DISTINCT size FROM windows), places AS (
    SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS spot FROM split JOIN sizes ON is_doc AND len(words) >= size
), found AS MATERIALIZED (
    SELECT row, spot, p.size, w.id, w.item, spot - w.item_spot AS shift FROM places p
    JOIN windows w ON w.size = p.size AND w.line = array_to_string(words[spot : spot + p.size - 1], ' ')
), hit AS (
    SELECT row, count(*) AS n FROM (SELECT DISTINCT row, unnest(range(spot, spot + size)) AS place FROM found) GROUP BY row
), stretches AS (
    SELECT row, min(spot) - 1 AS place, count(*) + any_value(size) - 1 AS n, CAST(any_value(id) AS VARCHAR) AS item
    FROM (SELECT *, spot - row_number() OVER (PARTITION BY row, item, shift ORDER BY spot) AS stretch FROM found) AS found
    GROUP BY row, found.item, shift, stretch
), longest AS (
    SELECT * FROM stretches QUALIFY row_number() OVER (PARTITION BY row ORDER BY n DESC, place, item NULLS LAST) = 1
), items AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT row, CAST(id AS VARCHAR) AS item FROM found WHERE id IS NOT NULL) GROUP BY row
)
SELECT s.id AS doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
       coalesce(longest.n, 0)::BIGINT AS longest, longest.item AS longest_item, longest.place::BIGINT AS longest_at
FROM split s LEFT JOIN hit USING (row) LEFT JOIN items USING (row) LEFT JOIN longest USING (row) WHERE is_doc
"""
