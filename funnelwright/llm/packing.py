"""Packing documents into fixed windows of token ids by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id. Stretches of a whole window stand alone. What remains
is dealt into groups of about ``GROUP`` pieces; within a group the pieces start as partial
partitions of k windows (one piece in one of them), and the two partitions of largest imbalance are
merged again and again, the fullest window of one on the emptiest of the other, until one is left.
If a window then exceeds the capacity, k rises by the excess and the group starts over. One
document in ``FILLER`` is cut into small pieces, which even out the windows of its group.

A distinct run of characters is tokenised once per cache life, not once per occurrence: the
tokenizer drops white space and never merges over it, nor over the border of an ASCII letter and
ASCII punctuation. Texts holding a special token's own string go to the tokenizer whole, and so do
all texts of a tokenizer of another kind.

Results in special cases: a NULL text counts as empty; an empty text is the end id alone; repeated
rows are packed each; an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from . import words
from .batches import CHUNK_BYTES, chunks, pick, small_batches

CAPACITY = 4096
GROUP = 2000
FILLER, FINE = 8, 128
END_ID = 2

# A run's slot in the table of known runs: the top 20 bits of its hash.
_SHIFT = np.uint64(44)

# Classes of bytes that decide where runs may be cut before tokenising.
_SPLIT = words.NOT_SPACE.copy()
_SPLIT[[0x0B, 0x0C]] = True  # the tokenizer sees these itself
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[0x21:0x7F] = True
_MARK[0x30:0x3A] = False
_MARK[0x27] = False  # an apostrophe may belong to the letters after it
_MARK &= ~_LETTER


def _splits_at_white_space(description: str) -> bool:
    """Whether a tokenizer is of the kind whose texts may be cut into runs: lower case, white space
    dropped, letters apart from marks. Texts of other tokenizers are encoded whole."""
    parts = json.loads(description)
    normalisers = (parts.get("normalizer") or {}).get("normalizers", [])
    splitters = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [n.get("type") for n in normalisers] == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in splitters] == ["Split", "ByteLevel"]
        and splitters[0].get("pattern", {}).get("Regex") == _WORD_PATTERN
        and splitters[0].get("behavior") == "Removed"
        and splitters[0].get("invert") is True
        and splitters[1].get("add_prefix_space") is False
        and parts.get("post_processor") is None
    )


# Fixed value: how such a tokenizer finds words.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Token ids of many texts; remembers the runs it met in a direct-mapped table of fixed size."""

    SLOTS = 1 << 20
    POOL = 8 << 20

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._by_runs = _splits_at_white_space(self._tokenizer.to_str())
        self._clear()

    def _clear(self) -> None:
        self._known = np.zeros(self.SLOTS, dtype=np.uint64)
        self._start = np.zeros(self.SLOTS, dtype=np.int64)
        self._length = np.zeros(self.SLOTS, dtype=np.int64)
        self._pool = np.empty(self.POOL, dtype=np.uint32)
        self._used = 0

    def _keep(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Put id lists into the pool; returns where each begins and its length."""
        length = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        total = int(length.sum())
        if self._used + total > len(self._pool):
            self._pool = np.concatenate([self._pool[: self._used], np.empty(total + self.POOL, dtype=np.uint32)])
        start = self._used + np.cumsum(length) - length
        flat = np.fromiter((i for ids in lists for i in ids), dtype=np.uint32, count=total)
        self._pool[self._used : self._used + total] = flat
        self._used += total
        return start, length

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, each text closed by ``end_id``, and where each text begins."""
        if self._used > 2 * self.POOL:
            self._clear()
        data, offsets = words.buffer(column, lower=False)
        raw = data.tobytes()
        beyond = data >= 0x80
        lowered = words.LOWER[data]
        lowered[:-1][beyond[1:]] = data[:-1][beyond[1:]]  # a mark may follow: upper and lower case compose unlike
        starts, ends = words.runs(_SPLIT[data], offsets)
        letter, mark = _LETTER[data], _MARK[data]
        cut = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
        inner = cut[~np.isin(cut, starts, assume_unique=True)] if len(cut) else cut
        starts = np.sort(np.concatenate([starts, inner]))
        ends = np.sort(np.concatenate([ends, inner]))
        whole = self._whole_texts(raw, offsets)
        if len(whole):  # these texts are one run each
            text_of = np.searchsorted(offsets, starts, side="right") - 1
            keep = ~np.isin(text_of, whole)
            starts = np.concatenate([starts[keep], offsets[whole]])
            ends = np.concatenate([ends[keep], offsets[whole + 1]])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
            special = np.isin(starts, offsets[whole])
        else:
            special = np.zeros(len(starts), dtype=bool)
        hashed = words.hashes(lowered, starts, ends)
        hashed[hashed == 0] = 1
        hashed[special] = 0  # never known
        slot = (hashed >> _SHIFT).astype(np.int64)
        known = self._known[slot] == hashed
        known &= ~special
        start = np.where(known, self._start[slot], 0)
        length = np.where(known, self._length[slot], 0)
        missing = np.flatnonzero(~known)
        if len(missing):
            new, first, of = np.unique(hashed[missing], return_index=True, return_inverse=True)
            plain = new != 0
            at = missing[first[plain]]
            strings = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            lists = [e.ids for e in self._tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
            new_start, new_length = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64)
            new_start[plain], new_length[plain] = self._keep(lists)
            start[missing], length[missing] = new_start[of], new_length[of]
            slots = (new[plain] >> _SHIFT).astype(np.int64)
            self._known[slots] = new[plain]
            # of runs that share a slot numpy keeps the last, for all three arrays alike
            self._start[slots], self._length[slots] = new_start[plain], new_length[plain]
            alone = np.flatnonzero(special)
            if len(alone):
                texts = [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in alone.tolist()]
                lists = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                start[alone], length[alone] = self._keep(lists)
        return self._joined(start, length, words.per_text(starts, offsets), end_id)

    def _whole_texts(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        if not self._by_runs:
            return np.flatnonzero(np.diff(offsets))
        found = set()
        for content in self._special:
            at = raw.find(content)
            while at >= 0:
                found.add(int(np.searchsorted(offsets, at, side="right")) - 1)
                at = raw.find(content, at + 1)
        return np.array(sorted(found), dtype=np.int64)

    def _joined(
        self, start: np.ndarray, length: np.ndarray, first: np.ndarray, end_id: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gather the runs' ids in order; every text's last run is followed by the end id."""
        n = len(first) - 1
        text_of = np.repeat(np.arange(n), np.diff(first))
        places = np.arange(len(start)) + text_of
        closing = first[1:] + np.arange(n)
        all_start = np.zeros(len(start) + n, dtype=np.int64)
        all_length = np.ones(len(start) + n, dtype=np.int64)
        all_start[places], all_length[places] = start, length
        before = np.cumsum(all_length) - all_length
        total = int(all_length.sum())
        ids = self._pool[np.repeat(all_start - before, all_length) + np.arange(total)] if total else self._pool[:0]
        ids[before[closing]] = end_id
        bounds = np.concatenate([[0], before[closing] + 1])
        return ids, bounds


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n_tokens: int, capacity: int, fine: int | None) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then the rest, in pieces of ``fine`` if given."""
    whole = n_tokens // capacity * capacity
    pieces = [(s, capacity) for s in range(0, whole, capacity)]
    step = fine or capacity
    return pieces + [(s, min(step, n_tokens - s)) for s in range(whole, n_tokens, step)]


def tokenised(
    docs: DataFrame,
    path: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    keep_ids: bool = False,
    key: str = "doc_id",
) -> DataFrame:
    """One row per piece: the key, start, length, ids_crc32, doc_tokens, whether it is a window of its
    own, and with ``keep_ids`` the ids as little-endian 32-bit binary."""
    small_batches(docs)
    frame = pick(docs, key, "text")
    fields = [
        frame.schema[key],
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        encoder = _encoder(path)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES // 2):
                ids, bounds = encoder.encode(part.column("text"), end_id)
                raw = ids.astype("<u4").tobytes()
                of, rows, kept = [], [], []
                for d, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    n = high - low
                    # which documents fill gaps depends on their ids alone, so it is the same in every run
                    small = FINE if zlib.crc32(raw[4 * low : 4 * high]) % FILLER == 0 else None
                    for s, size in cuts(n, capacity, small):
                        piece = raw[4 * (low + s) : 4 * (low + s + size)]
                        of.append(d)
                        rows.append((s, size, zlib.crc32(piece), n))
                        if keep_ids:
                            kept.append(piece)
                columns = [part.column(key).take(pa.array(of, pa.int64()))]
                columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return frame.mapInArrow(run, schema)


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over k windows: each piece's window, and the windows' sums in falling order."""
    n = len(sizes)
    sums: list = [None] * (2 * n)
    merged: list = [None] * (2 * n)
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums[i] = np.zeros(k, dtype=np.int64)
        sums[i][0] = size
        heap.append((-size if k > 1 else 0, i))
    heapq.heapify(heap)
    node = n
    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        both = sums[i] + sums[j][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[i] = sums[j] = None
        sums[node], merged[node] = both, (i, j, order)
        heapq.heappush(heap, (int(both[-1] - both[0]), node))
        node += 1
    root = heap[0][1]
    window = np.empty(n, dtype=np.int64)
    todo = [(root, np.arange(k))]
    while todo:
        v, slots = todo.pop()
        if merged[v] is None:
            window[v] = slots[0]
            continue
        i, j, order = merged[v]
        back = np.empty(k, dtype=np.int64)
        back[order] = slots
        todo += [(i, back), (j, back[::-1])]
    return window, sums[root]


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each piece, none above the capacity; the window count starts at the least possible."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, sums = differencing(sizes, k)
        excess = int(np.maximum(sums - capacity, 0).sum())
        if not excess:
            return window
        k += max(1, -(-excess // capacity))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to the pieces: every sequence holds at most ``capacity`` ids.

    ``pieces`` must be stored data, so that its rows keep their numbers if a task is repeated.
    """
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    loose = numbered.where(F.col("length") < capacity)
    groups = int(loose.count()) // group + 1
    dealt = loose.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema.fields]

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", ignore_index=True)
        window = windows(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = 2 * (frame["_group"].to_numpy() + groups * window)
        frame = frame.sort_values(["sequence_id", "_row"], kind="stable", ignore_index=True)
        length = frame["length"]
        frame["offset"] = length.groupby(frame["sequence_id"]).cumsum() - length
        return frame[names]

    # windows of the groups have even numbers, stretches of a whole window odd ones
    packed = dealt.groupBy("_group").applyInPandas(assign, schema)
    alone = numbered.where(F.col("length") >= capacity).select(
        *pieces.columns, (2 * F.col("_row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return pack(staged(tokenised(docs, path, end_id, capacity), "pieces"), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``packed`` made with ``keep_ids``; short ones are padded to the capacity
    unless their length is a power of two. One row per sequence: sequence_id, length, ids (binary)."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("offset")
        ids = b"".join(frame["ids"])
        n = len(ids) // 4
        if n & (n - 1):
            ids += np.full(capacity - n, pad_id, dtype="<u4").tobytes()
        return pd.DataFrame({"sequence_id": frame["sequence_id"].iloc[:1].to_numpy(), "length": [n], "ids": [ids]})

    return packed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, length long, ids binary")
