"""Language-model scores by prediction by partial matching over bytes.

The model is the trie of all contexts of up to ``ORDER`` bytes in the training texts, with the counts of the
bytes that follow. A byte is predicted in the longest context known; a byte that never followed there
costs an escape (as many parts as the context has distinct followers) and is predicted one byte
shorter, where the followers already ruled out are excluded from all counts. Texts begin with padding
symbols and end with an end symbol that is predicted like a byte. Followers of a context are followers of its
suffix, so what exclusion leaves is one number per context, and a pretrained trie scores by table look-ups.

Counting, merging and building run as Spark aggregations over all training texts. The trie is stored in
shards by the last two bytes of the context; tasks read the shards from the shared folder. They
keep the whole trie if it has at most ``HELD`` entries. A larger one is not read by every task: texts form groups of
``GROUP_BYTES``, each group sends its distinct grams to the shards that know them and gets their probabilities back, so a shard
is read once by the task that answers for it.

Beside it each text gets an add-one unigram score over its words. The ``FREQUENT`` most frequent
training words reach all tasks as a table; the others are joined, one row per text and word.

Words and grams are counted by 64-bit keys: grams exactly, words by hash (see ``words``).

Results in special cases: a NULL text counts as empty, which is the end symbol and the end token alone;
a NULL id is a training row; without training texts bytes are uniform over 257 symbols and all words unknown;
repeated rows are scored, and learnt from, each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, staged
from . import words
from .batches import chunks, in_remainder, map_text, pick, small_batches
from .files import read_block

ORDER = 4
SYMBOLS = 257  # bytes and the end
END, PAD = 256, 257
BITS = 9
FREQUENT = 1 << 18
HELD = 6_000_000
SHARD = 500_000
CHUNK = 2 << 20
GROUP_BYTES = 16 << 20
SEGMENT = 1 << 21
TALLY = 2_000_000
WORD, GRAM = 0, 1
END_TOKEN = np.uint64(1)


def _mask(symbols: int) -> int:
    return (1 << (BITS * symbols)) - 1


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The last ORDER + 1 symbols at every byte and end of all texts, packed, about SEGMENT at a time."""
    n = np.diff(offsets)
    symbols = np.full(len(data) + (ORDER + 1) * len(n), PAD, dtype=np.int16)
    for low in range(0, len(data), SEGMENT):
        high = min(low + SEGMENT, len(data))
        first, last = np.searchsorted(offsets, low, side="right") - 1, np.searchsorted(offsets, high, side="left")
        text_of = np.repeat(np.arange(first, last), np.diff(np.clip(offsets[first : last + 1], low, high)))
        symbols[np.arange(low, high) + ORDER + (ORDER + 1) * text_of] = data[low:high]
    symbols[offsets[1:] + (ORDER + 1) * np.arange(1, len(n) + 1) - 1] = END
    for low in range(0, len(symbols), SEGMENT):
        start = max(0, low - ORDER)
        part = symbols[start : low + SEGMENT].astype(np.int64)
        packed = part.copy()
        for back in range(1, ORDER + 1):
            packed[back:] |= part[: len(part) - back] << (BITS * back)
        yield packed[low - start :][part[low - start :] != PAD]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text begins."""
    data, offsets = words.buffer(column)
    starts, ends = words.runs(words.NOT_SPACE[data], offsets)
    hashed = words.hashes(data, starts, ends)
    hashed[hashed == END_TOKEN] = 2
    return hashed, words.per_text(starts, offsets)


class _Tally:
    """Counts by key, merged as they come and handed on before they grow too many."""

    def __init__(self, kind: int):
        self.kind = kind
        self.keys, self.n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(keys, return_counts=True)
        both, of = np.unique(np.concatenate([self.keys, found]), return_inverse=True)
        self.n = np.bincount(of, weights=np.concatenate([self.n, n]), minlength=len(both)).astype(np.int64)
        self.keys = both
        if len(both) > TALLY:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(self.keys), 1 << 16):
            part = slice(low, low + (1 << 16))
            size = len(self.keys[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, self.kind, dtype=np.int32)), pa.array(self.keys[part]), pa.array(self.n[part])],
                names=["kind", "key", "n"],
            )
        self.keys, self.n = self.keys[:0], self.n[:0]


def training_counts(training: DataFrame) -> DataFrame:
    """(kind, key, n): words with the end token, and grams, over all texts of ``training``; stored."""
    small_batches(training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, contexts = _Tally(WORD), _Tally(GRAM)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                column = part.column("text")
                hashed, _ = word_hashes(column)
                ends = np.full(part.num_rows, END_TOKEN)
                yield from tokens.add(np.concatenate([hashed, ends]).view(np.int64))
                for packed in grams(*words.buffer(column, lower=False)):
                    yield from contexts.add(packed)
        yield from tokens.rest()
        yield from contexts.rest()

    rows = pick(training, "text").mapInArrow(run, "kind int, key long, n long")
    return staged(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def _level(keys: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of a shorter order with their counts, sorted."""
    found, of = np.unique(keys & _mask(order + 1), return_inverse=True)
    return found, np.bincount(of, weights=n, minlength=len(found))


def _contexts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of sorted grams: total count and number of followers of each."""
    found, first = np.unique(keys >> BITS, return_index=True)
    followers = np.diff(np.append(first, len(keys)))
    return found, np.add.reduceat(n, first) if len(first) else n, followers


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(x, 1e-300))


def _entries(
    order: int, grams_: tuple[np.ndarray, np.ndarray], shorter: tuple[np.ndarray, np.ndarray]
) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Table rows of one order: (kind, keys, values). Grams hold ln n; of the top order ln of the whole
    probability. Contexts hold the ln of: the total with escapes, the escapes; then, one byte shorter
    with this context's followers excluded, the total with escapes and the escape's probability."""
    keys, n = grams_
    contexts, total, followers = _contexts(keys, n)
    in_context = np.searchsorted(contexts, keys >> BITS)
    below_contexts, below_total, below_followers = _contexts(*shorter)
    excluded = np.bincount(
        in_context, weights=shorter[1][np.searchsorted(shorter[0], keys & _mask(order))], minlength=len(contexts)
    )
    below = np.searchsorted(below_contexts, contexts & _mask(order - 1))
    others = below_followers[below] - followers
    left = below_total[below] - excluded + others
    whole = _log(total + followers)
    value = np.log(n) - (whole[in_context] if order == ORDER else 0)
    escape = np.where(others > 0, _log(others) - _log(left), 0.0)
    return [(2 * order, keys, [value]), (2 * order + 1, contexts, [whole, np.log(followers), _log(left), escape])]


def build_shard(
    keys: np.ndarray, n: np.ndarray, low: tuple[np.ndarray, np.ndarray]
) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
    """All entries of orders 2 and more of a shard of sorted top-order grams; ``low`` are the order-1 grams."""
    out = []
    levels = {ORDER: (keys, n)} | {k: _level(keys, n, k) for k in range(2, ORDER)} | {1: low}
    for order in range(2, ORDER + 1):
        out += _entries(order, levels[order], levels[order - 1])
    return out


class _Table:
    """Numbers by key: open addressing over arrays."""

    def __init__(self, keys: np.ndarray, values: list[np.ndarray]):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = [np.zeros(1 << self.bits) for _ in values]
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]  # of rivals for a slot the last written stays
            won = self.keys[slot] == keys[todo]
            for mine, given in zip(self.values, values, strict=True):
                mine[slot[won]] = given[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, slot, -1)
        todo = np.flatnonzero((there != keys) & (there != -1))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = slot[hit]
            more = ~hit & (there != -1)
            todo, slot = todo[more], slot[more]
        return out


class Trie:
    """Entries of some shards and of the orders below 2, for scoring."""

    def __init__(self, entries: list[tuple[int, np.ndarray, list[np.ndarray]]], low: tuple[np.ndarray, np.ndarray]):
        entries = list(entries)
        root = _level(*low, 0)
        if len(low[0]):
            entries += _entries(1, low, root)
            contexts, total, followers = _contexts(*root)
            entries += [(0, root[0], [np.log(root[1])])]
            entries += [(1, contexts, [_log(total + followers), np.log(followers), np.zeros(1), np.zeros(1)])]
        self.last = -math.log(SYMBOLS - len(root[0])) if len(root[0]) < SYMBOLS else 0.0
        self.grams, self.contexts = {}, {}
        for order in range(ORDER + 1):
            self.grams[order] = self._table(entries, 2 * order, 1)
            self.contexts[order] = self._table(entries, 2 * order + 1, 4)

    @staticmethod
    def _table(entries: list, kind: int, width: int) -> _Table:
        own = [(k, v) for found, k, v in entries if found == kind]
        if not own:
            return _Table(np.empty(0, dtype=np.int64), [np.empty(0)] * width)
        return _Table(np.concatenate([k for k, _ in own]), [np.concatenate([v[i] for _, v in own]) for i in range(width)])

    def log_probabilities(self, packed: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the last symbol of each gram after the others."""
        top = self.grams[ORDER]
        at = top.find(packed)
        out = np.where(at >= 0, top.values[0][at], 0.0)
        todo = np.flatnonzero(at < 0)
        whole, escapes, left, escape = (np.zeros(len(todo)) for _ in range(4))
        entered = np.zeros(len(todo), dtype=bool)
        for order in range(ORDER, -1, -1):
            gram = packed[todo] & _mask(order + 1)
            if order < ORDER:
                at = self.grams[order].find(gram)
                hit = at >= 0
                value = self.grams[order].values[0][at]
            else:
                hit, value = np.zeros(len(todo), dtype=bool), np.zeros(len(todo))
            context = self.contexts[order].find(gram >> BITS)
            known = context >= 0
            own = [v[context] for v in self.contexts[order].values]
            out[todo] += np.where(hit, value - np.where(entered, left, own[0]), 0)
            out[todo] += np.where(~hit & entered, escape, 0) + np.where(~hit & ~entered & known, own[1] - own[0], 0)
            stay = ~hit
            todo = todo[stay]
            entered = (entered | known)[stay]
            left, escape = own[2][stay], own[3][stay]
        out[todo] += self.last
        return out


@functools.lru_cache(maxsize=1)
def _trie(addresses: tuple[str, ...], low: tuple[bytes, bytes]) -> Trie:
    entries = []
    for address in addresses:
        table = read_block(address)
        kinds = table["kind"].to_numpy()
        for kind in np.unique(kinds).tolist():
            own = table.filter(pc.equal(table["kind"], kind))
            width = 1 if kind % 2 == 0 else 4
            entries.append((kind, own["key"].to_numpy(), [own[c].to_numpy() for c in "abcd"[:width]]))
    return Trie(entries, (np.frombuffer(low[0], dtype=np.int64), np.frombuffer(low[1], dtype=np.float64)))


class StoredTrie:
    """Where a trie lies: files by shard, the small orders, and how many entries there are."""

    def __init__(self, files: list[tuple[str, ...]], low: tuple[bytes, bytes], entries: int):
        self.files, self.low, self.whole = files, low, entries <= HELD

    def score(self, packed: np.ndarray) -> np.ndarray:
        """Natural log probabilities of grams, with all entries in memory."""
        return _trie(tuple(f for files in self.files for f in files), self.low).log_probabilities(packed)

    def score_in(self, number: int, packed: np.ndarray) -> np.ndarray:
        """Those of grams of one shard, with that shard's entries in memory."""
        return _trie(self.files[number], self.low).log_probabilities(packed)


class LookedUp:
    """Log probabilities found elsewhere, of the grams of a group of texts."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.table = _Table(keys, [values])

    def score(self, packed: np.ndarray) -> np.ndarray:
        return self.table.values[0][self.table.find(packed)]


def looked_up(grouped: DataFrame, trie: StoredTrie) -> DataFrame:
    """(_group, key, value): every gram of each group of texts once, with its log probability.

    The grams go to the shard that knows them, so a task reads the entries of its shards once, however many texts there are.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                group = part.column("_group").to_numpy()
                for number in np.unique(group).tolist():
                    data, offsets = words.buffer(part.column("text").filter(pa.array(group == number)), lower=False)
                    for packed in grams(data, offsets):
                        keys = np.unique(packed)
                        columns = [pa.array(np.full(len(keys), number, dtype=np.int32)), pa.array(keys)]
                        yield pa.RecordBatch.from_arrays(columns, names=["_group", "key"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, keys = batch.column("shard").to_numpy(), batch.column("key").to_numpy()
            values = np.zeros(len(keys))
            for number in np.unique(shard).tolist():
                at = np.flatnonzero(shard == number)
                values[at] = trie.score_in(number, keys[at])
            yield pa.RecordBatch.from_arrays([batch.column("_group"), batch.column("key"), pa.array(values)], names=["_group", "key", "value"])

    shards = len(trie.files)
    asked = grouped.select("_group", "text").mapInArrow(distinct, "_group int, key long").distinct()
    dealt = asked.withColumn("shard", _shard_column("key", shards)).repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(look_up, "_group int, key long, value double")


def _shard_column(key: str, shards: int) -> Column:
    context = F.shiftright(key, BITS).bitwiseAND(F.lit(_mask(2)))
    return F.pmod(context * F.lit(40503), F.lit(shards)).cast("int")


def build_trie(counts: DataFrame) -> StoredTrie:
    """Store the trie of the gram counts in the shared folder."""
    spark = counts.sparkSession
    gram_counts = counts.where(F.col("kind") == GRAM)
    # at most 258 x 257 rows
    pairs = gram_counts.groupBy(F.col("key").bitwiseAND(F.lit(_mask(2))).alias("key")).agg(F.sum("n").alias("n"))
    small = sorted((r["key"], float(r["n"])) for r in pairs.collect())
    low = (np.array([k for k, _ in small], dtype=np.int64), np.array([n for _, n in small], dtype=np.float64))
    total = gram_counts.count()
    shards = total // SHARD + 1
    dealt = gram_counts.withColumn("shard", _shard_column("key", shards))
    schema = "shard int, kind int, key long, a double, b double, c double, d double"

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        keys, n = table["key"].to_numpy(), table["n"].to_numpy().astype(np.float64)
        parts = []
        for kind, found, values in build_shard(keys, n, low):
            columns = {"shard": pa.array(np.full(len(found), table["shard"][0].as_py(), dtype=np.int32))}
            columns |= {"kind": pa.array(np.full(len(found), kind, dtype=np.int32)), "key": pa.array(found)}
            columns |= {c: pa.array(v) for c, v in zip("abcd", values, strict=False)}
            columns |= {c: pa.nulls(len(found), pa.float64()) for c in "abcd"[len(values) :]}
            parts.append(pa.table(columns))
        return pa.concat_tables(parts)

    path = scratch_path(spark, "trie")
    dealt.groupBy("shard").applyInArrow(build, schema).write.partitionBy("shard").parquet(path)
    found: dict[int, list[str]] = {}
    entries = 0
    if total:
        stored = spark.read.parquet(path)
        entries = stored.count()
        for address in sorted(stored.inputFiles()):
            found.setdefault(int(address.rsplit("shard=", 1)[1].split("/", 1)[0]), []).append(address)
    files = [tuple(found.get(number, ())) for number in range(shards)]
    return StoredTrie(files, (low[0].tobytes(), low[1].tobytes()), entries)


def score(docs: DataFrame, training: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: the key, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    small_batches(docs)
    spark = docs.sparkSession
    counts = training_counts(training)
    trie = build_trie(counts)
    vocabulary = counts.where(F.col("kind") == WORD).select("key", "n")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = vocabulary.orderBy(F.desc("n"), "key").limit(FREQUENT).union(vocabulary.where(F.col("key") == int(END_TOKEN)))
    top = sorted({(r["key"], r["n"]) for r in top.collect()})
    # the frequent words are a table of at most FREQUENT rows; the trie's place is a few addresses
    shared = spark.sparkContext.broadcast(
        (np.array([k for k, _ in top], dtype=np.int64), np.array([n for _, n in top], dtype=np.float64), trie)
    )
    frame = pick(docs, key, "text")
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_frequent", T.LongType()),
        T.StructField("frequent_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rare", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]
    schema = T.StructType([frame.schema[key], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, stored = shared.value
        known = _Table(keys, [np.log10(n + 1)])
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                made = _scored(part.column("text"), known, stored)
                yield pa.RecordBatch.from_arrays([part.column(key), *made], names=[key, *[f.name for f in fields]])

    if trie.whole:
        made = frame.mapInArrow(run, schema)
    else:
        size = frame.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(size // GROUP_BYTES + 1)).cast("int")
        grouped = staged(frame.withColumn("_group", group), "grouped")

        def finish(texts: pa.Table, found: pa.Table) -> pa.Table:
            order = np.argsort(keys := found["key"].to_numpy())
            of_group = LookedUp(keys[order], found["value"].to_numpy()[order])
            known = _Table(shared.value[0], [np.log10(shared.value[1] + 1)])
            parts = []
            for batch in texts.to_batches():
                for part in chunks(batch, "text", CHUNK):
                    columns = [part.column(key), *_scored(part.column("text"), known, of_group)]
                    parts.append(pa.RecordBatch.from_arrays(columns, names=[key, *[f.name for f in fields]]))
            return pa.Table.from_batches(parts)

        made = grouped.groupBy("_group").cogroup(looked_up(grouped, trie).groupBy("_group")).applyInArrow(finish, schema)
    scored = staged(made.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    joined = rare.join(vocabulary, F.col("r.rare") == F.col("key"))
    of_rare = joined.groupBy("_row").agg(
        F.sum(F.col("r.times") * F.log10(F.col("n") + F.lit(1.0))).alias("rare_score"),
        F.sum("r.times").alias("n_rare"),
    )
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    weight = F.lit(math.log10(total + distinct + 1))
    return scored.join(of_rare, "_row", "left").select(
        key,
        "n_tokens",
        (F.col("n_frequent") + none("n_rare")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("frequent_score") + none("rare_score") - F.col("n_tokens") * weight).alias("base_score"),
        "score",
    )


def _sums(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over each text's stretch; 0 for an empty one."""
    out = np.zeros(len(first))
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(values, first[some])
    return out


def _text_scores(column: pa.Array, stored: StoredTrie | LookedUp) -> np.ndarray:
    """Natural log probability of each text and its end."""
    data, offsets = words.buffer(column, lower=False)
    first = offsets[:-1] + np.arange(len(column))  # every text has a symbol at least, its end
    total, done = np.zeros(len(column)), 0
    for packed in grams(data, offsets):
        if not len(packed):
            continue
        low = int(np.searchsorted(first, done, side="right")) - 1
        high = int(np.searchsorted(first, done + len(packed), side="left"))
        total[low:high] += np.add.reduceat(stored.score(packed), np.maximum(first[low:high], done) - done)
        done += len(packed)
    return total


def _scored(column: pa.Array, known: _Table, stored: StoredTrie | LookedUp) -> list[pa.Array]:
    n_texts = len(column)
    hashed, bounds = word_hashes(column)
    n_words = np.diff(bounds)
    keys = hashed.view(np.int64)
    at = known.find(keys)
    value = np.where(at >= 0, known.values[0][at], 0.0)
    frequent = _sums((at >= 0).astype(float), bounds[:-1], n_words).astype(np.int64)
    base = _sums(value, bounds[:-1], n_words)
    end = known.find(np.array([END_TOKEN]).view(np.int64))[0]  # in the table whatever its count
    if end >= 0:
        base += known.values[0][end]
        frequent += 1
    rare = np.flatnonzero(at < 0)
    text_of = np.repeat(np.arange(n_texts), n_words)[rare]
    order = np.lexsort((keys[rare], text_of))
    text_of, found = text_of[order], keys[rare][order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (text_of[1:] != text_of[:-1]) | (found[1:] != found[:-1])
    begins = np.flatnonzero(new)
    times = np.diff(np.append(begins, len(found)))
    places = np.searchsorted(text_of[begins], np.arange(n_texts + 1)).astype(np.int32)
    total = _text_scores(column, stored) / math.log(10)
    return [
        pa.array(n_words + 1),
        pa.array(frequent),
        pa.array(base),
        pa.array(total),
        pa.ListArray.from_arrays(pa.array(places), pa.array(found[begins])),
        pa.ListArray.from_arrays(pa.array(places), pa.array(times)),
    ]


class AdaptiveModel:
    """The same prediction with counts that grow while a text is read, one symbol at a time."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.followers: dict[bytes, dict[int, int]] = {}

    def cost(self, context: bytes, symbol: int) -> float:
        """Bits of a symbol after a context, escapes and exclusions included."""
        bits, excluded = 0.0, set()
        for length in range(min(self.order, len(context)), -1, -1):
            counted = self.followers.get(context[len(context) - length :])
            if counted is None:
                continue
            free = {s: n for s, n in counted.items() if s not in excluded}
            if not free:
                continue
            whole = sum(free.values()) + len(free)
            if symbol in free:
                return bits + math.log2(whole / free[symbol])
            bits += math.log2(whole / len(free))
            excluded |= free.keys()
        return bits + math.log2(SYMBOLS - len(excluded))

    def learn(self, context: bytes, symbol: int) -> None:
        for length in range(min(self.order, len(context)) + 1):
            counted = self.followers.setdefault(context[len(context) - length :], {})
            counted[symbol] = counted.get(symbol, 0) + 1

    def code_length(self, text: str) -> float:
        """Bits of the text and its end, learning from every symbol after it is coded."""
        data, total = text.encode(), 0.0
        for i, symbol in enumerate([*data, END]):
            context = data[max(0, i - self.order) : i]
            total += self.cost(context, symbol)
            self.learn(context, symbol)
        return total


def adaptive_code_length(docs: DataFrame, order: int = ORDER, key: str = "doc_id") -> DataFrame:
    """Per row: the key and ``bits``, the code length of the text by a model that starts empty."""

    def work(texts: list[str | None]) -> dict[str, list]:
        return {"bits": [AdaptiveModel(order).code_length(t or "") for t in texts]}

    return map_text(pick(docs, key, "text"), work, T.StructType([T.StructField("bits", T.DoubleType())]))


def language_model_report(docs: DataFrame) -> DataFrame:
    """Scores of all documents by what those that are not held out teach."""
    held = in_remainder(F.col("doc_id"), 7, 2)
    training = pick(docs, "doc_id", "text").where(~held)
    return score(docs, training).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
