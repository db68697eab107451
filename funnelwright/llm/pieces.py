"""Encoding to the pieces of a merge-type (BPE) vocabulary, and decoding.

A text is normalised as its model says and begins as a row of characters. An agenda holds the adjacent
pairs of symbols that are pieces when joined, ordered by score, then by place. The best pair is merged, and the
pairs its new symbol makes with its neighbours replace those on the agenda that its parts made. What remains when the
agenda is empty are the pieces; a character that is none becomes the pieces of its bytes, or the unknown piece.

No merge crosses two characters that stand side by side in no piece. Where a vocabulary lets spaces only begin
pieces a text is cut into words there, and the ids of a word are kept for when it comes again. The new
words of a batch are merged together: their agendas are one array, of which every round takes each word's first
entry. Long words have an agenda of their own, a heap.

The result is checked against the sentencepiece library, batch by batch: every word when it is new, and the longest text
of the batch as a whole. A difference fails the job. That
happens with vocabularies of another kind than merges, or with unused pieces or symbols a user defined. Where
words do not stand alone, a text is one word, so all texts are checked.

Results in special cases: a NULL or empty text has no pieces and decodes to the empty text; white space, control
characters, and characters the vocabulary lacks come back as the model's normalisation leaves them; any
length is encoded whole, in memory linear in it; repeated rows are all encoded; an empty table gives an
empty result; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_text, pick

SPACE = "▁"  # fixed value: what vocabularies of this kind write for a space
# Words whose ids a worker keeps, and the longest such word.
KEPT_WORDS, KEPT_LENGTH = 500_000, 64
# Characters of new words merged together.
TOGETHER = 1 << 20
PLACE_BITS = 32
PLACES = (1 << PLACE_BITS) - 1
NEVER = 1 << 30  # a rank beyond all
POINTS = 0x110000  # fixed value: code points there are


class Pieces:
    """A vocabulary, and the encoding of texts by it."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids = {
            model.id_to_piece(i): i
            for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        scores = sorted({model.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: rank for rank, score in enumerate(scores)}
        self.ranks = {piece: place[model.get_score(i)] for piece, i in self.ids.items()}
        self.unknown = model.unk_id()
        in_bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = in_bytes if all(model.is_byte(i) for i in in_bytes) else None
        self.adjacent = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        # spaces only begin pieces: then every word with the spaces before it stands alone
        words = all(pair[0] == SPACE or pair[1] != SPACE for pair in self.adjacent)
        # and with a space put before every text, each word begins with one
        self.prefixed = words and model.normalize("a b") == f"{SPACE}a{SPACE}b"
        self.word = re.compile(f"{SPACE}+[^{SPACE}]*") if self.prefixed else re.compile(r"[\s\S]+")
        self.kept: dict[str, tuple[int, ...]] = {}
        self.long: list[str] = []
        self.numerals = [str(i) for i in range(size)]
        # a symbol is a piece's id, or above all ids a character that is no piece
        self.alphabet = size + np.arange(POINTS, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.alphabet[ord(piece)] = i
        # what two pieces make together: the pair as one number, sorted, with rank and id of the piece made
        parts = [
            (self.ids[piece[:i]] * (size + POINTS) + self.ids[piece[i:]], self.ranks[piece], made)
            for piece, made in self.ids.items()
            for i in range(1, len(piece))
            if piece[:i] in self.ids and piece[i:] in self.ids
        ]
        self.size = size
        self.pairs, self.pair_ranks, self.pair_ids = np.array(sorted(parts) or [(-1, 0, 0)], dtype=np.int64).T.copy()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of the pieces of each text."""
        worded = [self.word.findall(self.library.normalize(text)) for text in texts]
        kept = self.kept
        if len(kept) > KEPT_WORDS:
            kept.clear()
        new = list(set(chain.from_iterable(worded)).difference(kept))
        self.keep(new)
        # normalising a word without its first space gives the word again, if there is more of it
        tested = [word for word in new if word != SPACE]
        self.compare([word[1:] if self.prefixed else word for word in tested], [kept[word] for word in tested])
        found = [list(chain.from_iterable(map(kept.__getitem__, words))) for words in worded]
        for word in self.long:
            del kept[word]
        self.long.clear()
        if self.bytes is None:  # neighbouring unknown symbols are one piece
            found = [[x for i, x in enumerate(ids) if x != self.unknown or not i or ids[i - 1] != x] for ids in found]
        return found

    def keep(self, words: Iterable[str]) -> None:
        """Find the ids of new words, the short ones merged together, the others noted in ``long``."""
        held: list[str] = []
        size = 0
        for word in words:
            if len(word) > KEPT_LENGTH:
                self.kept[word] = tuple(chain.from_iterable(map(self.merged, self.runs(word))))
                self.long.append(word)
                continue
            held.append(word)
            size += len(word)
            if size >= TOGETHER:
                self.merged_together(held)
                held, size = [], 0
        if held:
            self.merged_together(held)

    def merged_together(self, words: list[str]) -> None:
        """Keep the ids of the words. Every round merges the best pair of each word that has one."""
        kept = self.kept
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        symbols = self.alphabet[points]
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        names = np.arange(len(words))
        last = np.cumsum(lengths) - 1
        rank, made = self.looked_up(symbols[:-1], symbols[1:])
        rank, made = np.append(rank, NEVER), np.append(made, 0)
        rank[last] = NEVER  # no pair reaches into the next word
        while len(names):
            starts = np.cumsum(lengths) - lengths
            # the first entry of each word's agenda: lowest rank, then leftmost
            entry = np.minimum.reduceat(rank << PLACE_BITS | np.arange(len(rank)), starts)
            best = entry & PLACES
            going = entry >> PLACE_BITS < NEVER
            if not going.all():
                done = ~going
                whole = symbols[np.repeat(done, lengths)]
                ends = np.cumsum(lengths[done])
                flat, lacking = whole.tolist(), np.logical_or.reduceat(whole >= self.size, ends - lengths[done]).tolist()
                ends = ends.tolist()
                for n, begin, end, lacks in zip(names[done].tolist(), [0, *ends[:-1]], ends, lacking, strict=True):
                    ids = flat[begin:end]
                    kept[words[n]] = tuple(chain.from_iterable(map(self.named, ids)) if lacks else ids)
                stay = np.repeat(going, lengths)
                best = (np.cumsum(stay) - 1)[best[going]]
                symbols, rank, made = symbols[stay], rank[stay], made[stay]
                names, lengths = names[going], lengths[going]
                if not len(names):
                    return
                starts = np.cumsum(lengths) - lengths
            symbols[best] = made[best]
            rank[best] = NEVER
            left = np.ones(len(symbols), dtype=bool)
            left[best + 1] = False
            symbols, rank, made = symbols[left], rank[left], made[left]
            best -= np.arange(len(best))  # one symbol fewer for every word before
            starts -= np.arange(len(best))
            lengths = lengths - 1
            # the pairs of the new symbol with its neighbours
            before = best[best > starts] - 1
            after = best[best < starts + lengths - 1]
            for places in (before, after):
                rank[places], made[places] = self.looked_up(symbols[places], symbols[places + 1])

    def named(self, symbol: int) -> list[int]:
        """The ids of a symbol: of its piece, of its character's bytes, or the unknown one."""
        if symbol < self.size:
            return [symbol]
        return [self.unknown] if self.bytes is None else [self.bytes[b] for b in chr(symbol - self.size).encode()]

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what pairs of pieces make; rank ``NEVER`` where that is no piece."""
        pair = left * (self.size + POINTS) + right
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[place] == pair
        return np.where(known, self.pair_ranks[place], NEVER), self.pair_ids[place]

    def runs(self, word: str) -> Iterator[str]:
        """The word cut between characters that stand side by side in no piece."""
        cuts = [i for i, pair in enumerate(zip(word, word[1:], strict=False), 1) if pair not in self.adjacent]
        for begin, end in zip([0, *cuts], [*cuts, len(word)], strict=True):
            yield word[begin:end]

    def merged(self, run: str) -> list[int]:
        """The ids of a run of characters, by merging the best pair on the agenda until it is empty.

        An entry of the agenda is the rank of a pair's score and the place of its left symbol in one number.
        """
        ranks, n = self.ranks, len(run)
        symbols = list(run)  # empty: merged into a symbol before it
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = map(str.__add__, run, run[1:])
        agenda = [ranks[pair] << PLACE_BITS | i for i, pair in enumerate(pairs) if pair in ranks]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & PLACES
            right = after[left]
            if not symbols[left] or right >= n:
                continue
            joined = symbols[left] + symbols[right]
            if ranks.get(joined) != entry >> PLACE_BITS:
                continue  # a symbol has changed since; its new pair has an entry of its own
            symbols[left], symbols[right] = joined, ""
            leader, follower = before[left], after[right]
            after[left] = follower
            if follower < n:
                before[follower] = left
                rank = ranks.get(joined + symbols[follower])
                if rank is not None:
                    heapq.heappush(agenda, rank << PLACE_BITS | left)
            if leader >= 0:
                rank = ranks.get(symbols[leader] + joined)
                if rank is not None:
                    heapq.heappush(agenda, rank << PLACE_BITS | leader)
        left = [self.ids[s] if s in self.ids else self.size + ord(s) for s in symbols if s]
        return list(chain.from_iterable(map(self.named, left)))

    def checked(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of the texts, compared with those of the library."""
        whole = [text or "" for text in texts]
        found = self.encode(whole)
        if whole:
            longest = max(range(len(whole)), key=lambda i: len(whole[i]))
            self.compare([whole[longest]], [found[longest]])
        return found

    def compare(self, texts: list[str], ids: list[Sequence[int]]) -> None:
        """Fail if the library has other ids for a text."""
        for text, own, right in zip(texts, ids, self.library.encode(texts, num_threads=1), strict=True):
            if list(own) != right:
                raise ValueError(f"not a vocabulary of merges: the library differs on a text beginning {text[:40]!r}")

    def decode(self, ids: list[int] | None) -> str:
        """The text of the ids."""
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    """The vocabulary of a model file, loaded once per worker."""
    return Pieces(path)


def encode(docs: DataFrame, path: str, into: str = "piece_ids") -> DataFrame:
    """The documents with the ids of their pieces in place of the text."""

    def work(texts: list[str | None]) -> dict[str, list]:
        return {into: vocabulary(path).checked(texts)}

    return map_text(docs, work, T.StructType([T.StructField(into, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids: str = "piece_ids", into: str = "text") -> DataFrame:
    """Encoded rows with their text in place of the ids."""
    import pyarrow as pa

    kept = [f for f in encoded.schema.fields if f.name != ids]
    schema = T.StructType([*kept, T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            texts = pa.array([model.decode(x) for x in batch.column(ids).to_pylist()], pa.string())
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, texts], names=[*(f.name for f in kept), into])

    return encoded.mapInArrow(run, schema)


def piece_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids (decimal, joined by commas) and of the text decoded from them."""

    def work(texts: list[str | None]) -> dict[str, list]:
        model = vocabulary(path)
        found = model.checked(texts)
        numeral = model.numerals.__getitem__
        return {
            "n_tokens": [len(ids) for ids in found],
            "ids_sha256": [hashlib.sha256(",".join(map(numeral, ids)).encode()).hexdigest() for ids in found],
            "decoded_sha256": [hashlib.sha256(model.decode(ids).encode()).hexdigest() for ids in found],
        }

    added = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return map_text(pick(docs, "doc_id", "text"), work, added)
