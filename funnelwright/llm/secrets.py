"""Finding secrets: fixed patterns, and strings in sensitive context that zstandard cannot predict.

A candidate is a long string of letters and digits shortly before or after a sensitive word, or a
reported candidate, so that the lines of one block are followed to its end; or whatever a sensitive word is said to
be (``password is ...``, ``pwd=...``), or the password of a URL, whatever its characters.

Its novelty is the number of bytes by which the compressed context grows when the candidate is added, as a share of
the bytes that random strings of the same alphabet and length add in its place. The compressor is primed with a
dictionary of words: those of a public tokenizer's vocabulary, and the parts of identifiers that are frequent in
the corpus, learnt in a Spark pass. The context is the text around, less what repeats the candidate itself: a
secret that is given twice is no less secret. Case is folded, and every character is written as two bytes: a
match of a few letters then already costs less than the letters. Strings of at least ``MIN_NOVELTY`` of
random ones are reported as kind ``novel``.

Results in special cases: a NULL text counts as empty; an empty text has no spans; strings of fewer than ``LEAST``
characters, and strings without a letter or without a digit that no sensitive word is said to be, are no candidates; repeated rows
give one result each; other columns of the input are not read.
"""

from __future__ import annotations

import json
import random
import re
import string
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import chunks, map_text, pick, small_batches

# The patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # a run is entered at its first character only
KINDS = ["assign", "access", "hex", "novel"]
MIN_ASSIGNED, MIN_ACCESS = 6, 20

# Words that make the text on both sides sensitive, and how far that reaches, from reported strings also.
SENSITIVE = ["password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "api-key", "api key",
             "access_key", "accesskey", "access key", "private_key", "privatekey", "private key", "accountkey",
             "account_key", "credential", "authorization", "bearer", "akia"]
# What a sensitive word is said to be, and the password of a URL, in text of folded case.
SAID = re.compile(
    r"(?:password|passwd|pwd|passphrase|secret|token|credentials?|(?:api|access|private|account)[_\x20-]?key(?:_id)?)"
    r"[\"'`]?\s*(?:is\b|:=|=>|[:=])\s*[\"'`]?([^\s\"'`<>]{16,}+)"
)
IN_URL = re.compile(r"://[^\s:/@\"'`<>]{1,64}:([^\s/@\"'`<>]{8,}+)@")
REACH = 96
AROUND = 256
LEAST = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
BREAK = re.compile(r"[\x20\t]*\r?\n[\x20\t]*|\\")  # between lines, or the backslash of an escaped line end
LINE = re.compile(r"(?:[\x20\t]*\r?\n[\x20\t]*|\\)([A-Za-z0-9+/_-]++={0,2})(?=[\x20\t]*\r?(?:\n|\Z)|\\)")
PIECE = 512  # characters of a candidate measured at once; a longer one is cut evenly and reported whole
MIN_NOVELTY = 0.82
LEVEL, RANDOM_STRINGS = 19, 6
# Words of the dictionary learnt from the corpus, and the different identifiers a word must be part of.
LEARNT, LEAST_IDENTIFIERS = 16_384, 3
# Words of code, for use without a vocabulary file.
IDENTIFIERS = (
    "abstract access account admin args array async await bearer boolean bucket buffer cache char class client "
    "config connection const context create credential database default delete double element endpoint environment "
    "error event example execute export extends false field filename final float format function getElementById "
    "handler header host import index input instance integer interface iterator key label length listener logger "
    "message method module namespace null object option output package parameter parser password path pattern port "
    "private property protected public query request response result return schema secret server service session "
    "static status stream string struct synchronized template throw timeout timestamp token true undefined update "
    "user username value variable version void while"
).split()

Span = tuple[str, int, int]

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


def fixed_spans(text: str, folded: str) -> list[Span]:
    """Matches of the fixed patterns; code points, end exclusive. ``folded`` is the text in lower case."""
    found: list[Span] = []
    if any(w in folded for w in ("passw", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def vocabulary_words(path: str | None) -> list[str]:
    """The words of four letters or more in a tokenizer's vocabulary file (JSON), most frequent first."""
    if path is None:
        return IDENTIFIERS
    with open(path, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    found = (part.lower() for piece in sorted(pieces, key=pieces.get) for part in re.findall("[A-Za-z]{4,}", piece))
    return list(dict.fromkeys(found))


def learnt_words(docs: DataFrame, text: str = "text", most: int = LEARNT) -> list[str]:
    """The parts that most identifiers of the corpus share, most frequent first.

    An identifier counts once however often it occurs, so copies of a secret make none of its parts frequent;
    a part needs ``LEAST_IDENTIFIERS`` of them.
    """
    shape, part = F.lit(r"[A-Za-z0-9_/-]{16,}+"), F.lit(r"[A-Z]?[a-z]{3,15}|[A-Z]{4,16}")
    whole = pick(docs, text).select(F.explode(F.regexp_extract_all(text, shape, F.lit(0))).alias("whole")).distinct()
    parts = whole.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("whole", part, F.lit(0)), F.lower))).alias("part"))
    counted = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_IDENTIFIERS)
    return [row["part"] for row in counted.orderBy(F.desc("n"), "part").limit(most).collect()]


# Every byte of folded text as two.
_SECOND = bytes((c * 7 + 13) & 255 for c in range(256))


def widened(text: str) -> bytes:
    """The text in lower case, each byte followed by another that depends on it."""
    plain = text.lower().encode("utf-8", "surrogatepass")
    out = bytearray(2 * len(plain))
    out[::2], out[1::2] = plain, plain.translate(_SECOND)
    return bytes(out)


class Novelty:
    """Marginal compressed size of a string against its surroundings and a dictionary of words."""

    def __init__(self, words: Sequence[str] = IDENTIFIERS):
        # the first words last: what is near costs least
        primer = zstandard.ZstdCompressionDict(widened(" ".join(reversed(words))), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, min_match=5)
        primer.precompute_compress(compression_params=settings)
        self._compressor = zstandard.ZstdCompressor(dict_data=primer, compression_params=settings)

    def _size(self, text: str) -> int:
        return len(self._compressor.compress(widened(text)))

    def of(self, before: str, candidate: str, after: str) -> float:
        """The bytes that the candidate adds, as a share of those of random strings like it; the surroundings
        come first, so it may copy from both. The random strings follow from the candidate, for the same result each time."""
        around = f"{before} {after} "
        alone = self._size(around)
        dice = random.Random(candidate)
        letters = alphabet(candidate.lower())
        others = ("".join(dice.choices(letters, k=len(candidate))) for _ in range(RANDOM_STRINGS))
        expected = sum(self._size(around + other) - alone for other in others) / RANDOM_STRINGS
        return (self._size(around + candidate) - alone) / max(expected, 1)


def alphabet(folded: str) -> str:
    """The characters a string is drawn from: hexadecimal digits, or whole classes it has characters of and its others."""
    here = set(folded)
    if here <= set("0123456789abcdef") and here & set(string.digits):
        return "0123456789abcdef"
    classes = [c for c in (string.ascii_lowercase, string.digits) if here & set(c)]
    return "".join(classes) + "".join(sorted(here - set(string.ascii_lowercase + string.digits)))


@lru_cache(maxsize=2)
def _primed(words: tuple[str, ...]) -> Novelty:
    """One compressor per worker."""
    return Novelty(words)


def without_copies(around: str, candidate: str) -> str:
    """The surroundings with a space for every stretch of ``LEAST`` or more characters that the candidate also has."""
    shared = {candidate[i : i + LEAST] for i in range(len(candidate) - LEAST + 1)}
    parts, done, covered = [], 0, 0
    for i in range(len(around) - LEAST + 1):
        if around[i : i + LEAST] in shared:
            if i >= covered:
                parts += [around[done:i], " "]
            done = covered = i + LEAST
    return "".join(parts) + around[done:]


def is_novel(text: str, start: int, end: int, novelty: Novelty, least: float) -> bool:
    """Whether the candidate, or a piece of one longer than ``PIECE``, does not compress."""
    count = -(-(end - start) // PIECE)
    for i in range(count):
        low, high = start + (end - start) * i // count, start + (end - start) * (i + 1) // count
        string, wide = text[low:high], AROUND + high - low  # a copy across the border is seen whole
        before = without_copies(text[max(0, low - wide) : low], string)[-AROUND:]
        after = without_copies(text[high : high + wide], string)[:AROUND]
        if novelty.of(before, string, after) >= least:
            return True
    return False


def same_block(text: str, one: tuple[int, int], two: tuple[int, int]) -> bool:
    """Whether two strings are of equal length and stand on successive lines."""
    return one[1] - one[0] == two[1] - two[0] and BREAK.fullmatch(text, one[1], two[0]) is not None


def rest_of_blocks(text: str, found: list[Span]) -> list[Span]:
    """Lines that end a block of at least two reported lines of equal length, if no longer than these.

    The last line of a wrapped key may be too short, or without digits, to be a candidate.
    """
    out, reported = [], set(found)
    for (_, *above), (_, start, end) in pairwise(found):
        if same_block(text, tuple(above), (start, end)):
            length, line = end - start, LINE.match(text, end)
            while line and line.end(1) - line.start(1) <= length and (last := ("novel", *line.span(1))) not in reported:
                out.append(last)
                line = LINE.match(text, line.end(1)) if line.end(1) - line.start(1) == length else None
    return out


def novel_spans(text: str, folded: str, novelty: Novelty, least: float = MIN_NOVELTY) -> list[Span]:
    """Strings with letters and digits within reach of a sensitive word, or of one reported, that do not compress."""
    words = sorted({(m.start(), m.end()) for w in SENSITIVE for m in re.finditer(re.escape(w), folded)})
    if not words:
        return []
    runs = [m.span() for m in CANDIDATE.finditer(text) if DIGIT.search(m[0]) and LETTER.search(m[0])]
    near, i, last = [], 0, -REACH
    for start, end in runs:
        while i < len(words) and words[i][0] < end + REACH:
            last = max(last, words[i][1])
            i += 1
        near.append(start < last + REACH)
    novel: dict[int, bool] = {}
    # forwards, then backwards: what a reported span reaches on one side is found when going to that side
    for order, ahead in ((range(len(runs)), True), (range(len(runs) - 1, -1, -1), False)):
        latest = None
        for k in order:
            start, end = runs[k]
            reached = latest is not None and (start < runs[latest][1] + REACH if ahead else end > runs[latest][0] - REACH)
            if not near[k] and not reached:
                continue
            if k not in novel:
                novel[k] = is_novel(text, start, end, novelty, least)
                if not novel[k] and any(same_block(text, *two) for two in pairwise(runs[max(0, k - 1) : k + 2])):
                    # lines of one block share their letters' frequencies, which compresses some a little
                    novel[k] = novelty.of("", text[start:end], "") >= least
            if novel[k]:
                latest = k
    found = [("novel", *runs[k]) for k in sorted(novel) if novel[k]]
    return found + rest_of_blocks(text, found)


def said_spans(text: str, folded: str, known: list[Span], novelty: Novelty, least: float = MIN_NOVELTY) -> list[Span]:
    """What sensitive words are said to be, and passwords of URLs, if novel and not inside a known span."""
    found: list[Span] = []
    places = [m.span(1) for m in SAID.finditer(folded)] if any(w in folded for w in SENSITIVE) else []
    if "://" in folded:
        places += [m.span(1) for m in IN_URL.finditer(folded)]
    for start, end in sorted(set(places)):
        while end > start and text[end - 1] in ".,;:)]}":
            end -= 1
        covered = any(s <= start and end <= e for _, s, e in known) or any(s <= start and end <= e for _, s, e in found)
        if end - start >= 8 and not covered and is_novel(text, start, end, novelty, least):
            found.append(("novel", start, end))
    return found


def all_spans(text: str, novelty: Novelty) -> list[Span]:
    """All spans by start, then kind in the order of KINDS."""
    folded = text.lower()
    if len(folded) != len(text):  # a letter grew: fall back to ASCII folding, which keeps places
        folded = "".join(c.lower() if c.isascii() else c for c in text)
    found = fixed_spans(text, folded) + novel_spans(text, folded, novelty)
    found += said_spans(text, folded, found, novelty)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def dictionary(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> tuple[str, ...]:
    """The words to prime with, those learnt from the corpus first."""
    return tuple(dict.fromkeys([*learnt_words(docs, text), *vocabulary_words(vocabulary)]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Per row: the key and ``spans``, an array of (kind, start, end). ``vocabulary``: a tokenizer's file."""
    known = dictionary(docs, text, vocabulary)

    def work(texts: list[str | None]) -> dict[str, list]:
        novelty = _primed(known)
        made = [all_spans(t or "", novelty) for t in texts]
        return {"spans": [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in made]}

    return map_text(pick(docs, key, text), work, T.StructType([T.StructField("spans", SPANS)]), text)


def redact(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with every stretch that spans cover replaced by the mask."""
    parts, done, covered = [], 0, -1
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > covered:
            parts += [text[done:start], mask]
        covered = max(covered, end)
        done = covered
    return "".join(parts) + text[done:]


def redact_secrets(
    docs: DataFrame, text: str = "text", length: str | None = "n_chars", vocabulary: str | None = None
) -> DataFrame:
    """The same rows and columns, secrets in the text masked and the length column kept true.

    A NULL text stays NULL; a row without secrets is unchanged.
    """
    small_batches(docs)
    place = docs.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None
    known = dictionary(docs, text, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = _primed(known)
        for batch in batches:
            for part in chunks(batch, batch.schema.names[place]):
                texts = part.column(place).to_pylist()
                spans = [all_spans(t, novelty) if t else [] for t in texts]
                if any(spans):
                    made = [redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                    columns = list(part.columns)
                    columns[place] = pa.array(made, columns[place].type)
                    if counted is not None:
                        old = columns[counted].to_pylist()
                        new = [len(t) if s else n for t, s, n in zip(made, spans, old, strict=True)]
                        columns[counted] = pa.array(new, columns[counted].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)


def secret_report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Counts and digests of the spans per document."""
    found = find_secrets(docs, vocabulary=vocabulary)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        count("novel").alias("n_novel"),
    )
