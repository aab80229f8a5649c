"""Secret scan (operator 3): patterns, and novelty by dictionary-primed zstandard.

The patterns find assignments to names like ``password``, access key ids and
long hexadecimal runs.  Besides, strings that stand shortly after a word of
``CONTEXT`` are candidates; where the word stands in the string itself, as in
``ACCESS_KEY=value``, the value is.  A candidate's novelty is what it adds to the
compressed size of the text around it, in bytes for each of its characters and
against random strings of its length and alphabet, where the compressor already
knows a dictionary of common identifiers.  Names, paths and words that occur
nearby add little; random strings can't be compressed and are reported as
``novel``.  A string is not made known by its own copies nearby.

Input cases: a null or empty text has no spans; spans count code points;
repeated rows give repeated results; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import random
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm.common import slices, table, with_python

KINDS = ("assign", "access", "hex", "novel")
# The patterns of the contract, over UTF-8 with A-Z lower-cased where letters count in either case.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
ASSIGN_LEN, ACCESS_LEN, HEX_LEN = 6, 20, 24

#: A candidate follows one of these words within REACH bytes; it is a run of CANDIDATE that ``looks_drawn``.
CONTEXT = re.compile(rb"passw|passphrase|secret|token|api.?key|access.?key|private.?key|credential|bearer|authorization|client.?id|signing")
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
INSIDE = re.compile(rb"[A-Za-z0-9+/_=-]")
DIGIT = re.compile(rb"[0-9]")
CASE_CHANGE, CONSONANTS = re.compile(rb"(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"), re.compile(rb"(?i:[bcdfghjklmnpqrstvwxz]{6})")
REACH, AROUND = 64, 256
#: Bytes added for each character, from which a candidate is incompressible.
NOVEL = 0.95
#: A candidate is so too from this share of what random strings of its length and alphabet add in its place, on
#: average: long ones come down to their alphabet's entropy (base64: 0.75 bytes a character).  Words joined to
#: names add 0.6 to 0.8 of it.
RANDOM_SHARE, RANDOM_STRINGS = 0.9, 4
LOWER, UPPER, DIGITS, HEXES = (frozenset(x) for x in (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"abcdefABCDEF"))
LETTERS = LOWER | UPPER
_HEX_MAP = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
#: Identifier dictionary: words that secrets' surroundings and harmless identifiers are made of.
IDENTIFIERS = (
    "string const static public private return import export default function class value number index length "
    "config settings options environment production development staging service account client server request "
    "response header content type application json username password secret token api key access private public "
    "credential bearer authorization signature certificate session cookie user admin root name email address "
    "https http www com org net localhost port host path file directory version release build example sample "
    "test placeholder changeme your_api_key_here 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "0000000000000000 1234567890 xxxxxxxxxxxxxxxx base64 sha256 md5 uuid hash digest commit branch master main "
    "2020-01-01 2021-01-01 2022-01-01 2023-01-01 2024-01-01 2025-01-01 00:00:00 true false null none undefined"
).encode()


@functools.cache
def compressor() -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)


def without(raw: bytes, start: int, end: int, cut: list[tuple[int, int]]) -> bytes:
    """raw[start:end] without the ranges ``cut``, which are in order."""
    out = []
    for s, e in cut:
        out.append(raw[start : max(start, min(s, end))])
        start = max(start, min(e, end))
    return b"".join([*out, raw[start:end]])


def alphabet(candidate: bytes) -> bytes:
    """The characters that a random string of the candidate's kind is drawn from."""
    body = set(candidate.rstrip(b"="))
    reach = HEXES if body & LETTERS <= HEXES else LETTERS
    return bytes(sorted((body - LETTERS - DIGITS) | set().union(*(kind & (reach | DIGITS) for kind in (LOWER, UPPER, DIGITS) if body & kind))))


def is_novel(raw: bytes, start: int, end: int, copies: list[tuple[int, int]]) -> bool:
    """Whether raw[start:end] adds to the compressed text around it, copies of
    itself left out, NOVEL bytes a character or nearly what random strings add."""
    before, after = without(raw, max(0, start - AROUND), start, copies), without(raw, end, end + AROUND, copies)
    size = compressor().compress
    known, n = len(size(before + after)), end - start
    added = len(size(before + raw[start:end] + after)) - known
    if added >= NOVEL * n:
        return True
    letters, draw = alphabet(raw[start:end]), random.Random(n)
    times = RANDOM_STRINGS if n < AROUND else 1  # long ones hardly differ
    return added * times >= RANDOM_SHARE * sum(len(size(before + bytes(draw.choices(letters, k=n)) + after)) - known for _ in range(times))


def value_start(raw: bytes, lower: bytes, start: int, end: int, named: bool) -> int | None:
    """Where the candidate in the run raw[start:end] begins: after the first '='
    behind the last context word that a value follows, else at the start.  ``named``:
    a context word ends at the start, so without a value there is none."""
    last = end
    while last > start and raw[last - 1] == 61:  # padding
        last -= 1
    if raw.find(b"=", start, last) >= 0:
        for word in reversed([start] * named + [w.end() for w in CONTEXT.finditer(lower, start, end)]):
            at = raw.find(b"=", word, last)
            while 0 <= at < last and raw[at] == 61:
                at += 1
            if 0 <= at and CANDIDATE.match(raw, at, end):
                return at
    return None if named else start


def copies_of(raw: bytes, start: int, end: int) -> list[tuple[int, int]]:
    """Other places near raw[start:end] of the same string."""
    word, n, out = raw[start:end], end - start, []
    last = end + AROUND + n
    at = raw.find(word, max(0, start - AROUND - n), last)
    while at >= 0:
        if at != start:
            out.append((at, at + n))
        at = raw.find(word, at + n, last)
    return out


class Taken:
    """Ranges in which no candidate may stand; asked in logarithmic time."""

    def __init__(self, ranges: list[tuple[int, int]]) -> None:
        self.starts = sorted(s for s, _ in ranges)
        ends = [e for _, e in sorted(ranges)]
        self.furthest = list(itertools.accumulate(ends, max))

    def overlaps(self, start: int, end: int) -> bool:
        before = bisect.bisect_left(self.starts, end)
        return before > 0 and self.furthest[before - 1] > start


def looks_drawn(raw: bytes, start: int, end: int) -> bool:
    """Whether a run can be a random string: it has a digit, or changes case as
    no name does, or has more consonants in a row than words have."""
    if DIGIT.search(raw, start, end):
        return True
    word = raw[start:end]
    return 4 * len(CASE_CHANGE.findall(word)) >= len(word) or CONSONANTS.search(word) is not None


def byte_spans(text: str | None) -> tuple[bytes, list[tuple[int, int, int]]]:
    """The text's UTF-8 and its spans (start, kind, end) in bytes, sorted."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found: list[tuple[int, int, int]] = []
    lower = raw.lower()
    if b"=" in raw or b":" in raw:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(lower) if len(m[2]) >= ASSIGN_LEN]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if len(m[0]) >= ACCESS_LEN]
    runs = raw.translate(_HEX_MAP)
    at = runs.find(b"x" * HEX_LEN)
    while at >= 0:  # a find from the end of a run meets the next run at its start
        end = HEX.match(raw, at).end()
        found.append((at, 2, end))
        at = runs.find(b"x" * HEX_LEN, end)
    taken = Taken([(s, e) for s, _, e in found])
    candidates: dict[int, int] = {}
    near = reach = behind = 0
    for m in CONTEXT.finditer(lower):
        near = max(reach, m.end())
        reach = m.end() + REACH
        # A run that starts before the reach is taken whole; so are further parts of a dotted token.
        for c in CANDIDATE.finditer(raw, near):
            s, e = c.span()
            if s >= reach and not (s == behind + 1 and raw[behind] == 46):
                break
            behind = e
            named = s > 0 and INSIDE.match(raw, s - 1) is not None
            if named and s != m.end():
                continue  # the rest of a run that was taken whole
            s = value_start(raw, lower, s, e, named)
            if s is None:
                continue
            if looks_drawn(raw, s, e) and not taken.overlaps(s, e):
                candidates[s] = e
    free = 0
    for s, e in candidates.items():
        if s >= free and is_novel(raw, s, e, copies_of(raw, s, e)):
            found.append((s, 3, e))
            free = e
    return raw, sorted(found)


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in the order of KINDS."""
    raw, found = byte_spans(text)
    if not found:
        return []
    place, at, count = {}, 0, 0
    for edge in sorted({x for s, _, e in found for x in (s, e)}):
        count += len(raw[at:edge].decode("utf-8", "surrogatepass"))
        at = edge
        place[edge] = count
    return [(KINDS[k], place[s], place[e]) for s, k, e in found]


def redacted(text: str, found: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every stretch that spans cover replaced by ``mark``; of an assignment, its name stays."""
    out, at = [], 0
    for kind, s, e in sorted(found, key=lambda x: x[1:]):
        if kind == "assign":
            s += re.match(r"(?s)(?:.*?[:=])\x20*[\"']?", text[s:e]).end()
        if e <= at:
            continue
        if s > at or not out or out[-1] != mark:
            out += [text[at : max(s, at)], mark]
        at = e
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end), of every row."""
    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return with_python(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets in column ``text`` replaced; a null stays null."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: None if t is None else redacted(t, spans(t)))

    return with_python(docs).withColumn(text, clean(F.col(text)))



def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def listed(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
