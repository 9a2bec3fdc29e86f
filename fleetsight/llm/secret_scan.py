"""Find secrets: fixed patterns, and strings that no dictionary helps to compress.

The patterns give the base spans. Beyond them, every run of LEAST or more characters without space
and quotes near a sensitive word is a candidate, less the name before its '=' or ':' and punctuation
at its ends; if it compresses as a whole, its parts between delimiters are. Its novelty is what zstandard needs for it on top of its surroundings: the compressed
size of surroundings plus candidate less that of the surroundings alone, both primed with a
dictionary of code and identifiers, and with the candidate's own neighbourhood in the text as the
prefix. Words, identifiers and paths compress away; keys don't. A string that only its own copies
help to compress is a secret that stands repeatedly: it is measured once more with the copies left
out, and it and all its copies in the text are spans of the kind ``novel_repeated``.

A shorter string, of SHORTEST characters or more, is measured where it is the value of a sensitive
name ('pwd: ...', 'DB_PWD=...', 'Bearer ...'), without its copies and against a higher bar: the fewer
bytes, the less a match says. Left out are short values in other places, values of fewer than SHORTEST
characters, those with other than printable ASCII, and those whose letters and digits are all plain
words ('changeme', 'Token2', 'os.getenv') or numbers. Copies of a short secret are ``novel_repeated``.

Defined cases: null text counts as empty and has no spans; null ids and repeated rows are kept;
an empty table gives no rows; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import PART_BYTES, slices

# The base patterns, and the least length of a match.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this equals [0-9a-f]+ with short runs dropped
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
KINDS = ("assign", "access", "hex", "novel", "novel_repeated")

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Sensitive context for candidates: one of these within REACH characters before the string, in the
# name joined to it, or in the string itself. 'auth' counts as a word or with what names join to it, so authors and
# authorities are none; nor are secretaries and tokenizers.
_CONTEXT = re.compile(
    r"passw|passphrase|pwd|secret(?!ar[iy])|token(?!i[sz])|api.?key|private.?key|credential|bearer|authori[sz]ation|authenticat"
    r"|(?<![a-z])(?:o|basic|http|proxy|user|x)?auth(?:key|code|header|data|info|user|pass)?(?![a-z])",
    re.IGNORECASE | re.ASCII,
)
LEAST = 16
# Any unbroken run without quotes; scripts that put no space between words end it.
_CANDIDATE = re.compile(r"[^\s\"'`\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ud7ff\uf900-\uffef\U00020000-\U0003ffff]{16,}")
_OPENING, _CLOSING = "([{<=:,;", ".,;:)]}>"  # taken off a run's ends: punctuation of the text around it
# A run is cut where a name stands before '=' or ':' and a value behind: at its start, or after a delimiter inside.
# Names are made of words or hold a sensitive one; other '=' belong to the value, as its padding does.
_JOINED = re.compile(r"(^|[&;,?|({\[])([\w.+/-]+)(?:=+|:)(?!=|$)")
_NAME = re.compile(r"(?=.*[A-Za-z]{3})[._/+-]*(?:(?:[A-Z]+|[A-Z]?[a-z]+)[0-9]{0,2}(?:[._/-]+|$))+")
_PIECE = re.compile(r"[^:,;&?|/()\[\]{}<>@]{16,}")
# A short value: what follows a sensitive name and '=' or ':' at once, or the scheme of a header.
_NAMED = re.compile(
    rf"(?:(?:{_CONTEXT.pattern})[\w.-]{{0,24}}[\"'`]?[^\S\n]*(?:=>|:=|[:=])(?:\x20*(?:bearer|basic|token)(?=\x20))?|bearer(?=\x20))[^\S\n]*[\"'`]?([^\s\"'`]+)",
    re.IGNORECASE | re.ASCII,
)
_PLAIN = re.compile(r"(?:[A-Z]+|[A-Z]?[a-z]+)[0-9]{0,2}|[0-9]+")  # a word of one case or capitalised, or a number
_RUN = re.compile(r"[^\s\"'`]+")
SHORTEST = 8
SHORT_NOVELTY = 0.85
REACH = 48
AROUND = 512
MIN_NOVELTY = 0.62  # marginal compressed bytes for each character

# The identifier dictionary: what code around secrets is made of.
IDENTIFIERS = """
import from package module class function public private protected static const final return
string integer boolean float double char byte array list dict map set null None true false
username password passwd secret token apikey api_key access_key secret_key client_id client_secret
private_key public_key certificate credential credentials authorization Authorization Bearer Basic
bearer_token refresh_token access_token session_token auth_token id_token csrf_token signature
AWS_ACCESS_KEY_ID AWS_SECRET_ACCESS_KEY DATABASE_URL database_password connection_string
http:// https:// localhost 127.0.0.1 example.com www. .com .org .net /usr/local/bin /home/user /etc
config configuration settings environment variable development production staging testing default
request response headers content-type application/json charset=utf-8 text/html user-agent
hostname port timeout retries version checksum sha256 sha512 md5 hash digest uuid identifier
00000000-0000-0000-0000-000000000000 0123456789 abcdefghijklmnopqrstuvwxyz
ABCDEFGHIJKLMNOPQRSTUVWXYZ 2020-01-01T00:00:00Z lorem ipsum dolor sit amet example placeholder
your_password_here your_api_key_here changeme change_me replace_me xxxxxxxxxxxxxxxx ****************
""".strip()

# The word dictionary: what long words, paths, addresses and times of the languages at hand are made of.
WORDS = """
inter national alization ization isation ational ability ibility ibilities responsib representat character
istics characteristic communicat administrat organis organiz transform construct constitution environment
government development understand acknowledg straight forward comprehens experiment extraordinar
psycholog physiolog technolog encephalo electro graph micro macro hyper multi under counter trans super
circum establish ment arian ism dis anti pre dominant approximate simultaneous unfortunate ously fulness
lessness ically ality iveness ations institution recommend authentic authorization certificat configur
implement initializ synchron serializ identif classif specif notif verif qualif modif ication
documentation infrastructure distribut process ing performance management application information
well- known self- based long- term state-of-the-art day- to- and/or high- level third- party user- defined
verantwort lichkeit lichkeiten geschwindigkeit begrenzung schaft schaften gesellschaft wirtschaft
wissenschaft entwicklung verwaltung versicherung verordnung regierung beziehung unternehm arbeit geber
bundes landes staats haupt grund ungs keits heits ischen lichen barkeit gericht besonder verschieden
constitutionnellement administration gouvernement développement responsabilité responsabilidad particulièrement
immédiat exceptionnel internacional administración constitucional desarrollo especialmente aproximadamente
ellement issement amiento aciones idades mente ción sión ität ieren ierung
/usr/share/ /usr/lib/ /var/log/ /opt/ /home/ python3 dist-packages/ site-packages/ node_modules/ numpy/core src/main/java/
org.apache. com.google. java.util. javax. spark.sql. shuffle.partitions hadoop. SparkSession Manager Builder Factory
Provider Service Controller Repository Exception Handler Context getUser Authentication() .html .json .yaml .py .java
https://www.example.com/docs/ reference/ index.html https://github.com/ blob/main/ .org/wiki/ api/v1/ ?id= &page=
@company-mail. @gmail.com user.name first.last mailto: 2024- 2025- 2026- -01 -12 T00:00: T12:30: .000Z +00:00
"""
DICTIONARY = WORDS + WORDS.upper() + IDENTIFIERS.upper() + "\n" + IDENTIFIERS


def _bare(string: str, begin: int) -> tuple[int, int]:
    """Where a run that begins at ``begin`` lies without the punctuation at its ends."""
    closed = string.rstrip(_CLOSING)
    opened = closed.lstrip(_OPENING)
    begin += len(closed) - len(opened)
    return begin, begin + len(opened)


def _is_plain(value: str) -> bool:
    return all(_PLAIN.fullmatch(x) for x in re.findall(r"[A-Za-z0-9]+", value))


def _values(run: re.Match) -> list[tuple[int, int]]:
    """The parts of a run behind its names that are long enough; a run that has none is one part, less the name before it."""
    begin, end = _bare(run[0], run.start())
    string = run[0][begin - run.start() : end - run.start()]
    cuts = [(m.start(), m.end()) for m in _JOINED.finditer(string) if _NAME.fullmatch(m[2]) or _CONTEXT.search(m[2])]
    lead = cuts[0][1] if cuts and cuts[0][0] == 0 else 0
    ends = [*(a for a, _ in cuts if a), len(string)]
    parts = list(zip([lead, *(b for a, b in cuts if a)], ends, strict=True))
    if any(b - a >= LEAST for a, b in parts):
        return [(begin + a, begin + b) for a, b in parts if b - a >= LEAST]
    return [(begin + lead, begin + len(string))] if len(string) - lead >= LEAST else []


class Scanner:
    """The scan of one text; one for each task."""

    def __init__(self, identifiers: str = DICTIONARY, min_novelty: float = MIN_NOVELTY):
        self.identifiers = identifiers.encode()
        self.min_novelty = min_novelty

    def novelty(self, text: str, start: int, end: int, copies: bool = True) -> float:
        """Marginal compressed bytes of text[start:end] for each of its bytes; ``copies``: its copies count as surroundings."""
        if not copies:  # blanked in a window that holds those at the edges whole
            string, reach = text[start:end], AROUND + end - start
            before, after = (x.replace(string, " " * len(string)) for x in (text[max(0, start - reach) : start], text[end : end + reach]))
            text, start, end = before + string + after, len(before), len(before) + len(string)
        around = (text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]).encode()
        primed = zstandard.ZstdCompressionDict(self.identifiers + b"\n" + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
        lead = text[max(0, start - REACH) : start].encode()
        candidate = text[start:end].encode()
        alone = len(press.compress(lead + b"\n"))
        return (len(press.compress(lead + candidate + b"\n")) - alone) / max(1, len(candidate))

    def short_spans(self, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of short values of sensitive names and of their copies, but for those inside a span found before."""
        held = sorted((s, e) for s, _, e in found)
        covers = list(itertools.accumulate((e for _, e in held), max))

        def covered(s: int, e: int) -> bool:
            at = bisect.bisect_right(held, (s, len(text)))
            return bool(at) and covers[at - 1] >= e

        named = {}
        for m in _NAMED.finditer(text):
            s, e = _bare(m[1], m.start(1))
            value = text[s:e]
            if not SHORTEST <= e - s < LEAST or covered(s, e) or not (value.isascii() and value.isprintable()) or _is_plain(value):
                continue
            if self.novelty(text, s, e, copies=False) >= max(SHORT_NOVELTY, self.min_novelty):
                named[s, e] = value
        secrets = set(named.values())
        copies = set()
        for run in _RUN.finditer(text) if secrets else ():
            s, e = _bare(run[0], run.start())
            if text[s:e] in secrets and (s, e) not in named and not covered(s, e):
                copies.add((s, e))
        return [(s, 3, e) for s, e in named] + [(s, 4, e) for s, e in copies]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind's place in KINDS, end) in order; positions are code points, the end exclusive."""
        found = []
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        held = sorted((s, e) for s, _, e in found)
        covers = list(itertools.accumulate((e for _, e in held), max))
        contexts = [m.end() for m in _CONTEXT.finditer(text)]
        secrets, others = set(), []
        for run in _CANDIDATE.finditer(text) if contexts else ():
            for start, end in _values(run):
                parts = [(start, end)]
                for s, e in parts:
                    at = bisect.bisect_right(held, (s, len(text)))
                    if at and covers[at - 1] >= e:
                        continue  # a base span covers it
                    before = bisect.bisect_right(contexts, e)
                    if not before or contexts[before - 1] < min(run.start(), s - REACH):
                        others.append((s, e))
                    elif self.novelty(text, s, e) >= self.min_novelty:
                        found.append((s, 3, e))
                        secrets.add(text[s:e])
                        continue
                    else:
                        others.append((s, e))
                        if text[s:e] in secrets:
                            continue
                        if self._repeats(text, s, e):
                            secrets.add(text[s:e])
                            continue
                    if len(parts) == 1:  # what compresses as a whole can hold a part that doesn't
                        parts += [x for m in _PIECE.finditer(text, s, e) if (x := m.span()) != (s, e)]
        found += [(s, 4, e) for s, e in others if text[s:e] in secrets]
        if contexts:
            found += self.short_spans(text, found)
        return sorted(found)

    def _repeats(self, text: str, start: int, end: int) -> bool:
        """Only its copies make this string compress."""
        reach = AROUND + end - start
        if text.count(text[start:end], max(0, start - reach), end + reach) < 2:
            return False
        return self.novelty(text, start, end, copies=False) >= self.min_novelty


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_spans string, spans string"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """For each document the counts by kind and the spans, as kind:start:end joined by commas; n_novel has both novel kinds.

    A row is worked on by itself in the task that read it; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(min_novelty=min_novelty)
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                found = [scanner.spans(t or "") for t in part.column("text").to_pylist()]
                counts = [pa.array([sum(min(k, 3) == kind for _, k, _ in spans) for spans in found], pa.int64()) for kind in range(4)]
                base = pa.array([_listed([x for x in spans if x[1] < 3]) for spans in found], pa.string())
                every = pa.array([_listed(spans) for spans in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, base, every], [c.split()[0] for c in _SCHEMA.split(", ")]
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, _SCHEMA)


def base_digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()


def redacted(text: str, spans: list[tuple[int, int, int]], mask: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping spans become one mask. A key's name stays."""
    out, at = [], 0
    for start, kind, end in spans:
        if kind == 0:
            start = ASSIGN.match(text, start).start(2)
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with their secrets masked, all columns kept; ``chars_col`` follows the new text."""
    schema = docs.schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        text_at = names.index(text_col)
        chars_at = names.index(chars_col) if chars_col in names else None
        for batch in batches:
            for part in slices(batch, text_col, PART_BYTES):
                columns = list(part.columns)
                texts = columns[text_at].to_pylist()
                clean = [t if t is None else redacted(t, spans) if (spans := scanner.spans(t)) else t for t in texts]
                columns[text_at] = pa.array(clean, columns[text_at].type)
                if chars_at is not None:
                    old = columns[chars_at].to_pylist()
                    new = [o if a == b else len(b) for o, a, b in zip(old, texts, clean, strict=True)]
                    columns[chars_at] = pa.array(new, columns[chars_at].type)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, schema)
