"""Secret scans by assignment-aware lexing.

Base spans come from three patterns. The method then reads source and configuration
syntax: a lexer splits a text into assignments (``name = value``, ``"name": value``,
``name => value``, ``name: type = value``, ``entry["name"] = value``), whose value is a
chain of literals (quoted, triple-quoted, prefixed), bare words and names joined by ``+``;
triple-quoted and prefixed literals are read for statements inside as well. Names assigned earlier in the text stand for their literals, so a
literal is found where it is written even if a sensitive name takes it through other
constants. A literal is reported when the score of the target name times the score of
the whole value reaches ``THRESHOLD``.

Each text is read whole in one task; nothing is shuffled, collected or broadcast.

Defined results: a null or empty text has no spans; positions are code points, end
exclusive; equal documents get equal spans; a constant assigned twice has the value it
had last at the point of use, whatever the number of literals it stands for; other columns
are not read. A constant is kept as its own literals and references to the constants it
joins, with counts of its value's characters; the references are followed once per text, from
the surest sensitive target down, so lexing stays linear in statements. Counts of values
beyond 2^256 characters (doubled constants) keep their upper 128 bits or more.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, table

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Hex digits to one mark, all else to another: a run of marks shows whether the pattern can match at all.
_HEX_MARKS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

_PREFIX = r"""(?:(?i:[rbuf]|rb|br|fr|rf|u8)|(?:[A-Za-z]{1,2}|[@$]{1,2})(?=["'][^"'\s]*["'])|b?r\#+)"""
#: A type between a name and its value: dotted names with arguments, optional marks and alternatives.
_TYPE = r"""[&*?]?(?:'[a-z]+[ \t]+)?(?:mut[ \t]+)?[A-Za-z_](?:[A-Za-z0-9_.\-]|::)*(?:\[(?:[^\[\]\n=]|\[[^\[\]\n=]*\])*\]|<(?:[^<>\n=]|<[^<>\n=]*>)*>)*[?!]?"""
_OPERATOR = rf"""[ \t]*
    (?::[ \t]*(?P<type>{_TYPE}(?:[ \t]*\|[ \t]*{_TYPE})*)[ \t]*=(?![=>])|:=|=>|(?P<colon>:)|=(?!=))
    (?(entry)(?(colon)(?=[ \t]*{_PREFIX}?["'])))[ \t]*"""
_QUOTED = r"""(?P<quote>["'])(?P<quoted>[A-Za-z_][A-Za-z0-9_.\-]*+)(?P=quote)(?P<entry>[ \t]*\])?"""
_PLAIN = r"(?P<plain>[A-Za-z_][A-Za-z0-9_.\-]*+)"
#: A statement at a given place.
_STATEMENT = re.compile(rf"(?:{_QUOTED}|{_PLAIN}){_OPERATOR}", re.ASCII | re.VERBOSE)
#: The next statement. A name is tried once per run of name characters, at its first letter, so a long run costs its length.
_NEXT = re.compile(rf"(?:{_QUOTED}|(?<![A-Za-z0-9_.\-])[0-9.\-]*+{_PLAIN}){_OPERATOR}", re.ASCII | re.VERBOSE)
_LITERAL = re.compile(rf"""
    (?P<prefix>{_PREFIX})?(?:
        "{{3}}(?P<triple>[^"\\]*(?:(?:\\.|"(?!""))[^"\\]*)*)"{{3}}|'{{3}}(?P<triple1>[^'\\]*(?:(?:\\.|'(?!''))[^'\\]*)*)'{{3}}|
        "(?P<double>(?:[^"\\\n]|\\[^\n])*)"|'(?P<single>(?:[^'\\\n]|\\[^\n])*)')""", re.DOTALL | re.VERBOSE)
_BARE = re.compile(r"""[^\s"',;(){}\[\]+]+""")
#: What a value in quotes that is an annotation is followed by.
_ANNOTATED = re.compile(r"[ \t]*=(?![=>])[ \t]*")
_JOIN = re.compile(r"[ \t]*\+[ \t]*(?:\n[ \t]*)?")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*", re.ASCII)
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.ASCII)

_STRONG = {"password", "passwd", "passphrase", "pwd", "secret", "token", "credential", "credentials", "apikey"}
_KEY_OWNERS = {"api", "access", "private", "secret", "encryption", "signing", "auth", "ssh", "master", "account", "storage"}
_WEAK = {"auth": 0.6, "bearer": 0.6, "pass": 0.6, "cred": 0.6, "key": 0.4, "signature": 0.4}
_ABOUT = {"hint", "count", "length", "size", "name", "type", "url", "uri", "path", "file", "field", "label", "expiry", "policy", "id", "limit"}
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*|\{\{.*|%.*%|change_?me|example|placeholder|redacted|none|null|true|false|undefined|your[_-].*)$")


def name_score(name: str) -> float:
    """0 to 1: how surely a target of this name holds a secret."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    if not parts:
        return 0.0
    score = max((1.0 if p in _STRONG else _WEAK.get(p, 0.0) for p in parts), default=0.0)
    if any(a in _KEY_OWNERS and b in ("key", "keys") for a, b in zip(parts, parts[1:])):
        score = 1.0
    return score * (0.2 if parts[-1] in _ABOUT else 1.0)


@dataclass(slots=True)
class Value:
    """What the score of a joined value needs: its characters counted (times 2 ** ``shift``), its first ones and its last."""
    counts: dict[str, int]
    shift: int
    head: str
    last: str
    spaced: bool
    mixed: tuple[bool, bool]
    quoted: bool


#: First characters of a value that tell a placeholder: more than its longest word has.
_HEAD = 12


def value_of(text: str, quoted: bool) -> Value:
    spaced = any(c.isspace() for c in text)
    return Value({} if spaced else Counter(text), 0, text[:_HEAD], text[-1:], spaced, (any(c.isdigit() for c in text), any(c.isalpha() for c in text)), quoted)


def joined(values: list[Value]) -> Value:
    if len(values) == 1:
        return values[0]
    spaced, counts, shift, head = any(v.spaced for v in values), {}, max(v.shift for v in values), ""
    for v in values:
        head = (head + v.head)[:_HEAD] if len(head) < _HEAD else head
        if not spaced:  # a spaced value and all that join it score 0
            for c, n in v.counts.items():
                counts[c] = counts.get(c, 0) + (n >> shift - v.shift)
    if (over := sum(counts.values()).bit_length() - 128) > 128:
        counts, shift = {c: n >> over for c, n in counts.items()}, shift + over
    return Value(counts, shift, head, next((v.last for v in reversed(values) if v.last), ""), spaced,
                 (any(v.mixed[0] for v in values), any(v.mixed[1] for v in values)), any(v.quoted for v in values))


def value_score(value: Value) -> float:
    """0 to 1: how much a value looks like a secret rather than a word or a placeholder."""
    size = sum(value.counts.values())
    if size < 6 or value.spaced:
        return 0.0
    # a placeholder is short, one letter repeated, or shows at its ends
    same = len({c.lower() for c in value.counts}) == 1
    short = value.head if size <= _HEAD or same else f"{value.head}\0{value.last}"
    if _PLACEHOLDER.match(short):
        return 0.0
    entropy = -sum(n / size * math.log2(n / size) for n in value.counts.values() if n)
    return (0.5 if value.quoted else 0.1) + 0.25 * all(value.mixed) + 0.25 * (entropy >= 3.0)


def literal_score(value: str, quoted: bool) -> float:
    return value_score(value_of(value, quoted))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low = text.lower() if "=" in text or ":" in text else ""
    out = []
    if any(k in low for k in _KEYWORDS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    if b"x" * 24 in text.encode("utf-8", "replace").translate(_HEX_MARKS):
        out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


@dataclass(slots=True)
class Constant:
    """A name's value as one statement gave it: (start, end, text, quoted) literals and the constants it joins, in order."""
    parts: list[tuple[int, int, str, bool] | Constant]
    value: Value | None = None
    names: int = 0

    def known_value(self) -> Value:
        """Constants that join others get theirs at their statement, so this never descends further than one."""
        if self.value is None:
            self.value = joined([p.known_value() if isinstance(p, Constant) else value_of(p[2], p[3]) for p in self.parts])
        return self.value


def _value(text: str, at: int, stop: int, known: dict[str, Constant]) -> tuple[Constant, list[tuple[int, int]], int]:
    """The value written at ``at``; the insides of its triple-quoted and prefixed literals, which may hold statements; its end."""
    constant, inside = Constant([]), []
    while True:
        if piece := _LITERAL.match(text, at, stop):
            k = piece.lastgroup
            constant.parts.append((*piece.span(k), piece[k], True))
            if piece["prefix"] or k in ("triple", "triple1"):
                inside.append(piece.span(k))
        elif not constant.parts and _STATEMENT.match(text, at, stop):
            break  # the value is itself a statement, as in a nested mapping; asked before the bare word is read, which may be long
        elif piece := _BARE.match(text, at, stop):
            name = piece[0].rstrip(".")
            constant.parts.append(known[name] if name in known and _NAME.fullmatch(name) else (*piece.span(), piece[0], False))
        else:
            break
        at = piece.end()
        if not (join := _JOIN.match(text, at, stop)):
            break
        at = join.end()
    return constant, inside, at


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of literals that reach a sensitive name, directly or through constants."""
    if "=" not in text and ":" not in text:
        return []
    known: dict[str, Constant] = {}
    targets: list[tuple[float, str, Constant]] = []
    ranges = [(0, len(text))]
    while ranges:
        at, stop = ranges.pop()
        if not (statement := _NEXT.search(text, at, stop)):
            continue
        names = [statement["quoted"] or statement["plain"]]
        if statement["type"] and _NAME.fullmatch(statement["type"]):
            names.append(statement["type"])  # a mapping to a statement is written the same way
        constant, inside, at = _value(text, statement.end(), stop, known)
        values = [constant]
        if statement["colon"] and text[at - 1] in "\"'" and len(constant.parts) == 1 and (sign := _ANNOTATED.match(text, at, stop)):
            constant, more, at = _value(text, sign.end(), stop, known)
            values, inside = [*values, constant], inside + more
        ranges.append((at, stop))
        ranges += reversed(inside)
        for constant in values:
            if not constant.parts:
                continue
            if any(isinstance(p, Constant) for p in constant.parts):
                constant.known_value()
            if not statement["entry"]:  # an entry is no constant of that name
                for name in names:
                    if before := known.get(name):
                        before.names -= 1
                        if not before.names:
                            before.value = None  # no later statement can join it
                    known[name] = constant
                    constant.names += 1
            name = max(names, key=name_score)
            if weight := name_score(name):
                score = weight * value_score(constant.known_value())
                if score >= threshold:
                    targets.append((score, name, constant))
    found: dict[tuple[int, int], tuple[str, float]] = {}
    seen: set[int] = set()
    for score, name, constant in sorted(targets, key=lambda t: -t[0]):
        below = [constant]
        while below:
            constant = below.pop()
            if id(constant) not in seen:
                seen.add(id(constant))
                for p in constant.parts:
                    if isinstance(p, Constant):
                        below.append(p)
                    elif p[1] > p[0]:
                        found.setdefault(p[:2], (name, score))
    return [(*span, *why) for span, why in sorted(found.items())]


def secrets_of(text: str | None) -> list[dict]:
    """All spans by start, then kind as listed; a literal inside a base span isn't given again."""
    if not text:
        return []
    base = base_spans(text)
    out = [{"kind": kind, "start": a, "end": b, "name": None, "score": None} for a, b, kind in base]
    starts = sorted(base)
    reach = list(accumulate((e for _, e, _ in starts), max))
    starts = [s for s, _, _ in starts]
    for a, b, name, score in literal_spans(text):
        before = bisect_right(starts, a)
        if not before or reach[before - 1] < b:
            out.append({"kind": "literal", "start": a, "end": b, "name": name, "score": score})
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def _joined(spans: list[dict]) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [secrets_of(t) for t in batch.column(1).to_pylist()]
        base = [hashlib.sha256(_joined([s for s in x if s["kind"] != "literal"]).encode()).hexdigest() for x in spans]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN)), pa.array(base, pa.string())],
                                         names=["_row", "_spans", "_base_sha256"])


def find_secrets(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_spans`` (kind, start, end, name, score) and the
    digest of the base spans."""
    python_tasks(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    row = docs.select(*columns).schema.simpleString()[len("struct<"):-1]
    return docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text")).mapInArrow(
        _scan, f"_row struct<{row}>, _spans array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>, "
               "_base_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.col("_base_sha256").alias("base_sha256"),
        F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))
