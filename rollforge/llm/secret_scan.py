"""Secret scans: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax into (name, value) pairs. Targets are names, bare, dotted, quoted, annotated (`name: type =`) or subscripts
(`env["name"] =`), before `=`, `:`, `:=` or `=>`, and the elements and key/value attributes of XML. Values are read by a scanner: string literals in
single, double, triple or back quotes with prefixes and escapes, block scalars (`name: |`), bare words, references (`other`, `$other`, `${other}`) and calls,
joined by +, by standing next to each other or over lines inside brackets. What stands in comments or inside strings is read like the rest.
Constants are propagated: a literal also carries each name that it reaches through references, to a fixed point, and a part of a
concatenation the score of the whole. It is scored by the most sensitive of its names, how much it looks like
a placeholder, and its entropy; literals of MIN_SCORE or more become spans of kind `literal`.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from ..shipping import ship
from .common import slices

#: The base patterns, with the length that keeps a match. Kinds are listed in this order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
_ORDER = {k: i for i, k in enumerate(KINDS)}
_ASSIGN_HINT = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How sensitive a target name is, by the words it is made of.
SENSITIVE = (
    ("password", 1.0), ("passwd", 1.0), ("passphrase", 1.0), ("pwd", 0.9), ("secret", 1.0), ("token", 0.9), ("apikey", 1.0), ("api_key", 1.0),
    ("credential", 0.9), ("private_key", 1.0), ("privatekey", 1.0), ("access_key", 1.0), ("accesskey", 1.0), ("auth_key", 0.9), ("signing_key", 0.9), ("encryption_key", 0.9), ("bearer", 0.8),
)
#: Words that show that a name holds something about a secret, not the secret.
HARMLESS = frozenset("count length len size max min limit type name path file url uri regex pattern policy hint label field id expiry expires ttl".split())
PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|none|null|true|false|test|example|changeme|change_me|your.*|placeholder|todo|dummy|<.*>|redacted)\Z")
MIN_SCORE, MIN_CHARS, SHORT = 0.55, 6, 4096
#: A scheme before a credential, and a value made of references only.
_SCHEME = re.compile(r"(?i)\A(?:bearer|basic|digest|token)[ \t]+")
_REFERENCE = r"(?>\$\{[^}]*\}|\$\([^)]*\)|\$(?:[A-Z_][A-Z0-9_]*|[A-Za-z_.]+)(?![A-Za-z0-9])|\{\{[^{}]*\}\}|\{[A-Za-z_][\w.]*\}|<[^>]*>|%\(\w+\)s|%[sd](?!\w)|%[^%\s]*%)"
_REFERENCES = re.compile(rf"\A{_REFERENCE}(?:[\s:/@._-]*+{_REFERENCE})*+\Z")
_HEAD = re.compile(
    r"""(?<![A-Za-z0-9_.\-])[.\-$]*+(?P<q>["'`]?)(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)(?P=q)(?P<sub>(?:\[[ \t]*+(?:"[^"\n]*+"|'[^'\n]*+'|[A-Za-z0-9_]++)[ \t]*+\])*+)[ \t]*+
    (?P<op>:=|=>|=(?!=)|:[ \t]*+(?P<type>[A-Za-z_][A-Za-z0-9_.\[\]|,\-]*+)[ \t]*+=(?!=)|:(?!//|:))""",
    re.X,
)
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.:\-]*+)(?:\s[^<>]*+)?>(?P<value>[^<]++)</(?P=name)\s*+>")
_ATTRIBUTES = re.compile(r"""\b(?:key|name)\s*+=\s*+(["'])(?P<name>[A-Za-z_][A-Za-z0-9_.:\-]*+)\1\s++value\s*+=\s*+(?:"(?P<d>[^"<]*+)"|'(?P<s>[^'<]*+)')""")
_SUBSCRIPT = re.compile(r"""["']([^"'\]]*)["'][ \t]*\]\Z""")
_SPACE, _LINES = re.compile(r"(?:[ \t]|\\\r?\n)*+"), re.compile(r"\s*+")
_STRING = re.compile(
    r'[rRbBuUfF]{0,2}(?:"""(?P<td>(?:[^"\\]|\\.|"(?!""))*+)"""|'
    r"'''(?P<ts>(?:[^'\\]|\\.|'(?!''))*+)'''|"
    r'"(?P<d>(?:[^"\\\n]|\\.)*+)"|'
    r"'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>[^`]*+)`)",
    re.S,
)
_BEARER = re.compile(r"(?i:bearer)[ \t]+[A-Za-z0-9+/_.=~:-]{6,}")
_BRACED = re.compile(r"\$\{([A-Za-z_]\w*)\}")
_WORD = re.compile(r"""[^\s"'`,;#+(){}\[\]]+""")
_SCALAR = re.compile(r"[|>][+\-0-9]*[ \t]*\r?\n")
_NAME = re.compile(r"\A\$?([A-Za-z_][A-Za-z0-9_.]*)\Z")


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns."""
    out = []
    if any(h in low for h in _ASSIGN_HINT):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


_GATE = tuple(sorted({s.replace("_", "") for s, _ in SENSITIVE}))


def may_name(low: str) -> bool:
    """Whether a lower-case text can hold a name with a score: name_score's words, without the signs that it sets between them."""
    bare = low.replace("_", "").replace("-", "").replace(".", "")
    return any(s in bare for s in _GATE)


def name_score(name: str) -> float:
    low = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")
    best = max((w for s, w in SENSITIVE if s in low), default=0.0)
    return best * 0.4 if best and low.rsplit("_", 1)[-1] in HARMLESS else best


def _spread(n: int, counts: Counter) -> float:
    """Between 0.5 and 1 by the entropy of n characters."""
    return 0.5 + 0.5 * min(1.0, -sum(c / n * math.log2(c / n) for c in counts.values()) / 3.5)


def literal_score(value: str) -> float:
    """0 for a placeholder, references or a short literal, else between 0.5 and 1 by its entropy; a scheme such as Bearer isn't counted."""
    value = _SCHEME.sub("", value.strip())
    if len(value) < MIN_CHARS or PLACEHOLDER.match(value) or value[0] in "$<{%" and _REFERENCES.match(value):
        return 0.0
    return _spread(len(value), Counter(value))


def _block_scalar(text: str, head: int, at: int) -> tuple[int, int]:
    """From the first to the last character of the lines from `at` that are indented further than the line of `head`; blank lines inside count."""
    line = text.rfind("\n", 0, head) + 1
    indent = len(text[line:head]) - len(text[line:head].lstrip(" \t-"))
    start = end = None
    while at < len(text):
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        own = text[at:stop]
        if own.strip():
            if len(own) - len(own.lstrip(" \t")) <= indent:
                break
            start = at + len(own) - len(own.lstrip()) if start is None else start
            end = at + len(own.rstrip())
        at = stop + 1
    return (start, end) if start is not None else (at, at)


def read_value(text: str, head: int, at: int) -> list[tuple[str, str, int, int]]:
    """Parts (kind, value, start, end) of the value that begins at `at`, of an assignment that begins at head.

    kind: `is` a literal, `of` a name that is referred to, `word` a bare word that may be either."""
    at = _SPACE.match(text, at).end()
    if m := _SCALAR.match(text, at):
        start, end = _block_scalar(text, head, m.end())
        return [("is", text[start:end], start, end)] if end > start else []
    out, depth, string = [], 0, False
    while True:
        while text.startswith("(", at):
            depth += 1
            at = _LINES.match(text, at + 1).end()
        if m := _STRING.match(text, at):
            kind = m.lastgroup
            out.append(("is", m[kind], m.start(kind), m.end(kind)))
            string = True
        elif m := _BEARER.match(text, at):
            out.append(("is", m[0], m.start(), m.end()))
            string = False
        elif m := _BRACED.match(text, at):
            out.append(("of", m[1], m.start(), m.end()))
            string = False
        elif m := _WORD.match(text, at):
            if not text.startswith("(", m.end()):  # a call's name is no value
                out.append(("word", m[0], m.start(), m.end()))
            string = False
        else:
            return out
        at = m.end()
        space = _LINES if depth else _SPACE
        behind = space.match(text, at).end()
        while depth and text.startswith(")", behind):
            depth -= 1
            behind = (_LINES if depth else _SPACE).match(text, behind + 1).end()
        if text.startswith("+", behind) and not text.startswith("+=", behind):
            at = _LINES.match(text, behind + 1).end()
        elif string and _STRING.match(text, behind):
            at = behind
        else:
            return out


def _targets(text: str) -> list[tuple[int, str, list]]:
    """(start, name, parts of the value) for each assignment."""
    found, at = [], 0
    while m := _HEAD.search(text, at):
        at = m.end()
        sub = _SUBSCRIPT.search(m["sub"])
        value = read_value(text, m.start("name"), m.end())
        found.append((m.start("name"), sub[1] if sub else m["name"], value))
        if m["type"]:  # or a label before an assignment to what looks like a type
            found.append((m.start("type"), m["type"], value))
        for kind, word, _, end in value:  # a bare word is read as a whole; strings may hold assignments of their own
            if kind == "word" and ("=" in word or ":" in word):
                at = max(at, end)
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            value = m["value"].strip()
            start = m.start("value") + len(m["value"]) - len(m["value"].lstrip())
            found.append((m.start(), m["name"], [("is", value, start, start + len(value))] if value else []))
    if "value" in text:
        for m in _ATTRIBUTES.finditer(text):
            found.append((m.start(), m["name"], [("is", m[m.lastgroup], m.start(m.lastgroup), m.end(m.lastgroup))]))
    return sorted(found, key=lambda x: x[0])


def lex(text: str) -> list[tuple[str, list[tuple[str, int, int]], list[str], list[tuple[str, str]]]]:
    """(name, literals as (value, start, end), names that it refers to, parts) for each assignment, in the order of the text.

    parts: (kind, value) of the value's parts in their order; kind is `is` for a literal, `of` for a name."""
    found = []
    for _, name, value in _targets(text):
        literals, refers, parts = [], [], []
        for kind, word, start, end in value:
            if kind == "is":
                literals.append((word, start, end))
                parts.append(("is", word))
                continue
            n = _NAME.match(word)
            if n:
                refers.append(n[1])
                parts.append(("of", n[1]))
            if kind == "word" and not (n and word.startswith("$")):
                literals.append((word, start, end))
        found.append((name, literals, refers, parts))
    return found


def folded_scores(pairs) -> list[float]:
    """For each assignment the highest score of a concatenation that its value is part of, itself or through references; 0 where nothing is joined.

    A name stands for its last assignment before, else its first one after; names in a circle and names that aren't assigned stand for nothing."""
    if all(len(parts) < 2 for *_, parts in pairs):
        return [0.0] * len(pairs)
    places: dict[str, list[int]] = {}
    for i, (name, *_) in enumerate(pairs):
        places.setdefault(name, []).append(i)

    def source(name: str, i: int) -> int | None:
        held = places.get(name, ())
        j = bisect_left(held, i) if held else 0
        return held[j - 1] if j else next((k for k in held if k > i), None)

    uses = [[source(v, i) if kind == "of" else None for kind, v in parts] for i, (_, _, _, parts) in enumerate(pairs)]
    waits = [len({j for j in u if j is not None}) for u in uses]
    users: dict[int, set[int]] = {}
    for i, u in enumerate(uses):
        for j in u:
            if j is not None:
                users.setdefault(j, set()).add(i)
    order = [i for i, n in enumerate(waits) if not n]
    # A folded value is its text, or beyond SHORT characters, where it is no placeholder, its length and counts of characters: chains of doublings grow no text.
    folded: list = [("", 0, Counter())] * len(pairs)
    for i in order:  # grows as sources are known
        held = [folded[j] if j is not None else (v, len(v), Counter(v)) for (kind, v), j in zip(pairs[i][3], uses[i], strict=True) if j is not None or kind == "is"]
        n, counts = sum(h[1] for h in held), Counter()
        for h in held:
            counts.update(h[2])
        folded[i] = ("".join(h[0] for h in held) if n <= SHORT else None, n, counts)
        for k in users.get(i, ()):
            waits[k] -= 1
            if not waits[k]:
                order.append(k)
    scores = [0.0] * len(pairs)
    for i in reversed(order):
        if len(pairs[i][3]) > 1:
            value, n, counts = folded[i]
            scores[i] = max(scores[i], name_score(pairs[i][0]) * (literal_score(value) if value is not None else _spread(n, counts)))
        for j in uses[i]:
            if j is not None:
                scores[j] = max(scores[j], scores[i])
    return scores


def lexed_spans(text: str) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of literals that reach a sensitive name."""
    pairs = lex(text)
    if not pairs:
        return []
    # reach[name]: the highest score of a name that this one's value flows into; walked back from sinks to sources.
    reach: dict[str, float] = {}
    sources: dict[str, set[str]] = {}
    for name, _, refers, _ in pairs:
        reach[name] = max(reach.get(name, 0.0), name_score(name))
        sources.setdefault(name, set()).update(refers)
    todo = [n for n, s in reach.items() if s > 0]
    while todo:
        name = todo.pop()
        for source in sources.get(name, ()):
            if source in reach and reach[source] < reach[name]:
                reach[source] = reach[name]
                todo.append(source)
    out = {}
    for (name, literals, _, parts), joined in zip(pairs, folded_scores(pairs), strict=True):
        for value, start, end in literals:
            if value in reach and value in sources:  # a reference to a constant, not a literal
                continue
            score = max(reach[name] * literal_score(value), joined if ("is", value) in parts else 0.0)
            if score >= MIN_SCORE and end > start:
                out[start, 3, end] = max(score, out.get((start, 3, end), 0.0))
    return sorted((*k, v) for k, v in out.items())


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """Base spans and the lexer's, of a whole text; null counts as empty."""
    text = text or ""
    low = text.lower()
    lexed = lexed_spans(text) if ("=" in text or ":" in text or "</" in text) and may_name(low) else []
    return base_spans(text, low), lexed


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_literal bigint, score double"


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text), with the counts, digest and spans; score is the highest literal's, else 0.

    Null and empty texts have no spans (the digest of the empty string); repeated rows stay; other columns are ignored."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                base, lexed = find(text)
                n = Counter(k for _, k, _ in base)
                both = sorted({*base, *(x[:3] for x in lexed)})
                out.append((n[0], n[1], n[2], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(both), len(lexed), max((x[3] for x in lexed), default=0.0)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=[f.split()[0] for f in SCHEMA.split(", ")])

    ship(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, SCHEMA)


def redact_text(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with each secret's characters replaced by mark: an assignment's value, not its name."""
    if not text:
        return text
    base, lexed = find(text)
    holes = [(a, b) for a, _, b, _ in lexed]
    for a, kind, b in base:
        if kind == 0:
            m = ASSIGN.match(text, a)
            a = m.start(2)
        holes.append((a, b))
    out, at = [], 0
    for a, b in sorted(holes):
        if b <= at:
            continue
        out += [text[at : max(a, at)], mark if a >= at else ""]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """docs with secrets replaced in text; n_chars, if there, counts the new text. Every row stays, null texts too."""
    names, schema = docs.columns, docs.schema

    def run(batches):
        for batch in slices(batches):
            texts = [redact_text(t) for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, schema)
