"""Token counts of fields or sections, from one encoding of the whole document.

A document is encoded once; each token gets its span of characters, and spans are joined with the sections'
intervals. A token that crosses a boundary goes, under the rule
  majority      to the section that holds most of its characters (ties: the earlier),
  first         to the section that holds its first character,
  proportional  to each section by its share of the characters.
Characters of a gap between sections belong to none; a token with none of its characters in a section is not attributed.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..shipping import ship
from .common import hold, slices

RULES = ("majority", "first", "proportional")
#: Fixed value: how the byte-level vocabulary cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_LOADED: dict[int, tuple] = {}


def load(ranks: bytes):
    """The encoder and the bytes of each token, kept for a worker's life."""
    key = hash(ranks)
    if key not in _LOADED:
        import tiktoken

        held = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        sizes = np.zeros(max(held.values()) + 1, np.int64)
        for token, i in held.items():
            sizes[i] = len(token)
        _LOADED.clear()
        _LOADED[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=held, special_tokens={}), sizes
    return _LOADED[key]


def token_spans(text: str, encoder, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) character of each token; a token that holds part of a character's bytes covers it."""
    ids = np.asarray(encoder.encode_ordinary(text), np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    if text.isascii():
        return starts, ends
    of_byte = np.cumsum((np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) & 0xC0) != 0x80) - 1
    return of_byte[starts], of_byte[ends - 1] + 1


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feeds; an empty text is one empty section."""
    feeds, at = [], text.find("\n")
    while at >= 0:
        feeds.append(at + 1)
        at = text.find("\n", at + 1)
    if feeds and feeds[-1] == len(text):
        feeds.pop()
    return np.array([0, *feeds], np.int64), np.array([*feeds, len(text)], np.int64)


def attribute(starts, ends, left, right, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section [left, right) (sorted, disjoint), and how many tokens that cross one of its boundaries touch it."""
    n = len(left)
    first = np.searchsorted(right, starts, "right")  # the first section that ends behind the token's start
    last = np.searchsorted(left, ends, "left") - 1  # the last that begins before its end
    inside = (first == last) & (first < n)
    at = np.minimum(first, n - 1)
    inside &= (starts >= left[at]) & (ends <= right[at])
    counts = np.bincount(first[inside], minlength=n).astype(np.float64)
    crossing = np.zeros(n, np.int64)
    for t in np.flatnonzero(~inside & (first <= last)):
        held = np.arange(first[t], last[t] + 1)
        overlap = np.minimum(ends[t], right[held]) - np.maximum(starts[t], left[held])
        held, overlap = held[overlap > 0], overlap[overlap > 0]
        if not len(held):
            continue
        crossing[held] += 1
        if rule == "proportional":
            counts[held] += overlap / (ends[t] - starts[t])
        elif rule == "majority":
            counts[held[np.argmax(overlap)]] += 1
        elif left[held[0]] <= starts[t]:
            counts[held[0]] += 1
    return counts, crossing


SCHEMA = "doc_id bigint, section bigint, char_start bigint, char_end bigint, n_tokens double, n_crossing bigint"


def count_tokens(docs: DataFrame, *, vocabulary: str = VOCABULARY, rule: str = "majority", sections: str | None = None) -> DataFrame:
    """A row for each section of each row of docs (doc_id, text): its span, tokens and boundary-crossing tokens.

    sections: a column of docs with array<struct<start, end>> (characters; sorted, disjoint), or None for the lines.
    vocabulary: a .tiktoken file that the driver reads. Null and empty texts have one empty section without tokens;
    a document whose sections are null or empty gives no row; repeated rows stay; other columns are ignored."""
    if rule not in RULES:
        raise ValueError(f"rule: one of {RULES}")
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        hold("tokens", _LOADED.clear)
        encoder, sizes = load(held.value)
        for batch in slices(batches):
            ids, parts = [], []
            given = batch.column("sections") if sections else None
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                text = text or ""
                if given is None:
                    left, right = line_sections(text)
                else:
                    spans = [(s["start"], s["end"]) for s in given[i].as_py() or ()]
                    left, right = (np.array([s[j] for s in spans], np.int64) for j in (0, 1))
                if not len(left):
                    continue
                counts, crossing = attribute(*token_spans(text, encoder, sizes), left, right, rule) if text else (np.zeros(len(left)), np.zeros(len(left), np.int64))
                ids += [doc_id] * len(left)
                parts.append((np.arange(len(left)), left, right, counts, crossing))
                if len(ids) >= 50_000:
                    yield _batch(ids, parts, names)
                    ids, parts = [], []
            if ids:
                yield _batch(ids, parts, names)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text", *([f"`{sections}` as sections"] if sections else [])).mapInArrow(run, SCHEMA)


def _batch(ids, parts, names):
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, columns)], names=names)
