"""Token counts per section: whole texts are encoded once, token spans are joined with section spans.

A text is encoded as a whole, so that no section changes how its neighbour is cut. Token ends are running sums of token
lengths in bytes; sections are intervals of the same bytes. The join of both sorted lists of intervals is a binary
search. A token that touches several sections goes to the one that holds most of its bytes, the earlier of equals; its
parts are also shared out by bytes. Tokens outside every section are counted under section -1.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces, small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts text into pieces for this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODERS: dict = {}
# white space of the pattern, in runs that are too long for its look-ahead
LONG_BLANK = re.compile("[ \t\n\r\f\v\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def encoder(path: str, pattern: str):
    """The encoder of a vocabulary file and the byte length of each of its tokens, made once in each process."""
    if (path, pattern) not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _ENCODERS[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _ENCODERS[path, pattern]


def ids_of(encode, text: str) -> list[int]:
    """Ids of a whole text. A very long run of white space is one piece, but for its last character before other text,
    which begins the next piece: the pattern cuts it so, yet its look-ahead fails on such runs."""
    ids, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encode.encode_ordinary(text[at:run.start()]) + encode._encode_single_piece(text[run.start():end])
        at = end
    return ids + encode.encode_ordinary(text[at:])


def line_starts(text: str) -> np.ndarray:
    """Code points at which lines begin; the line break belongs to the line that it ends."""
    at, starts = text.find("\n"), [0]
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts, dtype=np.int64)


def byte_places(text: str, raw: bytes) -> np.ndarray | None:
    """Byte at which each code point begins, and the end; none when both count alike."""
    if len(raw) == len(text):
        return None
    return np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))


def allocate(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """(tokens, share, crossing) per section, then for what lies outside. Sections are sorted and do not overlap.

    tokens: whole tokens by largest part; share: tokens by bytes; crossing: tokens that touch the section and another
    section or none.
    """
    begins = np.concatenate([[0], ends[:-1]])
    # cut the text into sections and the gaps between them, then join by the first and the last piece a token touches
    edges = np.unique(np.concatenate([[0], starts, stops, ends[-1:]]))
    owner = np.searchsorted(starts, edges[:-1], side="right") - 1
    owner = np.where((owner >= 0) & (edges[:-1] < stops[np.maximum(owner, 0)] if len(stops) else False), owner, len(starts))
    first = np.searchsorted(edges, begins, side="right") - 1
    last = np.searchsorted(edges, ends, side="left") - 1
    size = len(starts) + 1
    inside = first == last
    tokens = np.bincount(owner[first[inside]], minlength=size)
    share = tokens.astype(float)
    crossing = np.zeros(size, dtype=np.int64)
    for t in np.flatnonzero(~inside):
        parts: dict[int, int] = {}
        for p in range(first[t], last[t] + 1):
            length = min(edges[p + 1], ends[t]) - max(edges[p], begins[t])
            parts[int(owner[p])] = parts.get(int(owner[p]), 0) + int(length)
        sections = [o for o in parts if o < len(starts)]
        tokens[max(sections or parts, key=lambda o: (parts[o], -o))] += 1
        for o, length in parts.items():
            share[o] += length / (ends[t] - begins[t])
            crossing[o] += len(parts) > 1
    return tokens, share, crossing


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", sections: str | None = None,
                 vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """One row per section of every row: doc_id, section, start, stop, n_tokens, share, n_crossing.

    `sections` names a column of type array<struct<start, stop>> in code points, end exclusive; without it the lines of a
    text are its sections. Sections are taken in order of start (then stop) and numbered so; one that begins inside
    another begins at its end instead; ends beyond the text are cut; null entries and sections that are left empty count
    nothing and keep their number. Tokens that touch no section appear under section -1, from 0 to the text's end, when
    there are any. Null and empty texts have one section of no tokens (as lines), or their sections with no tokens.
    Repeated rows and null keys are kept; the sum of n_tokens over a row is the number of tokens of its whole text.
    """
    def spans(text, given):
        if given is None:
            starts = line_starts(text)
            return starts, np.append(starts[1:], len(text))
        pairs = sorted((max(0, min(s["start"] or 0, len(text))), min(s["stop"] or 0, len(text))) for s in given if s is not None)
        starts = np.array([p[0] for p in pairs], dtype=np.int64)
        stops = np.array([p[1] for p in pairs], dtype=np.int64)
        if len(starts):
            reach = np.concatenate([[0], np.maximum.accumulate(stops)[:-1]])
            starts = np.maximum(starts, reach)
        return starts, np.maximum(starts, stops)

    def run(batches):
        encode, lengths = encoder(vocabulary, pattern)
        for batch in batches:
            given = pieces(batch.column(2)) if sections else iter(lambda: None, 0)
            docs_out, rows = [], []
            for doc, value, listed in zip(pieces(batch.column(0)), pieces(batch.column(1)), given):
                value = value or ""
                starts, stops = spans(value, (listed or []) if sections else None)
                raw = value.encode("utf-8", "surrogatepass")
                ends = np.cumsum(lengths[ids_of(encode, value)]) if value else np.empty(0, dtype=np.int64)
                full = np.flatnonzero(stops > starts)
                counts = np.zeros((3, len(starts) + 1))
                if len(ends):
                    place = byte_places(value, raw)
                    a, b = (starts[full], stops[full]) if place is None else (place[starts[full]], place[stops[full]])
                    counts[:, np.append(full, len(starts))] = allocate(ends, a, b)
                section, start, stop = np.arange(len(starts)), starts, stops
                if counts[0, -1] or counts[2, -1]:
                    section, start, stop = np.append(section, -1), np.append(starts, 0), np.append(stops, len(value))
                docs_out += [doc] * len(section)
                rows.append((section, start, stop, *counts[:, :len(section)]))
                if len(docs_out) > 100_000:
                    yield table_of(docs_out, rows)
                    docs_out, rows = [], []
            yield table_of(docs_out, rows)

    def table_of(docs_out, rows):
        columns = [np.concatenate([r[i] for r in rows]) if rows else np.empty(0) for i in range(6)]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        arrays = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([pa.array(docs_out, key_type), *arrays], names=["doc_id", "section", "start", "stop", "n_tokens", "share", "n_crossing"])

    kind = docs.schema[key].dataType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    columns = [F.col(key), F.col(text)] + ([F.transform(sections, lambda s: F.struct(s["start"].cast("long").alias("start"), s["stop"].cast("long").alias("stop"))).alias("sections")] if sections else [])
    return small_batches(docs).select(*columns).mapInArrow(run, f"doc_id {kind}, section int, start long, stop long, n_tokens long, share double, n_crossing long")
