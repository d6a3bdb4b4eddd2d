"""Token counts by offset-mapped attribution.

A document is encoded once, whole. Token byte lengths give each token's span of characters, and a sorted interval
join inside the document gives it to the sections (sentences, lines, or spans that the caller brings, as of fields
joined to one text). A token that crosses a boundary is dealt out by an explicit rule:

- first: to the section of its first character
- most: to the section with most of its characters, the earlier one if equal
- share: to every section by the part of its characters there (a token inside a character counts for that character)
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, quoted, table, whole

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as in PATTERN, so much of it in a row that its look-ahead would have too far to go back.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")
RULES = ("first", "most", "share")
SECTIONS = ("lines", "sentences")
OUTSIDE = -1


@functools.cache
def encoder(path: str) -> tuple:
    """The encoding of a vocabulary file of ranks, and the bytes in each token; once for each worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def token_ids(text: str, path: str) -> np.ndarray:
    """The tokens of a text. PATTERN takes a run of white space but for its last sign as one piece (all of it at the end); long runs are cut out as this."""
    encoding, _ = encoder(path)
    encode = lambda part: encoding.encode_to_numpy(part, disallowed_special=())
    out, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [encode(text[at : run.start()]), np.array(encoding._encode_single_piece(text[run.start() : end]), np.int64)]
        at = end
    return np.concatenate([*out, encode(text[at:])]) if out else encode(text)


def token_spans(body: bytes, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token of valid UTF-8 in code points. A token that holds a part of a character spans that character."""
    _, size = encoder(path)
    ids = token_ids(body.decode(), path).astype(np.int64)
    end = np.cumsum(size[ids])
    start = end - size[ids]
    if not body.isascii():
        raw = np.frombuffer(body, np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        start, end = char[start], char[end - 1] + 1
    return start, end


def section_spans(body: bytes, sections: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feeds, or sentences with one space after them, in code points."""
    raw = np.frombuffer(body, np.uint8)
    stop = raw == 10
    if sections == "sentences":
        stop[1:] |= (raw[1:] == 32) & ((raw[:-1] == 46) | (raw[:-1] == 33) | (raw[:-1] == 63))
    end = np.flatnonzero(stop) + 1
    if not len(end) or end[-1] != len(raw):
        end = np.append(end, len(raw))
    if not body.isascii():
        end = np.cumsum((raw & 0xC0) != 0x80)[end - 1]
    return np.append(0, end[:-1]), end


def attribute(start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each of the disjoint sorted spans [lo, hi), then of none (last); and how many of them cross its bounds."""
    n = len(lo)
    first = np.searchsorted(hi, start, "right")
    last = np.searchsorted(lo, end, "left") - 1
    inside = (first == last) & (start >= lo[np.minimum(first, n - 1)]) & (end <= hi[np.minimum(first, n - 1)])
    tokens = np.bincount(first[inside], minlength=n + 1).astype(float)
    crossing = np.zeros(n + 1, np.int64)
    # most that cross lie in two sections that touch
    two = ~inside & (last == first + 1)
    two[two] = (start[two] >= lo[first[two]]) & (hi[first[two]] == lo[last[two]]) & (end[two] <= hi[last[two]])
    i = np.flatnonzero(two)
    left, right = hi[first[i]] - start[i], end[i] - lo[last[i]]
    crossing += np.bincount(first[i], minlength=n + 1) + np.bincount(last[i], minlength=n + 1)
    part = {"first": np.ones(len(i)), "most": (left >= right).astype(float), "share": left / (left + right)}[rule]
    tokens += np.bincount(first[i], part, n + 1) + np.bincount(last[i], 1 - part, n + 1)
    for i in np.flatnonzero(~inside & ~two):
        a, b, s, e = first[i], last[i], start[i], end[i]
        parts = [(j, min(e, hi[j]) - max(s, lo[j])) for j in range(a, b + 1)]
        parts = [(j, w) for j, w in parts if w > 0]
        gap = (e - s) - sum(w for _, w in parts)
        if not parts:
            tokens[n] += 1
            continue
        for j, _ in parts:
            crossing[j] += 1
        if gap:
            parts.append((n, gap))
        if rule == "share":
            for j, w in parts:
                tokens[j] += w / (e - s)
        elif rule == "most":
            tokens[max(parts, key=lambda p: (p[1], -p[0]))[0]] += 1
        else:
            tokens[next((j for j, _ in parts if j < n and lo[j] <= s < hi[j]), n)] += 1
    return tokens, crossing


def token_counts(docs: DataFrame, rule: str = "most", sections: str = "lines", vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text", spans: str | None = None) -> DataFrame:
    """One row for each section of each row of docs: doc_id, section, start, end, n_tokens, n_crossing, doc_tokens.

    Sections are the lines or sentences of a text, numbered from 0, or where given the spans column: an array of (start, end) in
    code points, sorted and disjoint; characters in no span are section -1, whose start and end are null and which is
    left out if no token falls to it. n_tokens is a double that is whole unless the rule is share, and adds up to
    doc_tokens over a row of docs. Null and empty texts have one section 0 without tokens, or none where spans are given. Bytes that
    are no UTF-8 count as replacement characters, in spans too. Very long texts are encoded whole, one Arrow batch of texts at a
    time. Repeated rows give repeated sections; an empty table gives none; other columns are not read.

    vocabulary is the path of a file of ranks that every executor has (or gets by --files).
    """
    if rule not in RULES or sections not in SECTIONS:
        raise ValueError(f"rule must be one of {RULES}, sections one of {SECTIONS}")
    schema = "doc_id long, section int, start int, end int, n_tokens double, n_crossing long, doc_tokens long"

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        given = kept["spans"].to_pylist() if spans else None
        out: dict[str, list] = {k: [] for k in ("row", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")}
        for i, body in enumerate(bodies):
            body = whole(body)
            s, e = token_spans(body, vocabulary) if body else (np.empty(0, np.int64),) * 2
            if given is None:
                lo, hi = section_spans(body, sections) if body else (np.zeros(1, np.int64),) * 2
            else:
                lo, hi = (np.array([x[k] for x in given[i] or ()], np.int64) for k in ("start", "end"))
            n = len(lo)
            if n:
                tokens, crossing = attribute(s, e, lo, hi, rule)
            else:
                tokens, crossing = np.array([float(len(s))]), np.zeros(1, np.int64)
            m = n + (tokens[n] > 0)
            out["row"].append(np.full(m, i))
            out["section"].append(np.append(np.arange(n), OUTSIDE)[:m])
            out["start"].append(np.append(lo, -1)[:m])
            out["end"].append(np.append(hi, -1)[:m])
            out["n_tokens"].append(tokens[:m])
            out["n_crossing"].append(crossing[:m])
            out["doc_tokens"].append(np.full(m, len(s)))
        cols = {k: np.concatenate(v) for k, v in out.items()}
        none = cols["section"] == OUTSIDE
        kinds = {"section": pa.int32(), "start": pa.int32(), "end": pa.int32(), "n_tokens": pa.float64(), "n_crossing": pa.int64(), "doc_tokens": pa.int64()}
        return {"doc_id": kept["doc_id"].take(pa.array(cols["row"]))} | {k: pa.array(cols[k], t, mask=none if k in ("start", "end") else None) for k, t in kinds.items()}

    picked = [quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text")] + ([quoted(spans).cast("array<struct<start:int,end:int>>").alias("spans")] if spans else [])
    return map_texts(docs.select(*picked), per_batch, schema, ["doc_id"] + (["spans"] if spans else []))


def joined_fields(fields: dict[str, Column], separator: str = "\n") -> tuple[Column, Column]:
    """One text from several fields, and the spans of the fields in it; nulls are empty. The separator belongs to no field."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in fields.values()]
    spans, at = [], F.lit(0)
    for p in parts:
        end = at + F.length(p)
        spans.append(F.struct(at.alias("start"), end.alias("end")))
        at = end + len(separator)
    return F.concat_ws(separator, *parts), F.array(*spans)


def op1_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), sections="sentences")
