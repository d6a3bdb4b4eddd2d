"""Personal data by weak supervision.

The base kinds (email, ip, card, phone) are found by pattern and stay. For strings that may be a secret, an id number, a name or an address,
four labelers vote yes, no or nothing: a regex for the strict form, a gazetteer (key prefixes, country codes, first names, kinds of streets, and harmless
words), the context before the string, and a check of what it is made of (randomness, check digits). For each kind, expectation
maximisation over the counts of all vote patterns of the corpus estimates how reliable each labeler is; the posteriors
train the final span classifier, a logistic regression on how a span is written and where it stands (length, case, quotes, alphabet, line); of
these the labelers look at the length alone, and at the check digits that an id has in the place of the alphabet. Votes and features take few values, so what reaches the driver is a table of at
most PATTERNS rows whatever the corpus, and both fits cover every candidate.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, materialise, quoted, table

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only start where a run of digits does, so the look-behind changes no match and keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

ADDED = ("secret", "id", "name", "address")
# Beginnings of well-known key formats, words that announce a secret, words that make one harmless.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk-", "sk_live_", "rk_live_", "xoxb-", "xoxp-", "AIza", "ya29", "eyJ", "npm_", "hf_", "pypi-")
ANNOUNCE = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key", "access_key", "auth", "bearer", "credential", "private_key")
HARMLESS = ("example", "sample", "version", "http", "www", "isbn", "uuid")
# Countries with IBANs, titles, first names, kinds of streets, words that announce an id, a name or an address, and words that rule them out.
COUNTRIES = ("AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "HU", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Mlle", "Señor", "Señora", "Sr", "Sra")
FIRST_NAMES = (
    "Alice", "Ana", "Anna", "Antonio", "Carlos", "Charles", "Claire", "David", "Elizabeth", "Emma", "Francois", "Hans", "Heinrich", "James", "Jean",
    "Jennifer", "John", "Jose", "Juan", "Karl", "Klaus", "Laura", "Linda", "Maria", "Marie", "Mary", "Michael", "Michel", "Patricia", "Paul", "Peter",
    "Pierre", "Robert", "Sarah", "Sofia", "Sophie", "Susan", "Thomas", "Ursula", "William",
)
STREETS = ("Street", "St", "Road", "Rd", "Avenue", "Ave", "Lane", "Drive", "Boulevard", "Blvd", "Court", "Square", "rue", "avenue", "boulevard", "calle", "Calle", "Avenida", "Plaza")
ID_WORDS = ("iban", "ssn", "social security", "passport", "account", "konto", "compte", "cuenta", "id number", "national id")
NAME_WORDS = ("name is", "my name", "named", "signed by", "name:", "contact:", "ich heisse", "ich heiße", "je m'appelle", "me llamo", "yours,")
PLACE_WORDS = ("address", "lives at", "live at", "located at", "ship to", "adresse", "anschrift", "domicilio", "dirección", "wohnt in", "wohnhaft")
NO_ID = ("isbn", "order", "invoice", "version", "part", "fax", "model")
NO_NAME = ("street", "road", "avenue", "the", "saint", "university", "hotel", "company")
NO_PLACE = ("page", "chapter", "section", "figure", "volume", "table")
WORD = r"[A-Z][^\W\d_]+(?:['’-][^\W\d_]+)*"
CANDIDATES = (
    ("id", re.compile(r"(?<![\w-])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])")),
    ("address", re.compile(rf"(?<![\w.])(?:[0-9]{{1,5}},? (?:{WORD} ){{1,3}}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Blvd|Court|Square)|[0-9]{{1,4}},? (?:rue|avenue|boulevard) (?:\w+ ){{0,2}}{WORD}|(?:[Cc]alle|Avenida|Plaza) (?:\w+ ){{0,2}}{WORD},? [0-9]{{1,4}}|[A-Z][^\W\d_]+(?:straße|strasse|gasse|allee|platz) [0-9]{{1,4}})(?!\w)")),
    ("name", re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.? +{WORD}(?: {WORD}){{0,2}}|(?:{'|'.join(FIRST_NAMES)}) {WORD})(?!\w)")),
    ("secret", re.compile(r"[A-Za-z0-9_/+=-]{12,}+")),
)
NAMED = re.compile(rb"\b(?:" + "|".join(TITLES + FIRST_NAMES).encode() + rb")\b")
LABELED = re.compile(r"(?i)(?:" + "|".join(map(re.escape, ANNOUNCE)) + r")[\"']?\s{0,2}[=:]?\s{0,2}[\"']?$")
PROSE = re.compile(r"[^\W\d_]{2,}[,.;]? $")
STRONG = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,}|[A-Za-z_-]{2,14}=[\"']?(?=[0-9a-zA-Z]*[0-9])[0-9a-zA-Z]{12,}|gh[po]_[0-9A-Za-z]{30,}|sk-[0-9A-Za-z]{20,}")
CONTEXT = 24
LABELERS = 4
NO, YES, NONE = 0, 1, 2
FEATURES = (5, 4, 2, 2, 2)  # values of each feature: length, case, quoted, hexadecimal or (of ids) with sound check digits, begins a line
PATTERNS = len(ADDED) * 3**LABELERS * math.prod(FEATURES)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain; the local part is the run before an @, back to the last match at most."""
    out, begin, at = [], 0, text.find("@")
    while at >= 0:
        before = text[begin:at]
        run = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if run else None
        if m:
            out.append((at - run, m.end()))
        begin = m.end() if m else at + 1
        at = text.find("@", begin)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans in order of kind, then start; a match that fails its check is dropped and not retried."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def _vote(yes: bool, no: bool) -> int:
    return YES if yes else NO if no else NONE


def secret_votes(s: str, before: str) -> tuple[int, ...]:
    value = s.rpartition("=")[2].strip("\"'") or s
    low = s.lower()
    digits, letters = sum(c.isdigit() for c in value), sum(c.isalpha() for c in value)
    bits = entropy(value)
    announced = bool(LABELED.search(before)) or any(low.startswith(w) and "=" in s for w in ANNOUNCE)
    return (
        _vote(bool(STRONG.fullmatch(s)), not digits or not letters),
        _vote(value.startswith(PREFIXES), any(w in low for w in HARMLESS)),
        _vote(announced, bool(PROSE.search(before)) and "=" not in s and not value.startswith(PREFIXES)),
        _vote(bits >= 3.0 and digits >= 2 and letters > 0, bits < 2.5 or not digits),
    )


def sound_id(s: str) -> bool:
    """Check digits of a bank account, or the areas, groups and serials that a social security number can have."""
    if "-" in s:
        return s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"
    plain = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def id_votes(s: str, before: str) -> tuple[int, ...]:
    plain, low = s.replace(" ", ""), before.lower()
    known, sound = NONE if "-" in s else _vote(plain[:2] in COUNTRIES, True), sound_id(s)
    context = _vote(any(w in low for w in ID_WORDS), any(w in low for w in NO_ID))
    return _vote("-" in s or 15 <= len(plain) <= 34, True), known, context, _vote(sound, True)


def name_votes(s: str, before: str) -> tuple[int, ...]:
    words = s.replace(".", " ").split()
    low = before.lower()
    titled = words[0] in TITLES
    first = [w for w in words if w in FIRST_NAMES]
    return (
        _vote(len(words) >= 3 or (len(words) == 2 and not titled), any(w.isupper() for w in words if len(w) > 1)),
        _vote(bool(first), any(w.lower() in NO_NAME for w in words)),
        _vote(titled or any(w in low for w in NAME_WORDS), low.rstrip().endswith(NO_NAME)),
        _vote(False, any(len(w) > 20 for w in words)),
    )


def address_votes(s: str, before: str) -> tuple[int, ...]:
    low = before.lower()
    number = re.search("[0-9]+", s)[0]
    return (
        _vote(True, False),
        _vote(any(w in STREETS for w in s.replace(",", " ").split()), False),
        _vote(any(w in low for w in PLACE_WORDS), any(w in low for w in NO_PLACE)),
        _vote(number[0] != "0" and len(number) <= 4, number[0] == "0"),
    )


VOTES = {"secret": secret_votes, "id": id_votes, "name": name_votes, "address": address_votes}


def shape(s: str, before: str, after: str, kind: str) -> tuple[int, ...]:
    """The features of a span: how it is written and where it stands."""
    value = s.rpartition("=")[2].strip("\"'") or s
    letters = [c for c in value if c.isalpha()]
    case = 0 if not letters else 1 if value == value.lower() else 2 if value == value.upper() else 3
    quoted = bool(before[-1:]) and before[-1] in "\"'=:" or after[:1] in ("\"", "'")
    return sum(len(value) >= n for n in (16, 20, 32, 40)), case, int(quoted), int(sound_id(s) if kind == "id" else all(c in "0123456789abcdefABCDEF" for c in value)), int(before[-1:] in ("", "\n"))


def pattern_of(s: str, before: str, after: str = "", kind: str = "secret") -> int:
    """Kind, votes and features of a candidate, as one number under PATTERNS."""
    code = ADDED.index(kind)
    for x, n in zip((*VOTES[kind](s, before), *shape(s, before, after, kind)), (3,) * LABELERS + FEATURES, strict=True):
        code = code * n + x
    return code


def unpack(code: int) -> tuple[list[int], list[int]]:
    """The votes and the features of a pattern; kind_of has its kind."""
    values = []
    for n in reversed((3,) * LABELERS + FEATURES):
        code, x = divmod(code, n)
        values.append(x)
    values.reverse()
    return values[:LABELERS], values[LABELERS:]


def kind_of(code: int) -> str:
    return ADDED[code // (PATTERNS // len(ADDED))]


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, pattern), by start, of what may be personal; nothing that a base span or a candidate of an earlier kind touches. Secrets have a digit."""
    out, taken = [], [(x, y) for _, x, y in base]
    for kind, form in CANDIDATES:
        mine = []
        for m in form.finditer(text):
            s, e = m.span()
            if kind == "secret" and not any("0" <= c <= "9" for c in m[0]) or any(s < y and x < e for x, y in taken):
                continue
            mine.append((s, e))
            out.append((s, e, pattern_of(m[0], text[max(0, s - CONTEXT) : s], text[e : e + 1], kind)))
        taken += mine
    return sorted(out)


def reliabilities(votes: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Dawid-Skene for two classes: posterior of each pattern, and P(vote | class) as [labeler, class, vote]."""
    yes, no = (votes == 1).sum(1), (votes == 0).sum(1)
    post = (yes + 0.5) / (yes + no + 1)
    table_ = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        prior = np.clip((weight * post).sum() / weight.sum(), 0.01, 0.99)
        for j in range(votes.shape[1]):
            for v in range(3):
                hit = weight * (votes[:, j] == v)
                table_[j, 1, v], table_[j, 0, v] = (hit * post).sum() + 1, (hit * (1 - post)).sum() + 1
            table_[j] /= table_[j].sum(1, keepdims=True)
        like = [np.log(p) + sum(np.log(table_[j, c, votes[:, j]]) for j in range(votes.shape[1])) for c, p in ((0, 1 - prior), (1, prior))]
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))
    return post, table_


def one_hot(features: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(features), 1)), *[np.eye(n)[features[:, i]] for i, n in enumerate(FEATURES)]])


def span_classifier(features: np.ndarray, soft: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    x = one_hot(features)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - soft)) + ridge * w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def fit(counts: list[tuple[int, int]]) -> list[int]:
    """The patterns that the final classifier of their kind takes for personal, from (pattern, count) over the corpus."""
    out = []
    for kind in ADDED:
        mine = [(c, n) for c, n in counts if kind_of(c) == kind]
        if not mine:
            continue
        codes, weight = [c for c, _ in mine], np.array([n for _, n in mine], float)
        votes, features = (np.array(x) for x in zip(*map(unpack, codes), strict=True))
        post, _ = reliabilities(votes, weight)
        z = one_hot(features) @ span_classifier(features, post, weight)
        out += [c for c, s in zip(codes, z, strict=True) if s >= 0]
    return out


def maybe_personal(body: bytes) -> bool:
    """Every kind has an @, a digit, a title or a first name."""
    return b"@" in body or len(body) != len(body.translate(None, b"0123456789")) or bool(NAMED.search(body))


def pattern_counts(docs: DataFrame) -> list[tuple[int, int]]:
    """(pattern, count) of all candidates of docs(text), at most PATTERNS."""

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        n: Counter = Counter()
        for body in bodies:
            if body and maybe_personal(body):
                s = body.decode("utf-8", "replace")
                n.update(p for _, _, p in candidates(s, base_spans(s)))
        return {"pattern": pa.array(list(n), pa.int32()), "n": pa.array(list(n.values()), pa.int64())}

    return [tuple(r) for r in map_texts(docs, per_batch, "pattern int, n long", []).groupBy("pattern").agg(F.sum("n")).orderBy("pattern").collect()]


def _kind(pattern: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, ADDED)), (F.floor(pattern / (PATTERNS // len(ADDED))) + 1).cast("int"))


def find_personal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, counts, base_sha256, base and added spans, spans.

    base and added are arrays of (kind, start, end) in code points, end exclusive, added ones by start. Null and empty texts have none;
    bytes that are no UTF-8 count as replacement characters; very long texts are taken whole, one Arrow batch of texts at a time. A null doc_id stays null.
    Repeated rows give repeated rows and count as often in the fit; an empty table gives none; other columns are not read.
    """
    span = "array<struct<kind:string,start:int,end:int>>"
    cand = "array<struct<start:int,end:int,pattern:int>>"

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        base, extra, digest = [], [], []
        for body in bodies:
            body = body or b""
            found, more = [], []
            if maybe_personal(body):
                s = body.decode("utf-8", "replace")
                found = base_spans(s)
                more = candidates(s, found)
            base.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in found])
            extra.append([dict(zip(("start", "end", "pattern"), x, strict=True)) for x in more])
            digest.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())
        i = pa.int32()
        return {
            "doc_id": kept["doc_id"],
            "base_sha256": digest,
            "base": pa.array(base, pa.list_(pa.struct([("kind", pa.string()), ("start", i), ("end", i)]))),
            "extra": pa.array(extra, pa.list_(pa.struct([("start", i), ("end", i), ("pattern", i)]))),
        }

    docs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    found = materialise(map_texts(docs, per_batch, f"doc_id long, base_sha256 string, base {span}, extra {cand}", ["doc_id"]), "pii")
    counts = found.select(F.explode("extra.pattern").alias("p")).groupBy("p").count().orderBy("p").collect()  # at most PATTERNS rows
    taken = F.array(*[F.lit(p) for p in fit([(r["p"], r["count"]) for r in counts])]).cast("array<int>")
    added = F.transform(F.filter("extra", lambda x: F.array_contains(taken, x["pattern"])), lambda x: F.struct(_kind(x["pattern"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    out = found.withColumn("added", added)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    written = F.array_join(F.transform(F.concat("base", "added"), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.select("doc_id", *map(count, KINDS), "base_sha256", written.alias("spans"), "base", "added")


def redacted(docs: DataFrame, length: str | None = None) -> DataFrame:
    """The rows of docs(text, ...), their personal data replaced by [EMAIL], [IP], [CARD], [PHONE], [SECRET], [ID], [NAME] or [ADDRESS].

    Spans that touch are replaced by the first one's kind. The column named by length is set to the new length in
    code points. Null and empty texts stay so. All columns and rows stay as they are otherwise, repeated ones and those without an id too; an
    empty table gives none. Two passes over the texts: the first counts the patterns of all candidates for the fit.
    """
    others = [c for c in docs.columns if c not in ("text", length)]
    taken = set(fit(pattern_counts(docs)))

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        texts = []
        for body in bodies:
            if body is not None and maybe_personal(body):
                s = body.decode("utf-8", "replace")
                base = base_spans(s)
                spans = sorted([(a, b, k) for k, a, b in base] + [(a, b, kind_of(p)) for a, b, p in candidates(s, base) if p in taken])
                out, end = [], 0
                for a, b, k in spans:
                    if a >= end:
                        out += [s[end:a], f"[{k.upper()}]"]
                    end = max(end, b)
                texts.append("".join([*out, s[end:]]))
            else:
                texts.append(None if body is None else body.decode("utf-8", "replace"))
        return {f"k{i}": kept[c] for i, c in enumerate(others)} | {"body": pa.array(texts, pa.string())}

    kinds = dict(docs.dtypes)
    out = map_texts(docs, per_batch, ", ".join([f"k{i} {kinds[c]}" for i, c in enumerate(others)] + ["body string"]), others)
    new = {c: F.col(f"k{i}") for i, c in enumerate(others)} | {"text": F.col("body")}
    if length:
        new[length] = F.length("body").cast(kinds[length])
    return out.select(*[new[c].alias(c) for c in docs.columns])


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents")).drop("base", "added")
