"""Secret scan by assignment-aware lexing.

Base spans are what three fixed patterns find (assigned values after a credential
word, access key ids, long hex runs). Beside them, texts that hold a sensitive word are
lexed into name-literal pairs (``assignments``: assignments and mappings with type
annotations and subscripts, calls, directives, tags, block scalars), and constants are
propagated from name to name to a fixed point, by scope. Every literal is
then scored by the most sensitive name it reaches, its length, its character mix and its entropy, and
reported as kind ``lexed`` when the score reaches ``min_score``. A literal with spaces
has the score of its longest part without one, after a scheme word such as Bearer;
under names of passwords and passphrases, its length and number of words count too. Base spans always
stay; a lexed literal that lies inside a base span is not told twice.

Spans count code points, end exclusive. Defined results: a null text is an empty
text and has no span; repeated rows are scanned each; an empty table gives an
empty result; long texts are scanned whole. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm import assignments

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: What a text must hold somewhere to have a base span, for a linear-time matcher.
MAYBE = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"

KINDS = ("assign", "access", "hex", "lexed")

# Parts of names, and how much they say that a value is a secret.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
             "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "private": 0.6,
             "access": 0.5, "signing": 0.6, "encryption": 0.6, "session": 0.4, "key": 0.4, "pin": 0.4, "salt": 0.5}
#: Names whose values may be several plain words.
PHRASES = {"passphrase", "password", "passwd", "pwd"}
#: Words before a credential in one literal.
SCHEMES = {"bearer", "basic", "digest", "token", "apikey", "negotiate", "ntlm", "hawk"}
PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|(your|my|some|an?)[-_ ].*|example.*|changeme|placeholder|none|null|true|false|undefined|todo|<.*|\$\{.*|%\(.*)$")

#: What a text must hold somewhere to have a pair with a sensitive name: one of these words,
#: whole or in parts, and a mark that a pair has.
PAIRS = "(?i)" + "|".join("[_.-]*".join(word) for word in SENSITIVE)
PAIR_MARKS = r"[:=(<]|#[ \t]*define|ENV|ARG|setenv|setx"
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def _parts(name: str) -> list[str]:
    """The parts of a name, and joined pairs such as api key."""
    parts = [p.lower() for p in _WORDS.findall(name)]
    return parts + [a + b for a, b in zip(parts, parts[1:], strict=False)]


def name_weight(name: str) -> float:
    """How sensitive a name is: its strongest part, or a joined pair."""
    return max((SENSITIVE.get(p, 0.0) for p in _parts(name)), default=0.0)


def literal_score(value: str, phrase: bool = False) -> float:
    """0 to 1: long, mixed and irregular values score high; with ``phrase``, long
    values of several words too."""
    if len(value) < 8 or PLACEHOLDER.match(value):
        return 0.0
    if " " in value:
        words = value.split()
        if words and words[0].lower().rstrip(":") in SCHEMES:
            words, phrase = words[1:], False
        score = literal_score(max(words, key=len, default=""))
        return max(score, 0.5 * min(1, len(value) / 20) + 0.5 * min(1, len(words) / 4)) if phrase and len(words) > 1 else score
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.35 * min(1, n / 20) + 0.45 * min(1, entropy / 3.5) + 0.2 * min(1, (kinds - 1) / 2))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def lexed_spans(text: str, min_score: float) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name with a high enough score."""
    best, phrases = {}, set()
    for span, weight, phrase in assignments.literals_of(text, name_weight, lambda name: not PHRASES.isdisjoint(_parts(name))):
        best[span] = weight
        if phrase:
            phrases.add(span)
    scores = {s: literal_score(text[s[0]:s[1]], s in phrases) for s in best}
    return sorted(s for s, weight in best.items() if 0.5 * weight + 0.5 * scores[s] >= min_score and scores[s] > 0)


def scan_text(text: str, min_score: float, pairs: bool = True) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    more = []
    if pairs:
        more = [(a, 3, b) for a, b in lexed_spans(text, min_score) if not any(s <= a and b <= e for s, _, e in base)]
    return base, sorted(base + more)


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_lexed", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
_NONE = hashlib.sha256(b"").hexdigest()


def _scanner(min_score: float):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(1)
            maybe = pc.fill_null(pc.match_substring_regex(texts, MAYBE), False)
            pairs = pc.fill_null(pc.and_(pc.match_substring_regex(texts, PAIRS), pc.match_substring_regex(texts, PAIR_MARKS)), False)
            n = batch.num_rows
            counts, shas, spans = [[0] * n for _ in KINDS], [_NONE] * n, [""] * n
            for i in pc.indices_nonzero(pc.or_(maybe, pairs)).to_pylist():
                base, found = scan_text(texts[i].as_py(), min_score, pairs[i].as_py())
                for _, k, _ in found:
                    counts[k][i] += 1
                if base:
                    shas[i] = hashlib.sha256(_said(base).encode()).hexdigest()
                spans[i] = _said(found)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas), pa.array(spans)], schema=_OUT)
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.7) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_lexed, base_sha256, spans: a row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(_scanner(min_score), "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_sha256 string, spans string")
    return found.withColumnRenamed("doc_id", id_col)
