"""Secret scans: fixed patterns, and password guess cost for values in a credential context.

Base spans (kinds ``assign``, ``access``, ``hex``) come from patterns over whole
texts. The method adds ``guess`` spans: a value that follows a credential word
(also one of several joined words) and an assignment sign, in quotes up to the
same quote, else up to white space, is cut into dictionary words, dates, repeats, keyboard or
alphabet walks and brute-force spans by dynamic programming over all cuts; the
cut with the fewest guesses tells how hard the value is to find. Values of at
least ``min_log10`` guesses that no base span contains whole are reported, so
``password=sunshine1999`` is cheap and ``pwd: vK9#tq2L`` is a secret.

Words are ranked by ``COMMON`` and by a bounded count over the texts themselves, so
prose in quotes is cheap. A value has no greatest length; its cost takes time linear
in it. Two scans, of which the first shuffles word counts; spans are code points, end exclusive. Defined results:
null or empty text has no spans (digest of the empty text); repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.session import settle

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run is taken whole, so the length can be asked for at once
# A credential word, up to three joined words (secret_key, AWS_SECRET_ACCESS_KEY), a sign, and the value: in quotes all up to the
# same quote on the line, else all up to white space.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[-_\x20]?key|auth(?:orization)?|credentials?|private[-_\x20]?key|access[-_\x20]?key)"""
    r"""(?:[-_\x20][A-Za-z0-9]{1,30}){0,3}["'`]?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:(?:Bearer|Basic)[\x20\t]+)?"""
    r"""(?:"((?:\\.|[^"\\\n])+)"|'((?:\\.|[^'\\\n])+)'|`([^`\n]+)`|["'`]?([^\x00-\x20"'`][^\x00-\x20]{5,}))""", re.I | re.A)
PROSE = re.compile(r"(?<![^\W_])[^\W\d_]{3,20}(?![^\W_])")
LONGEST = 20  # letters of a ranked word
HINTS = ("pass", "pwd", "pin", "secret", "token", "api", "auth", "credential", "private")

# Common password words, most frequent first.
COMMON = ("password pass admin welcome letmein monkey dragon login master hello freedom whatever shadow sunshine princess football "
          "baseball iloveyou trustno superman batman michael jordan hunter ranger buster soccer hockey killer george charlie andrew "
          "thomas jessica pepper daniel access joshua maggie starwars silver william dallas yankees ashley hammer summer winter spring "
          "autumn orange cookie ginger secret token key user guest root test example changeme default public private null none true "
          "false string value your the and for with this that from not please enter here env var config").split()
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_ranks = {w: r for r, w in enumerate(COMMON, 1)}
_next = {(a, b) for row in ROWS for line in (row, row[::-1]) for a, b in zip(line, line[1:])}
_date = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")


def alphabet(piece: str) -> int:
    return (26 * bool(re.search("[a-z]", piece)) + 26 * bool(re.search("[A-Z]", piece)) + 10 * bool(re.search("[0-9]", piece))
            + 33 * bool(re.search("[^A-Za-z0-9]", piece))) or 1


def repeats_from(value: str, unit: int) -> list[int]:
    """For each place, how many characters from there on equal the one ``unit`` later."""
    same = [0] * (len(value) + 1)
    for i in range(len(value) - unit - 1, -1, -1):
        if value[i] == value[i + unit]:
            same[i] = same[i + 1] + 1
    return same


def pieces_from(value: str, ranks: dict[str, int] = _ranks) -> Iterator[list[tuple[int, float, str]]]:
    """For each place, (end, log10 guesses, kind) of every word, date, repeat and walk that starts there; linear in the value."""
    low, n = value.lower(), len(value)
    walk = [1] * n
    for i in range(n - 2, -1, -1):
        if (low[i], low[i + 1]) in _next:
            walk[i] += walk[i + 1]
    same = {unit: repeats_from(value, unit) for unit in range(1, min(8, n // 2) + 1)}
    for i in range(n):
        found = []
        for j in range(i + 3, min(n, i + LONGEST) + 1):
            if not low[j - 3:j].isalpha():
                break
            if rank := ranks.get(low[i:j]):
                cased = value[i:j] != low[i:j]
                found.append((j, math.log10(rank) + cased * math.log10(2 if value[i:j].istitle() or value[i:j].isupper() else 2 ** (j - i)), "word"))
        if m := _date.match(value, i):
            found.append((m.end(), math.log10(200 * (12 if m.end() - i > 4 else 1) * (31 if m.end() - i > 7 else 1)), "date"))
        if walk[i] >= 3:
            found.append((i + walk[i], math.log10(80 * walk[i]), "walk"))
        for unit, after in same.items():
            times = 1 + after[i] // unit
            if times > 1 and times * unit >= 3:
                found.append((i + times * unit, unit * math.log10(alphabet(value[i:i + unit])) + math.log10(times), "repeat"))
        yield found


def pieces(value: str) -> list[tuple[int, int, float, str]]:
    """(start, end, log10 guesses, kind) of every word, date, repeat and walk inside ``value``."""
    return [(i, *piece) for i, found in enumerate(pieces_from(value)) for piece in found]


def guess_cost(value: str, ranks: dict[str, int] = _ranks) -> tuple[float, list[tuple[int, int, str]]]:
    """Smallest log10 of guesses over all cuts, and that cut; a cut into k pieces costs log10(k) more than its pieces.

    ``best[j]`` holds the cheapest cut of the first ``j`` characters, for the
    sum of the pieces' costs; neighbouring brute-force characters form one span.
    """
    n, each = len(value), math.log10(alphabet(value))
    best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(math.inf, 0, "")] * n
    for i, found in enumerate(pieces_from(value, ranks)):
        so_far = best[i][0]
        best[i + 1] = min(best[i + 1], (so_far + each, i, "brute"))
        for j, cost, kind in found:
            best[j] = min(best[j], (so_far + cost + 0.3, i, kind))
    cut, j = [], n
    while j:
        _, i, kind = best[j]
        if kind == "brute" and cut and cut[-1][2] == "brute":
            cut[-1] = (i, cut[-1][1], kind)
        else:
            cut.append((i, j, kind))
        j = i
    return best[n][0] + math.log10(max(1, len(cut))), cut[::-1]


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind, end); a match that is too short still uses up its text."""
    spans = []
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str, low: str, base: list[tuple[int, int, int]], min_log10: float,
                ranks: dict[str, int] = _ranks) -> list[tuple[int, int, int]]:
    """Spans of whole values that no single one of the sorted ``base`` spans contains."""
    if not any(hint in low for hint in HINTS):
        return []
    starts, ends = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    found = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        before = bisect_right(starts, start)
        if not (before and ends[before - 1] >= end) and guess_cost(text[start:end], ranks)[0] >= min_log10:
            found.append((start, 3, end))
    return found


def prose_ranks(docs: DataFrame, most: int = 20_000, least_docs: int = 10) -> dict[str, int]:
    """Ranks of the words of the texts by the number of texts they stand in, outside of credential contexts, with those of ``COMMON``.

    At most ``most`` words reach the driver. Words of fewer than ``least_docs`` texts are not
    prose: they may be somebody's password.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter[str] = Counter()
        for text in T.texts_of(batch):
            low = text.lower()
            seen.update(set(PROSE.findall(CONTEXT.sub(" ", low) if any(hint in low for hint in HINTS) else low)))
        return T.named_batch(word=pa.array(seen.keys(), pa.string()), n=pa.array(seen.values(), pa.int64()))

    counted = T.scan(T.id_and_text(docs), step, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    first = settle(counted.where(F.col("n") >= least_docs).orderBy(F.desc("n"), "word").limit(most))  # collected at once, each slice would send its own
    rows = first.orderBy(F.desc("n"), "word").collect()
    ranks = {r["word"]: rank for rank, r in enumerate(rows, 1)}
    return ranks | {w: min(rank, ranks.get(w, rank)) for w, rank in _ranks.items()}


def spans_of(text: str, min_log10: float = 10.0, ranks: dict[str, int] = _ranks) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans, both by start, then kind."""
    low = text.lower()
    base = sorted(base_spans(text, low))
    return base, sorted(base + guess_spans(text, low, base, min_log10, ranks))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, min_log10: float = 10.0) -> DataFrame:
    """doc_id, base_spans and spans as written lists."""
    ranks = docs.sparkSession.sparkContext.broadcast(prose_ranks(docs))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [spans_of(t, min_log10, ranks.value) for t in T.texts_of(batch)]
        counts = np.array([[sum(k == kind for _, k, _ in base) for kind in range(3)] for base, _ in both], np.int64)
        base = [written(b) for b, _ in both]
        return T.named_batch(doc_id=batch.column("doc_id"), n_assign=counts[:, 0], n_access=counts[:, 1], n_hex=counts[:, 2],
                             base_sha256=pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                             spans=pa.array([written(s) for _, s in both]))

    return T.scan(T.id_and_text(docs), step,
                  "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, marker: str = "[secret]", min_log10: float = 10.0) -> DataFrame:
    """The documents with every span (overlaps joined) replaced; all columns stay, ``n_chars`` follows the text."""
    schema, names = docs.schema, docs.columns
    ranks = docs.sparkSession.sparkContext.broadcast(prose_ranks(docs))

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, _, end in spans_of(text, min_log10, ranks.value)[1]:
            if start >= at:
                out += [text[at:start], marker]
            at = max(at, end)
        return "".join([*out, text[at:]]) if out else text

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [clean(t) for t in batch.column("text").to_pylist()]
        columns = list(batch.columns)
        columns[names.index("text")] = pa.array(kept, pa.string())
        if "n_chars" in names:
            columns[names.index("n_chars")] = pa.array([None if t is None else len(t) for t in kept]).cast(batch.column("n_chars").type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return T.scan(docs, step, schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(T.documents(spark, sf_dir))
