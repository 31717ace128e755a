"""Secrets: known forms by pattern, unknown ones by sliding-window entropy per character class."""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.llm.common import text_batches
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

#: The known forms, in the order in which they are listed at one start.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class Alphabet:
    """A character class with the entropy, in bits a character, of a suspicious window."""

    kind: str
    characters: str
    window: int
    bits: float

    def runs(self) -> re.Pattern:
        return re.compile(f"[{self.characters}]{{{self.window},}}")


ALPHABETS = (
    Alphabet("entropy_hex", "0-9A-Fa-f", 24, 3.1),
    Alphabet("entropy_base64", "A-Za-z0-9+/_=-", 24, 3.9),
)
KINDS = BASE_KINDS + tuple(a.kind for a in ALPHABETS)

LOWER = "abcdefghijklmnopqrstuvwxyz"

#: What looks random but is not secret.
ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"[A-Za-z]+",  # a word
        r"[0-9_=+/-]+",  # a number, or a ruler
        r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # an identifier
        r"[A-Za-z]+(?:[-_/][A-Za-z]+)+",  # words joined
        r"(?:/?[A-Za-z_-]+[0-9]{0,4}/)+[A-Za-z0-9_-]{0,16}",  # a path
        rf"(?:0123456789|abcdef(?:{LOWER[6:]})?|ABCDEF(?:{LOWER[6:].upper()})?)+(?:[+/_-]{{2}})?=?",  # alphabets
    )
)
SEPARATOR = re.compile(r"[/_=+-]")
PLAIN = re.compile(r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+)?[0-9]{0,4}|[0-9]{5,8}")


def harmless(run: str, window: int) -> bool:
    """Whether an allowed form explains the whole run, or plain words and numbers all but half a window.

    A path, link or name is judged part by part: words in one of the usual ways to write them with
    up to four digits after them, years, dates and numbers are plain. A random key has few such parts.
    """
    if any(p.fullmatch(run) for p in ALLOWED):
        return True
    return 2 * sum(len(part) for part in SEPARATOR.split(run) if not PLAIN.fullmatch(part)) < window


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end and kind of the known forms, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return found


def hot_windows(run: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """The stretches of ``run`` covered by windows of at least ``bits`` entropy.

    H = log2(w) - sum(c log2 c) / w; a step changes two counts, so it costs the
    same for any window.
    """
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    most = window * (math.log2(window) - bits) + 1e-9
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= most:
            if begin >= 0 and i - window + 1 <= end:
                end = i + 1
            else:
                if begin >= 0:
                    yield begin, end
                begin, end = i - window + 1, i + 1
    if begin >= 0:
        yield begin, end


def entropy_spans(
    text: str, base: Iterable[tuple[int, int, str]], alphabets: tuple[Alphabet, ...] = ALPHABETS
) -> list[tuple[int, int, str]]:
    """Random-looking stretches that no earlier span covers and no allowed form explains."""
    taken: dict[str, list[tuple[int, int]]] = {}
    for s, e, kind in sorted(base):
        taken.setdefault(kind, []).append((s, e))
    found = []
    for a in alphabets:
        fresh = []
        for run in _runs(a).finditer(text):
            word = run[0]
            if not (any(c.isdigit() for c in word) and any(c.isalpha() for c in word)):
                continue
            if harmless(word, a.window):
                continue
            for s, e in hot_windows(word, a.window, a.bits):
                s, e = s + run.start(), e + run.start()
                if not any(_covered(spans, s, e) for spans in taken.values()):
                    fresh.append((s, e, a.kind))
        found += fresh
        taken[a.kind] = [(s, e) for s, e, _ in fresh]
    return found


_RUNS: dict[Alphabet, re.Pattern] = {}


def _runs(a: Alphabet) -> re.Pattern:
    if a not in _RUNS:
        _RUNS[a] = a.runs()
    return _RUNS[a]


def _covered(taken: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether one of the ordered, separate spans overlaps most of the stretch, and so holds its middle."""
    at = bisect.bisect_right(taken, ((s + e) // 2, math.inf)) - 1
    return at >= 0 and 2 * (min(e, taken[at][1]) - max(s, taken[at][0])) > e - s


def find(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind as listed."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + entropy_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("kind", T.StringType()),
        ]
    )
)


def scan(docs: DataFrame, spans: str = "secrets") -> DataFrame:
    """``docs`` with the array column ``spans``: start, end (exclusive, in code points), kind.

    The column ``text`` is scanned whole, however long; null and empty texts have no
    spans. A column named like ``spans`` is replaced; all others and all rows stay,
    repeated ones with equal spans. An empty table gives an empty one.
    """
    docs = docs.drop(spans)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = [
                [{"start": s, "end": e, "kind": k} for s, e, k in find(t.as_py())]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, spans]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(spans, SPANS)])
    return docs.mapInArrow(run, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark``, and ``n_chars``, if there, counted anew.

    Overlapping spans become one mark. Null, empty and other texts without secrets stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            texts = batch.column("text").to_pylist()
            changed = {}
            for i, text in enumerate(texts):
                if spans := find(text):
                    out, at = [], 0
                    for s, e, _ in spans:
                        if s >= at:
                            out += [text[at:s], mark]
                        at = max(at, e)
                    changed[i] = "".join([*out, text[at:]])
            if not changed:
                yield batch
                continue
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(
                [changed.get(i, t) for i, t in enumerate(texts)], batch.schema.field("text").type
            )
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [len(changed[i]) if i in changed else n for i, n in enumerate(columns["n_chars"].to_pylist())],
                    batch.schema.field("n_chars").type,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, docs.schema)


def listed(spans, kinds: tuple[str, ...] | None = None):
    """``kind:start:end`` of the spans, comma-joined, as a column."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
