"""Personal data: proposed spans, judged by boosted trees.

Four base kinds (email, ip, card, phone) have fixed formats and checks; what
passes is always redacted. High-recall generators propose further, partly
overlapping spans: what fails a base check, numbers written without a plus, spelled-out addresses,
values assigned to a name that speaks of a secret, private keys and random
strings, all of any length.
Boosted trees score each proposal from features of its format and of the text
around it. They are fitted on all labelled proposals of the corpus, but for every
third in the order of a hash, which is held out. There each kind's scores are
calibrated (isotonic regression), and its threshold is the lowest score, in steps
of ``1 / SCORES``, that is ``PRECISION`` precise together with all above it and
whose own calibrated probability is at least ``CALIBRATED``. Proposals at or above
their kind's threshold are redacted, the likelier one where two overlap.

Spark counts each feature's values (rounded to ``DIGITS`` binary digits, so they
are few) and the trees' cuts are quantiles of these counts; proposals of equal
bins become one row with counts. Each level of each tree is one pass over these
rows, and a last one counts the held-out labels by kind and score.

Base matches are labelled by their checks. Other proposals are labelled by
evidence beside the format: the name a value is assigned to, words before the
span, an issuer's prefix, or a confirmed base span around it. Without evidence a
number, or an address with a plain "at" and dot, is background (label 0); other
proposals have no label then and only the trees judge them. Each labelled
proposal, but for those that are background without the words around, is shown a
second time with the features of the text around held back, so the trees also
learn (and the thresholds measure) what the format says alone.

All work on a text is linear in its length, but for a logarithm of its spans.

Positions are code points, ends exclusive.

Defined cases: null and empty texts have no spans; with no proposals, or only
one label among them, just the base spans are redacted; rows that repeat an id
get a row each; other columns are ignored or passed on.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _bytes as B
from . import _shared as S
from . import _trees

# Kinds in the order of results, and the base formats.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

PRECISION = 0.98
CALIBRATED = 0.9
DIGITS = 12  # binary digits of the values that cuts are chosen from
SCORES = 1 << 14  # steps of the scores that thresholds are chosen from
SLICES = 12  # bits of a hash, whose slices are ranked one by one

_LOCAL_SET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_AT = re.compile(r"[(\[]\s?at\s?[)\]]|(?<=\s)at(?=\s)", re.I)
_SPELLED_DOMAIN = re.compile(r"\s*+[A-Za-z0-9-]+(?:(?:\s*+(?:[(\[]\s?dot\s?[)\]]|(?<=\s)dot(?=\s))\s*+|\.)[A-Za-z0-9-]+)+", re.I)
_NATIONAL = re.compile(r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9]++(?:[\x20./()-]{1,2}[0-9]++)*+")
_NAME_SET = _LOCAL_SET - frozenset("%+")
_SECRET_NAME = re.compile(r"(?:api|access|private|auth|account)[_.-]?key|secret|token|passw(?:or)?d|passphrase|pwd|"
                          r"credential", re.I)
_VALUE = re.compile(r"[^\s\"'`,;&]++")
_PLACEHOLDER = re.compile(r"(?:none|null|nil|true|false|undefined|required|changeme|[xX*.]+|your.*|<.*|[$%{].*|"
                          r".*\(.*|env[.\[].*|.*\.(?:env|environ)\b.*)", re.I)
_PROSE = re.compile(r"[\x20,.;]+[a-z]")
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?-----")
_PEM_END = re.compile(r"-----END (?:[A-Z0-9]++ )*?PRIVATE KEY(?: BLOCK)?-----")
LEAST_VALUE = 6  # characters of an assigned value
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+")
_CONTEXT = (("token", "key", "secret", "passw", "pwd", "credential"), ("card", "visa", "credit"),
            ("tel", "phone", "call", "fax"), ("mail", "contact"), ("ip", "host", "addr"),
            ("version", "v.", "no.", "number", "isbn", "id"))

# Evidence for labels, none of it a feature as such: words shortly before a
# span, prefixes that issuers give their keys.
_PHONE_WORD = re.compile(r"\b(?:tele?(?:phone|fon)?|phone|mobile|cell|call|fax|dial)\b", re.I)
_NUMBER_WORD = re.compile(r"\b(?:version|isbn|issn|id|no|number|order|invoice|serial|ref|part|sku|ticket|account)\b", re.I)
_MAIL_WORD = re.compile(r"\b(?:e-?mail|mail(?:to)?|contact|write|reach|address)\b", re.I)
_SECRET_WORD = re.compile(r"(?:\b|_)(?:key|secret|token|passw(?:or)?d|pwd|credentials?|bearer|authorization)\b", re.I)
_DIGEST_WORD = re.compile(r"\b(?:sha-?[0-9]*|md5|digest|checksum|hash|commit|revision|etag|uuid|https?|file|path)\b", re.I)
_ISSUED = re.compile(r"(?:AKIA|ASIA|AIza|eyJ|gh[pousr]_|glpat-|xox[abprs]-|sk[_-](?:live|test)?)[A-Za-z0-9_-]")
UNLABELLED, BY_WORDS = -1, 2  # BY_WORDS: right, and background without the words around
_AROUND = 24  # characters before a span that are looked at


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(part: str) -> bool:
    part = part.lstrip("0")  # of any length; the rest is short
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ so that long
    texts without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, passes) of every match of a base format."""
    for s, e in _emails(text):
        yield 0, s, e, True
    for m in _IP.finditer(text):
        yield 1, *m.span(), all(_octet(p) for p in m[0].split("."))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        yield 2, *m.span(), 12 <= len(d) <= 19 and _luhn(d)
    for m in _PHONE.finditer(text):
        yield 3, *m.span(), 9 <= len(_digits(m[0])) <= 15


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and words around it."""
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    before = text[max(0, start - _AROUND):start].lower()
    near = [float(any(w in before for w in words)) for words in _CONTEXT]
    octets = [int(g) if len(g) < 4 else 999 for g in groups]
    n = max(1, len(span))
    return [*(float(kind == k) for k in range(len(KINDS))),
            float(len(span)), float(len(digits)), float(len(groups)),
            float(max(map(len, groups), default=0)), float(_luhn(digits)) if digits else 0.0,
            float(len(octets) == 4 and max(octets) <= 255), float(span[:1] == "+"),
            float("@" in span), float(span.count(".")), float("(" in span and ")" in span),
            sum(c.isalpha() for c in span) / n, sum(c.isupper() for c in span) / n,
            sum(c in "0123456789abcdefABCDEF" for c in span) / n, _entropy(span),
            float(text[start - 1:start].isalnum()), float(text[end:end + 1].isalnum()),
            float(text[start - 1:start] in ('"', "'", "`")),
            float(before.rstrip("\x20\t\"'`")[-1:] in ("=", ":", ">")),
            *near]


# Features of the text around a span, which come last: quote, assignment, words.
_CONTEXT_FEATURES = 2 + len(_CONTEXT)


def _evidence(before: str, right: re.Pattern, wrong: re.Pattern | None = None) -> int:
    """1, 0 or unlabelled, by the words before a span."""
    return 1 if right.search(before) else 0 if wrong and wrong.search(before) else UNLABELLED


def _keylike(span: str) -> bool:
    """A piece of at least 16 letters and digits that mixes both."""
    return any(len(p) >= 16 and not p.isdigit() and not p.isalpha() for p in re.split(r"[/_-]", span))


def _spelled(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether it is marked as an address) of addresses with the
    at sign, and perhaps dots, spelled out."""
    done = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > done and text[start - 1].isspace():
            start -= 1
        end = start
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start == end or not (domain := _SPELLED_DOMAIN.match(text, m.end())):
            continue
        done = domain.end()
        yield start, done, "dot" in domain[0].lower() or m[0][0] in "(["


def _assigned(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, label) of values assigned (= or :, any gap) to a name that
    speaks of a secret. The name is the evidence; placeholders aren't secrets,
    and a plain word that prose goes on from may be anything."""
    done, line_end, unclosed = 0, -1, {}
    for m in re.finditer("[=:][=:>]*+", text):
        if m.start() < done:
            continue
        at = m.start()
        while at > done and text[at - 1] in "\x20\t\"'`]":
            at -= 1
        name = at
        while name > done and text[name - 1] in _NAME_SET:
            name -= 1
        if not _SECRET_NAME.search(text, name, at):
            continue
        start = m.end()
        while text[start:start + 1] in ("\x20", "\t"):
            start += 1
        if start > line_end:
            line_end = text.find("\n", start)
            line_end = len(text) if line_end < 0 else line_end
            unclosed = {}
        quote, end = text[start:start + 1], -1
        if quote in ("'", '"', "`"):
            start += 1
            if quote not in unclosed:
                end = text.find(quote, start, line_end)
                if end < 0:
                    unclosed[quote] = True
        plain = end < 0
        if plain:
            value = _VALUE.match(text, start)
            if not value:
                continue
            end = value.end()
        if end - start < LEAST_VALUE:
            continue
        value, done = text[start:end], end
        if _PLACEHOLDER.fullmatch(value):
            yield start, end, 0
        elif plain and value.isalpha() and value.islower() and _PROSE.match(text, end):
            yield start, end, UNLABELLED
        else:
            yield start, end, 1


def _private_keys(text: str) -> Iterator[tuple[int, int]]:
    done, closed = 0, True
    for m in _PEM.finditer(text):
        if m.start() < done:
            continue
        end = _PEM_END.search(text, m.end()) if closed else None
        closed = end is not None
        done = end.end() if end else m.end()
        yield m.start(), done


def _overlapping(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


class _Taken:
    """Disjoint spans, searched by halving."""

    def __init__(self, spans: list[tuple[int, int]]):
        joined = _overlapping(spans)
        self.starts, self.ends = [s for s, _ in joined], [e for _, e in joined]

    def free(self, start: int, end: int) -> bool:
        i = bisect.bisect_right(self.ends, start)  # the first that ends after the start
        return i == len(self.starts) or self.starts[i] >= end

    def take(self, start: int, end: int):
        i = bisect.bisect_right(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def proposals(text: str, found: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, rule) of proposed spans; ``rule`` is the label that
    checks or evidence give it, or ``UNLABELLED``."""
    out = {(k, s, e): int(ok) for k, s, e, ok in found if k != 2 or e - s >= 8}
    base = _Taken([(s, e) for _, s, e, ok in found if ok])
    phones = [(s, e) for k, s, e, ok in found if k == 3 and ok]

    def before(start: int) -> str:
        return text[max(0, start - _AROUND):start]

    def by_words(words: re.Pattern, start: int) -> int:
        return BY_WORDS if words.search(before(start)) else 0

    for s, e, marked in _spelled(text):
        # a plain "at" before a plain domain is prose unless mail is spoken of
        out.setdefault((0, s, e), 1 if marked and "dot" in text[s:e].lower()
                       else _evidence(before(s), _MAIL_WORD) if marked else by_words(_MAIL_WORD, s))
    i = 0
    for m in _NATIONAL.finditer(text):
        while i < len(phones) and phones[i][1] < m.end():
            i += 1
        inside = i < len(phones) and phones[i][0] <= m.start()
        out.setdefault((3, *m.span()), 1 if inside or ("(" in m[0] and ")" in m[0])
                       else _evidence(before(m.start()), _PHONE_WORD, _NUMBER_WORD))
    for m in _NUMBER.finditer(text):
        if 7 <= sum("0" <= c <= "9" for c in m[0]) <= 15 and base.free(*m.span()):
            out.setdefault((3, *m.span()), by_words(_PHONE_WORD, m.start()))
    for s, e, label in _assigned(text):
        out.setdefault((4, s, e), label)
    for s, e in _private_keys(text):
        out.setdefault((4, s, e), 1)
    for m in _RANDOM.finditer(text):
        label = (0 if not _keylike(m[0]) else 1 if _ISSUED.match(m[0])
                 else _evidence(before(m.start()), _SECRET_WORD, _DIGEST_WORD))
        out.setdefault((4, *m.span()), label)
    return [(*k, v) for k, v in sorted(out.items())]


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_PROPOSAL = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                       ("rule", pa.int32()), ("x", pa.list_(pa.float64()))])
_SPOTTED = ("doc_id long, base array<struct<kind:int,start:long,end:long>>, "
            "proposals array<struct<kind:int,start:long,end:long,rule:int,x:array<double>>>")
_WORDED = re.compile(rb"-----BEGIN|[\s\x80-\xff]at[\s\x80-\xff]", re.I)
_ANY = np.zeros(256, bool)
_ANY[list(b"0123456789@=:([")] = True


def _texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts that can hold a span: every format needs a
    digit, an @, a name assigned to (= or :), an at spelled out in brackets or
    alone, or the head of a private key."""
    for a, b, data, offsets in B.blocks(column):
        sums = np.append(0, np.cumsum(_ANY[data]))
        some = sums[offsets[1:]] > sums[offsets[:-1]]
        for i, known in enumerate(some.tolist()):
            raw = data[offsets[i]:offsets[i + 1]].tobytes()
            if known or _WORDED.search(raw):
                yield a + i, raw.decode("utf-8")


def _look(text: str) -> tuple[list[dict], list[dict]]:
    found = list(matches(text))
    base = sorted((s, k, e) for k, s, e, ok in found if ok)
    return ([{"kind": k, "start": s, "end": e} for s, k, e in base],
            [{"kind": k, "start": s, "end": e, "rule": r, "x": features(text, k, s, e)}
             for k, s, e, r in proposals(text, found)])


def spot(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and proposals of every text: one pass over the documents."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base: list = [[] for _ in range(batch.num_rows)]
            proposed: list = [[] for _ in range(batch.num_rows)]
            for i, text in _texts(batch.column(1)):
                base[i], proposed[i] = _look(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(proposed, pa.list_(_PROPOSAL))],
                names=["doc_id", "base", "proposals"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _SPOTTED)


@dataclass(frozen=True)
class Judge:
    """Boosted trees and a threshold per kind; without trees nothing is added."""

    trees: _trees.BoostedTrees | None
    thresholds: np.ndarray

    def select(self, base: list[dict], proposed: list[dict]) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the spans to redact: base ones and accepted proposals."""
        taken = [(b["start"], b["kind"], b["end"]) for b in base]
        if self.trees is None or len(proposed) == 0:
            return sorted(taken)
        p = self.trees.probability(np.array([c["x"] for c in proposed]))
        kinds = np.array([c["kind"] for c in proposed])
        good = np.flatnonzero(p >= self.thresholds[kinds])
        spans = _Taken([(s, e) for s, _, e in taken])
        for i in sorted(good.tolist(), key=lambda i: (-p[i], i)):
            c = proposed[i]
            if spans.free(c["start"], c["end"]):
                spans.take(c["start"], c["end"])
                taken.append((c["start"], c["kind"], c["end"]))
        return sorted(taken)


def _calibrated(right: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Probability of each of the falling scores, met by ``rows`` proposals,
    ``right`` of them right: the closest one to the labels that falls with the
    score."""
    blocks: list[list[float]] = []  # [sum, rows, scores], means falling
    for total, n in zip(right.tolist(), rows.tolist()):
        blocks.append([total, n, 1])
        while len(blocks) > 1 and blocks[-1][0] * blocks[-2][1] >= blocks[-2][0] * blocks[-1][1]:
            for i, part in enumerate(blocks.pop()):
                blocks[-1][i] += part
    return np.repeat([total / n for total, n, _ in blocks], [scores for *_, scores in blocks])


def _shown(x: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of labelled proposals and, after them, of those shown a second
    time without the text around; the row of each."""
    alone = x.copy()
    alone[:, -_CONTEXT_FEATURES:] = 0
    more = np.flatnonzero((x != alone).any(axis=1) & (rules != BY_WORDS))
    return np.concatenate([x, alone[more]]), np.append(np.arange(len(x)), more)


def _labelled(spotted: DataFrame) -> DataFrame:
    """(kind, rule, x, n, held): different labelled proposals, how many there
    are, and how many of these are held out: every third in the order of a hash.
    Ranks are counted within slices of the hash, after the counts of those before."""
    rows = (spotted.select("doc_id", F.explode(F.filter("proposals", lambda p: p["rule"] != UNLABELLED)).alias("p"))
            .select(F.xxhash64("doc_id", "p.start", "p.kind").alias("h"), "p.kind", "p.rule", "p.x")
            .withColumn("slice", F.shiftright("h", 64 - SLICES)))
    rows = rows.groupBy("slice", "h", "kind", "rule", "x").agg(F.count("*").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    firsts = (rows.groupBy("slice").agg(F.sum("n").alias("all")).withColumn(
        "first", F.coalesce(F.sum("all").over(before.orderBy("slice")), F.lit(0))).select("slice", "first"))
    place = F.coalesce(F.sum("n").over(before.partitionBy("slice").orderBy("h", "kind", "rule", "x")), F.lit(0))
    rows = rows.withColumn("place", place).join(F.broadcast(firsts), "slice")
    start = F.col("place") + F.col("first")
    held = F.expr("(start + n + 2) div 3 - (start + 2) div 3")
    return rows.withColumn("start", start).select("kind", "rule", "x", "n", held.alias("held"))


def _batches(batches) -> Iterator[tuple[np.ndarray, ...]]:
    """(kind, label, x, n, held) of the proposals as they are shown, by batch of ``_labelled``."""
    for batch in batches:
        if batch.num_rows:
            kinds, rules, n, held = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            x, row = _shown(batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1), rules)
            yield kinds[row], np.minimum(rules, 1)[row], x, n[row], held[row]


def _values(batches) -> Iterator[pa.RecordBatch]:
    """(feature, value, n) of proposals that aren't held out, values rounded to
    ``DIGITS`` binary digits; the label counts as feature -1."""
    for _, y, x, n, held in _batches(batches):
        part, power = np.frexp(x)
        columns = [y.astype(float), *np.ldexp(np.rint(np.ldexp(part, DIGITS)), power - DIGITS).T]
        for i, column in enumerate(columns):
            values, at = np.unique(column, return_inverse=True)
            total = np.bincount(at, n - held).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(total), i - 1, np.int32)), pa.array(values), pa.array(total)],
                names=["feature", "value", "n"])


def fit(spotted: DataFrame, precision: float = PRECISION) -> Judge:
    """Fit on all labelled proposals; sums over them, none of them, come to the driver."""
    labelled = S.materialised(_labelled(spotted), "pii-labelled")
    counts = (labelled.mapInArrow(_values, "feature int, value double, n long").where("n > 0")
              .groupBy("feature", "value").agg(F.sum("n").alias("n")).orderBy("feature", "value").toArrow())
    feature, value, n = (counts[name].to_numpy() for name in ("feature", "value", "n"))
    by_label = n[feature == -1]
    if len(by_label) < 2:
        S.forget(labelled)
        return Judge(None, np.ones(len(KINDS)))
    cuts = [_trees.quantile_cuts(value[feature == i], n[feature == i]) for i in range(feature[-1] + 1)]

    def bins(batches) -> Iterator[pa.RecordBatch]:
        for kinds, y, x, n, held in _batches(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), _trees.bin_column(x, cuts), *(pa.array(c.astype(np.int64)) for c in (
                    n - held, (n - held) * y, held, held * y))],
                names=["kind", "bins", "n", "ones", "held", "held_ones"])

    counted = S.materialised(
        labelled.mapInArrow(bins, "kind int, bins binary, n long, ones long, held long, held_ones long")
        .groupBy("kind", "bins").agg(*(F.sum(c).alias(c) for c in ("n", "ones", "held", "held_ones"))), "pii-counted")
    S.forget(labelled)
    trees = _trees.fit_counted(counted.where("n > 0"), int(by_label.sum()), int(by_label[1]), cuts)

    def scores(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = trees.probability(_trees.unpacked(batch.column(1), len(cuts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array((p * SCORES).astype(np.int32)), *batch.columns[2:]],
                names=["kind", "score", "n", "ones"])

    judged_by = (counted.where("held > 0").select("kind", "bins", "held", "held_ones")
                 .mapInArrow(scores, "kind int, score int, n long, ones long").groupBy("kind", "score")
                 .agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).orderBy("kind", F.desc("score")).toArrow())
    S.forget(counted)
    kind, score, n, ones = (judged_by[name].to_numpy() for name in ("kind", "score", "n", "ones"))
    thresholds = np.full(len(KINDS), 2.0)  # a kind never seen right is never added
    for k in range(len(KINDS)):
        right, rows = ones[kind == k], n[kind == k]
        level = np.cumsum(right) / np.cumsum(rows)
        fine = np.flatnonzero((level >= precision) & (_calibrated(right, rows) >= CALIBRATED))
        if len(fine):
            thresholds[k] = max(0.5, score[kind == k][fine[-1]] / SCORES)
    return Judge(trees.on_values(cuts), thresholds)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def judged(spotted: DataFrame, judge: Judge) -> DataFrame:
    """Per document: counts and checksum of the base spans, and all spans."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, proposed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = [(b["start"], b["kind"], b["end"]) for b in base]
                n = Counter(k for _, k, _ in own)
                rows.append((*(n[k] for k in range(BASE_KINDS)),
                             hashlib.sha256(_written(own).encode()).hexdigest(),
                             _written(judge.select(base, proposed))))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return spotted.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                   "base_sha256 string, spans string")


def _redacted(text: str, judge: Judge) -> str:
    out, at = [], 0
    for s, k, e in judge.select(*_look(text)):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """``df`` with every selected span replaced by its kind in brackets."""
    at = df.columns.index(text_col)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            changed = {i: new for i, text in _texts(columns[at]) if (new := _redacted(text, judge)) != text}
            if changed:
                texts = columns[at].to_pylist()
                for i, new in changed.items():
                    texts[i] = new
                columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)
