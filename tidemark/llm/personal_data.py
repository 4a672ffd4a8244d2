"""Personal data: e-mail and IP addresses, card and phone numbers, by fixed patterns and by a tagger that learnt from them.

The patterns give the base spans. A bidirectional LSTM with CRF transitions (``bilstm_crf``) reads kinds of characters in overlapping windows. It is
trained on windows tagged by base spans, whole and rewritten in other usual notations, and adds what the patterns miss: a phone number
without its plus, an address with blanks, card numbers side by side. Pieces that the windows find of a text are joined, rated and settled over the
whole text; base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bilstm_crf import Tagger
from tidemark.llm.blocks import texts_of

#: Fixed order of the kinds.
KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
#: Most windows to learn from: of each kind, and as many without personal data.
PER_KIND = 200
#: Windows that are decoded at once.
DECODED = 1024
#: Texts with more spans or failed matches than this are not learnt from.
MANY = 200
#: Rewritten copies of each window with a span.
COPIES = 3

# The patterns of the base spans. What repeats is possessive, so that no text takes quadratic time.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _plausible_ip(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.split("."))


def _plausible_card(found: str) -> bool:
    digits = "".join(_DIGIT.findall(found))
    return 13 <= len(digits) <= 19 and luhn(digits)


def _plausible_phone(found: str) -> bool:
    return 9 <= len(_DIGIT.findall(found)) <= 15


_NUMBERS = ((1, _IP, _plausible_ip), (2, _CARD, _plausible_card), (3, _PHONE, _plausible_phone))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[Span]]:
    """``(kind, start, end)`` of the patterns' matches, leftmost first within a kind, and matches that fail their test and belong to no other."""
    spans, failed = [(0, *s) for s in _emails(text)], []
    for kind, pattern, plausible in _NUMBERS:
        for m in pattern.finditer(text):
            if plausible(m.group()):
                spans.append((kind, *m.span()))
            elif m.end() - m.start() > 6:
                failed.append(m.span())
    return spans, [f for f in failed if len(spans) > MANY or not any(f[0] < e and f[1] > s for _, s, e in spans)]


# Kinds of characters: what addresses and numbers are made of is told apart, letters only by case.
_SIGNS = "@.-+()_%/:,;#'\"&*=<>[]|"
SYMBOLS = len(_SIGNS) + 9
PAD, SPACE, LINE, DIGIT, LOWER, UPPER, FOREIGN, OTHER, APART = range(len(_SIGNS), SYMBOLS)
_ASCII = np.full(129, OTHER, np.uint8)
_ASCII[128] = FOREIGN
for _k, _c in enumerate(_SIGNS):
    _ASCII[ord(_c)] = _k
for _s, _kind in ((" \t", SPACE), ("\r\n\x0b\x0c", LINE), ("0123456789", DIGIT), ("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER)):
    _ASCII[[ord(_c) for _c in _s]] = _kind
_AT, _DOT, _DASH, _PLUS, _OPEN, _CLOSE = (_SIGNS.index(c) for c in "@.-+()")


def symbols(text: str) -> np.ndarray:
    return _ASCII[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]


# Tags: 0 outside, 1 + 2 k the first character of kind k, 2 + 2 k a further one.
TAGS = 1 + 2 * len(KINDS)
BARRED = np.array([[b > 0 and b % 2 == 0 and a not in (b - 1, b) for b in range(TAGS)] for a in range(TAGS)])


def windows(own: np.ndarray) -> np.ndarray:
    """The starts of the windows that may hold personal data: those with an ``@`` or four digits, which every kind has."""
    marks = np.concatenate(([0], np.cumsum((own == _AT) * 4 + (own == DIGIT))))
    starts = np.arange(0, max(len(own) - STRIDE, 1), STRIDE)
    return starts[marks[np.minimum(starts + WINDOW, len(own))] - marks[starts] >= 4]


def _filled(own: np.ndarray, start: int) -> np.ndarray:
    part = own[start : start + WINDOW]
    return part if len(part) == WINDOW else np.concatenate((part, np.full(WINDOW - len(part), PAD, np.uint8)))


def _tagged(own: np.ndarray, spans: list[tuple[int, int, int]], start: int) -> tuple[np.ndarray, np.ndarray]:
    tags = np.zeros(WINDOW, np.uint8)
    for kind, s, e in spans:
        if s < start + WINDOW and e > start:
            tags[max(s - start, 0) : e - start] = 2 + 2 * kind
            if s >= start:
                tags[s - start] = 1 + 2 * kind
    return _filled(own, start), tags


def _examples(text: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """At most one window for each kind of data in a text, and one without any; windows that touch a failed match tell nothing."""
    spans, failed = base_spans(text)
    if not spans and not failed and "@" not in text and not _DIGIT.search(text):
        return
    if len(spans) > MANY or len(failed) > MANY:
        return
    spans = [s for s in spans if not any(s[1] < o[2] and o[1] < s[2] and o < s for o in spans)]
    own, seen = symbols(text), set()
    for kind, s, e in spans:
        if kind not in seen:
            seen.add(kind)
            start = max(0, s - xxhash.xxh3_64_intdigest(f"{s} {e}") % (WINDOW - 16))
            if not any(u < start + WINDOW and v > start for u, v in failed):
                yield kind, *_tagged(own, spans, start)
    for start in windows(own)[:MANY].tolist():
        if not any(u < start + WINDOW and v > start for u, v in [s[1:] for s in spans] + failed):
            yield len(KINDS), _filled(own, start), np.zeros(WINDOW, np.uint8)
            return


def _rewritten(x: np.ndarray, tags: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The same window with its spans in other notations: numbers grouped otherwise or side by side, a plus or brackets left out, blanks around ``@``."""
    new_x, new_tags, t = [], [], 0
    while t < WINDOW:
        tag = int(tags[t])
        if tag == 0:
            new_x.append(int(x[t]))
            new_tags.append(0)
            t += 1
            continue
        kind, end = (tag - 1) // 2, t + 1
        while end < WINDOW and tags[end] == 2 + 2 * kind:
            end += 1
        span = [int(s) for s in x[t:end]]
        if kind == 0 and random.random() < 0.3:
            span = [c for s in span for c in ((SPACE, s, SPACE) if s == _AT else (s,))]
        if kind in (2, 3):
            gap = int(random.choice([SPACE, _DASH, _DOT]))
            span = [gap if s in (SPACE, _DASH) else s for s in span]
        if kind == 2 and random.random() < 0.5:
            digits = [s for s in span if s == DIGIT]
            grouped = random.random() < 0.5
            span = [c for k, s in enumerate(digits) for c in ((gap, s) if grouped and k and k % 4 == 0 else (s,))]
        if kind == 3:
            if random.random() < 0.5:
                span = span[1:] if span[0] == _PLUS else span
            if random.random() < 0.4:
                span = [s for s in span if s not in (_OPEN, _CLOSE)]
        if not span:
            span = [DIGIT]
        own = [(tag if k == 0 else 2 + 2 * kind) for k in range(len(span))]
        new_x += span
        new_tags += own
        if kind in (2, 3) and own[0] % 2 == 1 and random.random() < 0.3:  # the same again beside it
            new_x += [SPACE, *span]
            new_tags += [0, *own]
        t = end
    x, tags = np.full(WINDOW, PAD, np.uint8), np.zeros(WINDOW, np.uint8)
    x[: len(new_x)], tags[: len(new_tags)] = new_x[:WINDOW], new_tags[:WINDOW]
    return x, tags


def fit(docs: DataFrame, per_kind: int = PER_KIND) -> Tagger | None:
    """A tagger trained on the base spans of at most ``per_kind`` windows of each kind and as many without any, those with the smallest hashes of their
    texts; none if there is nothing to learn from. The only thing that a bound holds for: spans are looked for in every text."""

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(xxhash.xxh3_64_intdigest(t) >> 1, k, x.tobytes(), g.tobytes()) for t in texts_of(pa.Table.from_batches([batch])) for k, x, g in _examples(t.decode())]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["place", "kind", "x", "tags"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(examples, "place bigint, kind int, x binary, tags binary")
    order = F.row_number().over(Window.partitionBy("kind").orderBy("place", "x", "tags"))
    rows = sorted(tuple(r)[:4] for r in found.withColumn("rank", order).filter(F.col("rank") <= per_kind).collect())
    rows = sorted({(p, k, bytes(x), bytes(g)) for p, k, x, g in rows})
    if not any(k < len(KINDS) for _, k, _, _ in rows):
        return None
    random = np.random.default_rng(0)
    given = [(np.frombuffer(x, np.uint8), np.frombuffer(g, np.uint8)) for _, _, x, g in rows]
    given += [_rewritten(x, g, random) for x, g in given if g.any() for _ in range(COPIES)]
    tagger = Tagger.fresh(SYMBOLS, TAGS, BARRED)
    tagger.train(np.stack([x for x, _ in given]), np.stack([g for _, g in given]))
    return tagger


Piece = tuple[int, int, int, float]


def _pieces(tagger: Tagger, x: np.ndarray) -> list[tuple[int, Piece]]:
    """``(window, (kind, start, end, preference))`` of every stretch of one kind, places within the window."""
    tags, gain = tagger.decode(x)
    out = []
    for k in np.flatnonzero(tags.any(axis=1)):
        own, t = tags[k].tolist(), 0
        while t < WINDOW:
            if own[t]:
                kind, end = (own[t] - 1) // 2, t + 1
                while end < WINDOW and own[end] == 2 + 2 * kind:
                    end += 1
                out.append((int(k), (kind, t, end, float(gain[k, t:end].sum()))))
                t = end
            else:
                t += 1
    return out


def _holds(kind: int, text: str, start: int, end: int) -> bool:
    """Whether a stretch stands alone and has what its kind is made of; numbers pass the tests of the base spans."""
    found = text[start:end]
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    if kind == 0:
        return 0 < found.find("@") < len(found) - 1 and "." in found[found.find("@") :]
    if kind == 1:
        return _IP.fullmatch(found) is not None and _plausible_ip(found)
    return _plausible_card(found) if kind == 2 else _plausible_phone(found)


def reconciled(text: str, base: list[tuple[int, int, int]], pieces: list[tuple[int, Piece]]) -> list[tuple[int, int, int]]:
    """The spans that the windows' pieces (with their windows' starts) add to the base spans of a text.

    A piece that another one of its kind covers goes; pieces of one kind that overlap and of which one ends at its window's edge are one
    span; of spans that meet, the one that is preferred most stays, and none that meets a base span.
    """
    placed = sorted((kind, start + s, start + e, gain, s == 0 and start > 0, e == WINDOW) for start, (kind, s, e, gain) in pieces)
    joined: list[list] = []
    for kind, s, e, gain, cut_left, cut_right in placed:
        last = joined[-1] if joined and joined[-1][0] == kind else None
        if last and s < last[2] and (e <= last[2] or last[5] or cut_left):
            last[2:] = [max(e, last[2]), max(gain, last[3]), last[4], cut_right if e >= last[2] else last[5]]
        elif last and s == last[1]:
            last[2:] = [max(e, last[2]), max(gain, last[3]), last[4], cut_right]
        else:
            joined.append([kind, s, e, gain, cut_left, cut_right])
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    added: list[tuple[int, int, int]] = []
    free = []
    for kind, s, e, gain, _, _ in joined:
        e = min(e, len(text))
        while e > s and not text[e - 1].isalnum():
            e -= 1
        while s < e and not (text[s].isalnum() or text[s] in "+(._%-"):
            s += 1
        before = int(np.searchsorted(starts, e)) - 1
        if s < e and _holds(kind, text, s, e) and (before < 0 or reach[before] <= s):
            free.append((-gain, s, e, kind))
    used: dict[int, list[Span]] = {}
    for _, s, e, kind in sorted(free):
        cells = range(s // 256, (e - 1) // 256 + 1)
        if not any(u < e and v > s for c in cells for u, v in used.get(c, ())):
            added.append((kind, s, e))
            for c in cells:
                used.setdefault(c, []).append((s, e))
    return added


SPANS = "array<struct<kind:int,start:bigint,end:bigint,base:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_spans(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: kind (its place in ``KINDS``), start and end in code points, and whether a pattern found it, by kind and then start.

    Each row is looked at alone, so repeated and null ids stay as they are; null and empty texts have no spans, an empty table gives none. Only ``doc_id``
    and ``text`` are read. Without a tagger there are base spans alone.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.decode() for t in texts_of(pa.Table.from_batches([batch]))]
            base, pieces = [base_spans(t)[0] for t in texts], [[] for _ in texts]
            waiting: list[tuple[int, int, np.ndarray]] = []

            def decode() -> None:
                for k, piece in _pieces(tagger, np.stack([x for _, _, x in waiting])):  # noqa: B023
                    row, start, _ = waiting[k]  # noqa: B023
                    pieces[row].append((start, piece))  # noqa: B023
                waiting.clear()  # noqa: B023

            for row, text in enumerate(texts):
                if tagger is None or not ("@" in text or _DIGIT.search(text)):
                    continue
                own = symbols(text)
                for start in windows(own).tolist():
                    waiting.append((row, start, _filled(own, start)))
                    if len(waiting) == DECODED:
                        decode()
            if waiting:
                decode()
            spans = [sorted([(*s, True) for s in b] + [(*s, False) for s in reconciled(t, b, p)]) for t, b, p in zip(texts, base, pieces, strict=True)]
            rows = [[{"kind": k, "start": s, "end": e, "base": own} for k, s, e, own in doc] for doc in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPAN)], names=["doc_id", "spans"])

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(found, f"doc_id bigint, spans {SPANS}")


def summarised(found: DataFrame) -> DataFrame:
    """Per row of :func:`find_spans` how many base spans there are of each kind, a digest of them, all spans as text and how many were added."""
    base = F.filter("spans", lambda s: s["base"])
    names = F.array(*map(F.lit, KINDS))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{KINDS[kind]}")

    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("bigint").alias("n_added")
    return found.select("doc_id", *map(count, range(len(KINDS))), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"), added)
