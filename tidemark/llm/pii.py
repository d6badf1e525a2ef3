"""Personal data: checked patterns, and a character tagger for forms that the patterns miss.

The tagger reads overlapping windows.  Where windows overlap, a character's
scores are their mean, weighted by how far inside each window it stands; one
best path through each stretch of windows then settles all spans at once.  A
span always holds a digit or ``@``, so only windows with one are read: no
other window can hold a span.  Spans of the tagger must pass the check of
their kind and keep clear of the patterns' spans.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import STEP_BYTES, blocks, released, table, text_buffers, text_or_empty
from tidemark.llm.tagger import Tagger, classes

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and how far the next one is.
WINDOW, HOP = 64, 32
#: Bound of the training sample: documents with a digit or ``@``, those of the smallest hashes.
SAMPLE = 300
#: Made windows that are added for each form.
MADE = 60
#: Windows and stretches worked on side by side.
TOGETHER = 512

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost search for the whole pattern finds them, from each ``@`` backwards: linear in the text."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def _valid(kind: int, text: str) -> bool:
    if kind == 1:
        return all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in text.split(".")))
    if kind == 2:
        d = _digits(text)
        return 12 <= len(d) <= 19 and luhn(d)
    return kind == 0 or 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, leftmost and non-overlapping per kind; matches that fail their check are dropped."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _accepted(kind: int, text: str) -> bool:
    """Whether a span of the tagger is one of its kind, whatever separates its parts."""
    if kind == 0:
        local, _, domain = text.partition("@")
        return bool(re.fullmatch(r"[\w.%+-]+ ?", local) and re.fullmatch(r" ?[\w-]+( ?\. ?[\w-]+)+", domain))
    if kind == 1:
        parts = re.fullmatch(r"([0-9]{1,3})( ?[.,-] ?[0-9]{1,3}){3}", text)
        return bool(parts) and all(int(p) <= 255 for p in re.findall("[0-9]+", text))
    d = _digits(text)
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d) and not re.search(r"[^0-9 ./_-]", text)
    return 9 <= len(d) <= 15 and bool(re.fullmatch(r"\(?[0-9][0-9 ().\-/]*[0-9]", text)) and bool(re.search(r"[0-9][ ().\-/]+[0-9]", text))


# --- training ------------------------------------------------------------------------------


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random) -> str:
    head = "4" + _number(rng, 14)
    return next(head + c for c in "0123456789" if luhn(head + c))


def made_forms(rng: random.Random) -> list[tuple[int, str]]:
    """One example of each form: its kind, or -1 for numbers that are nothing personal."""
    name = "".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(3, 9)))
    host = f"mail{rng.randint(0, 9)}.example.{rng.choice(['com', 'org', 'net'])}"
    ip = [str(rng.randint(0, 255)) for _ in range(4)]
    card, a, b, c = _card(rng), _number(rng, 3), _number(rng, 3), _number(rng, 4)
    fours = [card[i:i + 4] for i in range(0, 16, 4)]
    return [
        (0, f"{name}.{rng.randint(0, 99)}@{host}"), (0, f"{name} @ {host}"), (0, f"{name}@ {host}"), (0, f"{name.upper()}@{host.replace('.', ' . ')}"),
        (1, ".".join(ip)), (1, " . ".join(ip)), (1, "-".join(ip)),
        (2, card), (2, " ".join(fours)), (2, ".".join(fours)), (2, "/".join(fours)),
        (3, f"+1 ({a}) {b}-{c}"), (3, f"({a}) {b}-{c}"), (3, f"{a}-{b}-{c}"), (3, f"{a}.{b}.{c}"), (3, f"{a} {b} {c}"),
        (-1, f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"), (-1, _number(rng, rng.randint(1, 8))),
        (-1, f"password={rng.getrandbits(64):x}"), (-1, f"v{rng.randint(1, 9)}.{rng.randint(0, 99)}.{rng.randint(0, 99)}"),
        (-1, f"{rng.randint(1, 999)},{_number(rng, 3)},{_number(rng, 3)}"), (-1, f"@{name}"),
    ]


def _window(text: str, spans: list[Span], begin: int) -> tuple[np.ndarray, np.ndarray]:
    ids, tags = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
    part = text[begin:begin + WINDOW]
    ids[:len(part)] = classes(part) if part else 0
    for a, k, b in spans:
        lo, hi = max(a - begin, 0), min(b - begin, WINDOW)
        if lo < hi:
            tags[lo:hi] = 2 * k + 2
            if a >= begin:
                tags[lo] = 2 * k + 1
    return ids, tags


def training_windows(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows: around the patterns' spans in a bounded sample of documents, and made forms set into its text."""
    sample = (docs.select(text_or_empty(text).alias("t")).filter(F.col("t").rlike("[0-9@]"))
              .orderBy(F.xxhash64("t"), F.length("t")).limit(SAMPLE))

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                places = [m.start() for m in re.finditer("[0-9@]", t)][::7]
                rng = random.Random(len(t))
                for p in rng.sample(places, min(4, len(places))):  # up to four windows a document
                    a = max(0, p - rng.randint(0, WINDOW))
                    out.append((t[max(0, a - WINDOW):a + 2 * WINDOW], a - max(0, a - WINDOW)))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([b for _, b in out], pa.int32())], ["t", "begin"])

    rows = sorted((r["t"], r["begin"]) for r in sample.mapInArrow(cut, "t string, begin int").collect())
    made = random.Random(3)
    windows = [_window(t, [(a, k, b) for a, k, b in base_spans(t)], begin) for t, begin in rows]
    filler = " ".join(re.sub(r"\S*[0-9@]\S*", "", t) for t, _ in rows) or "some plain words between, and more of them. " * 9
    for _ in range(MADE):
        for kind, form in made_forms(made):
            at = made.randrange(max(1, len(filler) - 2 * WINDOW))
            before, after = filler[at:at + made.randint(0, WINDOW)].rstrip(), filler[at + WINDOW:at + 2 * WINDOW].lstrip()
            t = f"{before} {form} {after}" if before else f"{form} {after}"
            start = len(before) + (1 if before else 0)
            spans = [(start, kind, start + len(form))] if kind >= 0 else []
            windows.append(_window(t, spans, made.randint(0, max(0, len(t) - WINDOW))))
    return np.stack([w for w, _ in windows]), np.stack([t for _, t in windows])


def train(docs: DataFrame, text: str = "text", epochs: int = 6) -> Tagger:
    tagger = Tagger(len(KINDS))
    tagger.train(*training_windows(docs, text), epochs=epochs)
    return tagger


# --- decoding ------------------------------------------------------------------------------


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans of the tagger in whole texts, before any check."""
    of, begin, ids = [], [], []
    for i, t in enumerate(texts):
        places = np.array([m.start() for m in re.finditer("[0-9@]", t)], np.int64)
        if not len(places):
            continue
        cells = np.unique(np.concatenate([places // HOP, places // HOP - 1]))  # the two windows that hold a place
        codes = classes(t)
        for a in (cells[cells >= 0] * HOP).tolist():
            w = np.zeros(WINDOW, np.int64)
            w[:len(codes[a:a + WINDOW])] = codes[a:a + WINDOW]
            of.append(i)
            begin.append(a)
            ids.append(w)
    out: list[list[Span]] = [[] for _ in texts]
    if not ids:
        return out
    scores = np.concatenate([tagger.emissions(np.stack(ids[c:c + TOGETHER])) for c in range(0, len(ids), TOGETHER)])
    inside = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float64)
    # stretches: windows of one text that touch
    new = np.array([True, *(of[j] != of[j - 1] or begin[j] > begin[j - 1] + WINDOW for j in range(1, len(of)))])
    first = np.flatnonzero(new)
    stretches = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(of)]):
        start, end = begin[a], min(begin[b - 1] + WINDOW, len(texts[of[a]]))
        total, weight = np.zeros((begin[b - 1] + WINDOW - start, scores.shape[2])), np.zeros(begin[b - 1] + WINDOW - start)
        for j in range(a, b):
            at = begin[j] - start
            total[at:at + WINDOW] += scores[j] * inside[:, None]
            weight[at:at + WINDOW] += inside
        stretches.append((of[a], start, (total / np.maximum(weight, 1e-9)[:, None])[:end - start]))
    stretches.sort(key=lambda s: len(s[2]))
    c = 0
    while c < len(stretches):
        d = c + 1  # stretches of about one length side by side
        while d < len(stretches) and d - c < TOGETHER and len(stretches[d][2]) <= 2 * len(stretches[c][2]):
            d += 1
        some = stretches[c:d]
        c = d
        lengths = np.array([len(s[2]) for s in some])
        e = np.zeros((len(some), int(lengths.max()), scores.shape[2]))
        for j, s in enumerate(some):
            e[j, :len(s[2])] = s[2]
        for (i, start, _), tags in zip(some, tagger.decode(e, lengths)):
            heads = np.flatnonzero(tags % 2 == 1)
            for h in heads.tolist():
                end = h + 1
                while end < len(tags) and tags[end] == tags[h] + 1:
                    end += 1
                out[i].append((start + h, int(tags[h]) // 2, start + end))
    return out


def find(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """``(base spans, added spans)`` of every text."""
    out = []
    for t, tagged in zip(texts, tagged_spans(tagger, texts)):
        base = base_spans(t)
        added = []
        for a, k, b in tagged:
            a, b = a + len(t[a:b]) - len(t[a:b].lstrip()), b - len(t[a:b]) + len(t[a:b].rstrip())
            if not any(x < b and a < y for x, _, y in base) and _accepted(k, t[a:b]):
                added.append((a, k, b))
        out.append((base, added))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the name of its first one's kind, as in ``<EMAIL>``."""
    out, end = [], 0
    for a, k, b in sorted(spans):
        if a >= end:
            out += [text[end:a], f"<{KINDS[k].upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def detect(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """``docs`` with ``__tm_base`` and ``__tm_added`` (arrays of kind, start, end in code points) and ``__tm_redacted``.

    Whole texts; a null or empty text has no spans and stays as it is.
    Map-only; the tagger's weights, a few thousand numbers, go with the task.
    """
    names = docs.columns
    source = docs.withColumn("__tm_text", text_or_empty(text))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        for batch in batches:
            for part in blocks(batch, k, STEP_BYTES):
                data, offsets = text_buffers(part.column(k))
                hits = np.concatenate(([0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))))
                some = np.flatnonzero(np.diff(hits[offsets]))  # rows with a digit or @
                texts = part.column(k).take(pa.array(some)).to_pylist()
                base, added = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                changed = part.column(k).to_pylist()
                for i, t, (b, a) in zip(some.tolist(), texts, find(tagger, texts)):
                    base[i] = [{"kind": KINDS[x], "start": s, "end": e} for s, x, e in b]
                    added[i] = [{"kind": KINDS[x], "start": s, "end": e} for s, x, e in a]
                    changed[i] = redacted(t, b + a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(j) for j in range(k)), pa.array(base, span), pa.array(added, span), pa.array(changed, pa.string())],
                    [*names, "__tm_base", "__tm_added", "__tm_redacted"])

    kind = "array<struct<kind:string,start:int,end:int>>"
    return source.mapInArrow(run, docs.schema.simpleString()[7:-1] + f", __tm_base {kind}, __tm_added {kind}, __tm_redacted string")


def _of_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _printed(spans):
    order = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(docs, train(docs))
    every = F.concat("__tm_base", "__tm_added")
    return found.select(
        "doc_id", *(_of_kind(every, k) for k in KINDS),
        F.sha2(_printed(F.col("__tm_base")), 256).alias("base_sha256"), _printed(every).alias("spans"), F.size("__tm_added").cast("long").alias("n_added"))
