"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point.
An n-gram is the product (binding) of its letters' vectors, each rotated by
its place; a text is the sum (bundle) of its n-grams' vectors, a language the
sum of its sample texts' unit vectors.  A text gets the language whose
prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, mix, released, table, text_buffers

#: Length of the vectors; a multiple of 64.
DIMENSIONS = 1024
#: Letters in an n-gram; the runs between words count as one letter.
ORDER = 3
#: Bound of the training sample: distinct texts taken per language, those of the smallest hashes.
SAMPLE_PER_LANGUAGE = 1000
#: Bytes of text whose n-grams are counted at once; the counts take about 60 times as much.
COUNTED_BYTES = 1 << 19
#: The name for texts without a letter.
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    if not _LETTERS:
        out = np.zeros(0x110000, np.uint32)
        for p in range(0x110000):
            c = chr(p)
            if c.isalpha():
                low = c.lower()
                out[p] = ord(low) if len(low) == 1 else p
        _LETTERS.append(out)
    return _LETTERS[0]


def letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Random +1/-1 vectors of letters, the same in every process."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    bits = mix(mix(letters.astype(np.uint64) + np.uint64(0x5EED))[:, None] + words)
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1).reshape(len(letters), dimensions)


def _counts(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(document, n-gram, count)`` of a block, sorted by document, n-grams as rows of places in ``letters``."""
    data, offsets = text_buffers(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    code = _letters()[points]
    doc = np.repeat(np.arange(len(column)), np.diff(chars))
    # runs without letters shrink to one boundary; every document begins and ends with one
    is_letter = code > 0
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1] & (doc[1:] == doc[:-1])
    code, doc = code[keep], doc[keep]
    has = np.flatnonzero(np.bincount(doc, minlength=len(column)))
    begin = np.searchsorted(doc, has)
    code, doc = np.insert(code, begin, 0), np.insert(doc, begin, has)
    end = np.searchsorted(doc, has, side="right")
    code, doc = np.insert(code, end, 0), np.insert(doc, end, has)
    letters, place = np.unique(code, return_inverse=True)
    n, m = len(letters), len(code) - order + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros((0, order), np.int64), np.zeros(0, np.int64), letters
    gram = np.zeros(m, np.int64)
    for k in range(order):
        gram = gram * n + place[k:k + m]
    ok = doc[:m] == doc[order - 1:]
    both, count = np.unique(doc[:m][ok] * n**order + gram[ok], return_counts=True)
    doc, gram = both // n**order, both % n**order
    return doc, np.stack([gram // n ** (order - 1 - k) % n for k in range(order)], axis=1), count, letters


def bundles(column: pa.Array, dimensions: int = DIMENSIONS, order: int = ORDER, chunk: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, vector)`` of every text with a letter.  n-gram vectors are made ``chunk`` at a time."""
    doc, grams, count, letters = _counts(column, order)
    if not len(doc):
        return
    vectors = letter_vectors(letters, dimensions)
    rolled = [np.roll(vectors, order - 1 - k, axis=1) for k in range(order)]

    def bind(rows: np.ndarray) -> np.ndarray:
        out = rolled[0][rows[:, 0]]
        for k in range(1, order):
            out = out * rolled[k][rows[:, k]]
        return out

    n = len(letters)
    name = (grams * (n ** np.arange(order - 1, -1, -1))).sum(1)
    kinds, which = np.unique(name, return_inverse=True)
    known = None
    if len(kinds) <= 8 * chunk:  # the block's n-grams fit: each is bound once
        known = bind(np.stack([kinds // n ** (order - 1 - k) % n for k in range(order)], axis=1))
    edges = np.append(np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), len(doc))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        out = np.zeros(dimensions, np.float32)
        for c in range(a, b, chunk):
            d = min(b, c + chunk)
            out += count[c:d].astype(np.float32) @ (known[which[c:d]] if known is not None else bind(grams[c:d])).astype(np.float32)
        yield int(doc[a]), out


def train(docs: DataFrame, fit: Column, text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE,
          dimensions: int = DIMENSIONS, order: int = ORDER) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes, learned from the rows where ``fit`` holds and text and language are not null.

    Of each language the ``per_language`` distinct texts with the smallest
    hashes are bundled.  The sample is found by its hashes alone; only the
    texts below each language's limit are moved.
    """
    labelled = docs.filter(fit & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    first = Window.partitionBy("lang").orderBy("h")
    limits = (labelled.select("lang", "h").distinct().withColumn("n", F.row_number().over(first))
              .filter(F.col("n") <= per_language).groupBy("lang").agg(F.max("h").alias("most")))
    # one row for each language: broadcast, so that only texts below a limit are moved
    sample = labelled.join(F.broadcast(limits), "lang").filter(F.col("h") <= F.col("most")).groupBy("lang", "h").agg(F.min("text").alias("text"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in blocks(batch, 1, COUNTED_BYTES):
                names = part.column(0).to_pylist()
                for i, vector in bundles(part.column(1), dimensions, order):
                    unit = vector / np.linalg.norm(vector).clip(1e-9)
                    sums[names[i]] = sums.get(names[i], 0) + unit.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "vector"])

    parts = sample.select("lang", "text").coalesce(8).mapInArrow(run, "lang string, vector array<double>").collect()
    total: dict[str, np.ndarray] = {}
    for r in parts:
        total[r["lang"]] = total.get(r["lang"], 0) + np.array(r["vector"])
    languages = sorted(total)
    if not languages:
        return [], np.zeros((0, dimensions), np.float32)
    stack = np.stack([total[x] for x in languages])
    return languages, (stack / np.linalg.norm(stack, axis=1, keepdims=True).clip(1e-9)).astype(np.float32)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, text: str = "text", order: int = ORDER) -> DataFrame:
    """``docs`` with ``__tm_lang`` and ``__tm_score``, the cosine with that language's prototype (0 to 1).

    ``und`` and 0 for a null text, a text without a letter, or without any
    learned language.  Map-only; the prototypes are one row per language.
    """
    names = docs.columns
    at = names.index(text)
    dimensions = prototypes.shape[1]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the text goes to Python once; a null one counts as empty here and stays null in its column
            whole = pc.fill_null(batch.column(at).cast(pa.string()), "")
            for part in blocks(pa.RecordBatch.from_arrays([*batch.columns, whole], [*names, "__tm_text"]), len(names), COUNTED_BYTES):
                lang, score = [UNDETERMINED] * part.num_rows, [0.0] * part.num_rows
                if languages:
                    for i, vector in bundles(part.column(len(names)), dimensions, order):
                        cosine = prototypes @ vector / np.linalg.norm(vector).clip(1e-9)
                        best = int(cosine.argmax())
                        lang[i], score[i] = languages[best], float(min(1.0, max(0.0, cosine[best])))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(names))), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    [*names, "__tm_lang", "__tm_score"])

    return docs.mapInArrow(run, docs.schema.simpleString()[7:-1] + ", __tm_lang string, __tm_score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose crc32 of the id as text leaves 2 modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def chance_level(dimensions: int = DIMENSIONS) -> float:
    """Cosine that an unrelated text exceeds about once in a thousand: three deviations of a random vector's."""
    return 3 / dimensions**0.5


def op6(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    languages, prototypes = train(docs, ~held_out())
    out = predict(docs.select("doc_id", "text"), languages, prototypes)
    return out.select("doc_id", held_out().alias("held_out"), F.col("__tm_lang").alias("lang_pred"), F.col("__tm_score").alias("score"))
