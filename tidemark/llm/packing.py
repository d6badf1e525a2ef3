"""Packing by power-of-two decomposition.

Every document's tokens are cut into pieces whose lengths are powers of two:
whole pieces of the largest length first, then the binary digits of the rest.
A piece is a sequence of its own, so no sequence crosses documents and none
is padded; sequences of one length form a bucket from which batches are drawn.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, released, stored, table, text_or_empty

#: Id that closes every document.
CLOSING_ID = 0
#: Texts with code points from here on (beyond Latin letters) are left to the tokenizers library alone.
_BEYOND_LATIN = "ɐ"

_CODERS: dict[str, Coder] = {}


class Coder:
    """Ids of the byte-level vocabulary of a ``tokenizers`` file.

    Latin text is encoded from the same vocabulary by tiktoken, several times
    faster; texts with other letters, or with the text of a special token, go
    through the library itself.  The first texts of every process go through
    both, and a difference is an error.
    """

    def __init__(self, path: str, compared: int = 64):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.library, self.compared = Tokenizer.from_file(path), compared
        with open(path) as fh:
            spec = json.load(fh)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = special
        # the vocabulary writes bytes as printable characters; the rule is the library's own pre-tokenizer
        printable = {c: b for b, c in enumerate(_byte_characters(pre_tokenizers))}
        ranks = {bytes(printable[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        return (text.isascii() or max(text) < _BEYOND_LATIN) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [self.fast.encode_to_numpy(t).astype("<u4") if self.plain(t) else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None or i < self.compared]
        for i, e in zip(rest, self.library.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            if out[i] is not None and not np.array_equal(out[i], ids):
                raise ValueError("the vocabulary does not encode as the tokenizers library does")
            out[i] = ids
        self.compared = max(0, self.compared - len(texts))
        return out


def _byte_characters(pre_tokenizers) -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one from 256."""
    alphabet = set(pre_tokenizers.ByteLevel.alphabet())
    own = [chr(b) if chr(b) in alphabet else "" for b in range(256)]
    free = iter(range(256, 512))
    return [c or chr(next(free)) for c in own]


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def cut(n: int, most: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: ``most`` as often as it goes, then the binary digits of the rest."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, most: int = 1024, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True) -> DataFrame:
    """One row for each piece of each document: ``keep``, ``start``, ``length`` (a power of two up to ``most``),
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (always 0) and, with ``ids``, ``ids``.

    The closing id counts as a token, so an empty or null text is one piece of
    one token.  A bucket is the rows of one ``length``; ``write_buckets``
    writes them apart.  Pieces are stored before they are numbered, so that
    ``sequence_id`` stays the same if a task is run again.  Repeated rows are
    packed each on its own.
    """
    if most & (most - 1) or most < 1:
        raise ValueError("the largest length must be a power of two")
    source = docs.select(*keep, text_or_empty(text).alias("__tm_text"))
    width = len(keep)
    schema = docs.select(*keep).schema.simpleString()[7:-1] + ", start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if ids else ""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for part in blocks(batch, width):
                row, start, length, crc, tokens, lists = [], [], [], [], [], []
                for i, got in enumerate(c.encode(part.column(width).to_pylist())):
                    got = np.append(got, np.uint32(CLOSING_ID)).astype("<u4")
                    at = 0
                    for n in cut(len(got), most):
                        row.append(i)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(got[at:at + n]))
                        tokens.append(len(got))
                        if ids:
                            lists.append(got[at:at + n].astype(np.int32))
                        at += n
                out = [part.column(k).take(pa.array(row, pa.int64())) for k in range(width)]
                out += [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                names = [*keep, "start", "length", "ids_crc32", "doc_tokens"]
                if ids:
                    out.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    pieces = stored(source.mapInArrow(run, schema), "pieces")
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences with one folder for each length; a heavy bucket is split over several files."""
    packed.hint("rebalance", "length").write.partitionBy("length").mode("overwrite").parquet(path)


def op5(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of powers of two up to 1024 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
