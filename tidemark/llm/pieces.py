"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is a row of symbols, one for each character; an agenda of adjacent
symbol pairs, ordered by the score of the piece they make and then from the
left, is worked off until no pair makes a piece.  Two facts make this fast
without changing any id: no merge crosses a place whose two characters stand
side by side in no piece, so a text falls into short segments, and equal
segments get equal ids.  Each distinct segment of a block is encoded once, all
segments of one length together in numpy; long segments use a heap.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import INVERSE, MULT, blocks, mix, powers, ranges, table, text_buffers, text_or_empty

#: Segments longer than this go through the heap; the others through the array form.
ARRAY_SYMBOLS = 24
_SPACE = 0x2581  # what a space becomes
_NONE = np.int32(1 << 30)  # rank of a pair that makes no piece
_RAW = 1 << 21  # symbols from here on: a character without a piece, _RAW + code point
_PAD = -1

_MODELS: dict[str, PieceModel] = {}


class PieceModel:
    """The merge table of a model file, read through the library's public calls."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        pieces = {sp.id_to_piece(i): i for i in range(size) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))}
        symbols = dict(pieces)  # and characters that only longer pieces have
        for p in pieces:
            for c in p:
                symbols.setdefault(c, size + len(symbols))
        self.n_ids = size
        # characters: code point -> class, class -> symbol, and the classes that may stand side by side in a piece
        chars = sorted({c for p in pieces for c in p})
        self.char_class = np.zeros(0x110000, np.uint16)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.class_symbol = np.array([0, *(symbols[c] for c in chars)], np.int32)
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in pieces:
            if len(p) > 1:
                at = self.char_class[[ord(c) for c in p]]
                self.joins[at[:-1], at[1:]] = True
        # pairs of symbols that make a piece; ranks: 0 for the best score, equal for equal scores
        scores = {i: sp.get_score(i) for i in pieces.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        made = {(symbols[p[:k]], symbols[p[k:]]): i for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        self.width = max(symbols.values()) + 1
        keys = np.array([a * self.width + b for a, b in made] or [0], np.int64)
        by = np.argsort(keys)
        self.keys = keys[by]
        self.makes = np.array([*made.values()] or [0], np.int32)[by]
        self.rank = np.array([order[scores[i]] for i in made.values()] or [_NONE], np.int32)[by]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of every pair; rank ``_NONE`` where the two make no piece."""
        ok = (left >= 0) & (left < self.width) & (right >= 0) & (right < self.width)
        key = np.where(ok, left.astype(np.int64) * self.width + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.makes[at], 0)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        kind = self.char_class[points]
        return np.where(kind > 0, self.class_symbol[kind], _RAW + points.astype(np.int32)).astype(np.int32)

    def merge_array(self, rows: np.ndarray) -> np.ndarray:
        """Work off the agendas of equally long segments (one row each) side by side, one merge per row and round."""
        done = rows.copy()
        n, width = rows.shape
        if width < 2 or not n:
            return done
        live, column = np.arange(n), np.arange(width)
        rank, makes = self.pairs(rows[:, :-1], rows[:, 1:])
        while len(live):
            at = rank.argmin(1)
            row = np.arange(len(live))
            going = rank[row, at] < _NONE
            if not going.all():
                done[live[~going]] = rows[~going]
                live, rows, rank, makes, at = live[going], rows[going], rank[going], makes[going], at[going]
                row = np.arange(len(live))
                if not len(live):
                    break
            piece = makes[row, at]
            source = np.minimum(column + (column > at[:, None]), width - 1)
            last = column[-1]
            rows = np.take_along_axis(rows, source, 1)
            rows[:, last] = _PAD
            rows[row, at] = piece
            # pairs: the merged one goes, its neighbours are looked up anew
            inner = np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2)
            rank, makes = np.take_along_axis(rank, inner, 1), np.take_along_axis(makes, inner, 1)
            rank[:, -1] = _NONE
            rank[row, at], makes[row, at] = self.pairs(piece, rows[row, at + 1])
            has = at > 0
            if has.any():
                rank_l, makes_l = self.pairs(rows[row[has], at[has] - 1], piece[has])
                rank[row[has], at[has] - 1], makes[row[has], at[has] - 1] = rank_l, makes_l
        return done

    def merge_heap(self, symbols: np.ndarray) -> np.ndarray:
        """Work off one segment's agenda with a heap: O(n log n) for any length."""
        n = len(symbols)
        sym = symbols.tolist()
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, makes = self.pairs(symbols[:-1], symbols[1:])
        agenda = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), makes.tolist())) if r < _NONE]
        heapq.heapify(agenda)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def push(i: int) -> None:
            j = after[i]
            if j < 0:
                return
            pair = sym[i], sym[j]
            if pair not in known:
                r, m = self.pairs(np.array(pair[:1]), np.array(pair[1:]))
                known[pair] = int(r[0]), int(m[0])
            r, m = known[pair]
            if r < _NONE:
                heapq.heappush(agenda, (r, i, *pair, m))

        while agenda:
            _, i, a, b, piece = heapq.heappop(agenda)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of the two has gone into another piece
            sym[i], sym[j] = piece, _PAD
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([s for s in sym if s != _PAD], np.int32)

    def to_ids(self, symbols: np.ndarray, owner: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of final symbols with their owners; a character without a piece becomes its UTF-8 bytes."""
        raw = np.flatnonzero(symbols >= self.n_ids)
        if not len(raw):
            return symbols.astype(np.int64), owner
        at = symbols[raw]
        back = {int(s): int(p) for s, p in zip(self.class_symbol[1:], chars)} if (at < _RAW).any() else {}
        coded = [chr(int(s) - _RAW if s >= _RAW else back[int(s)]).encode() for s in at]
        n = np.ones(len(symbols), np.int64)
        n[raw] = [len(c) for c in coded]
        out, first = np.repeat(symbols.astype(np.int64), n), np.cumsum(n) - n
        where = ranges(first[raw], n[raw])
        out[where] = self.byte[np.frombuffer(b"".join(coded), np.uint8)]
        return out, np.repeat(owner, n)

    def encode_segments(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each segment, one after another, and how many each has."""
        symbols, lengths = self.symbols(points), ends - starts
        chars = np.flatnonzero(self.char_class)
        out, owner = [], []
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            if n <= ARRAY_SYMBOLS:
                got = self.merge_array(symbols[starts[own][:, None] + np.arange(n)])
                keep = got != _PAD
                out.append(got[keep])
                owner.append(np.repeat(own, keep.sum(1)))
            else:
                for i in own.tolist():
                    got = self.merge_heap(symbols[starts[i]:ends[i]])
                    out.append(got)
                    owner.append(np.full(len(got), i))
        ids, owner = self.to_ids(np.concatenate(out), np.concatenate(owner), chars)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(starts))

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of every text of a string column without nulls, with begin and end ids."""
        data, offsets = text_buffers(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]  # offsets in characters
        full = np.flatnonzero(np.diff(chars))  # an empty text has no ids of its own
        points = np.insert(np.where(points == 32, _SPACE, points), chars[full], _SPACE)
        first = chars[full] + np.arange(len(full))
        if not len(points):
            return [np.array([self.begin, self.end], np.int64) for _ in range(len(column))]
        kind = self.char_class[points]
        cut = np.concatenate(([True], ~self.joins[kind[:-1], kind[1:]]))
        cut[first] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * powers(MULT, len(points)), out=sums[1:])
        name = mix((sums[ends] - sums[starts]) * powers(INVERSE, len(points) + 1)[starts] + (ends - starts).astype(np.uint64))
        _, one, which = np.unique(name, return_index=True, return_inverse=True)
        ids, counts = self.encode_segments(points, starts[one], ends[one])
        at = np.cumsum(counts) - counts
        every = ids[ranges(at[which], counts[which])]
        upto = np.concatenate(([0], np.cumsum(counts[which])))[np.append(np.searchsorted(starts, first), len(starts))]
        out = [np.array([self.begin, self.end], np.int64)] * len(column)
        for k, i in enumerate(full.tolist()):
            out[i] = np.concatenate(([self.begin], every[upto[k]:upto[k + 1]], [self.end]))
        return out


def model(path: str) -> PieceModel:
    """The model of a path, loaded once in each Python process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, path: str, text: str = "text", check: bool = True, keep: tuple[str, ...] = ("doc_id",),
                  whole: bool = True) -> DataFrame:
    """Columns ``keep`` and, for every whole text, its ids and decoded text with their digests.

    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` always; ``ids`` and
    ``decoded`` only with ``whole``.  With ``check`` each Arrow batch is also
    encoded by the sentencepiece library and ``same`` says if the ids agree
    (null without).  A null text counts as empty and has the begin and end ids
    alone.  One pass, no shuffle; texts over the block size are worked on one
    at a time.
    """
    fields = [f for f in docs.select(*keep).schema.fields]
    source = docs.select(*keep, text_or_empty(text).alias("__tm_text"))
    schema = docs.select(*keep).schema.simpleString()[7:-1] + ", n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    schema += ", ids array<int>, decoded string" if whole else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in blocks(batch, len(fields)):
                ids = m.encode(part.column(len(fields)))
                lists = [x.tolist() for x in ids]
                decoded = m.library.decode(lists) if lists else []
                same = [None] * len(lists)
                if check:
                    want = m.library.encode(part.column(len(fields)).to_pylist(), add_bos=True, add_eos=True, num_threads=1)
                    same = [a == b for a, b in zip(lists, want)]
                out = [part.column(i) for i in range(len(fields))]
                out += [
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                    pa.array(same, pa.bool_()),
                ]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", "same"]
                if whole:
                    out += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)

    return source.mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    """All documents through ``piece_bpe_32k.model`` and back."""
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), whole=False)
