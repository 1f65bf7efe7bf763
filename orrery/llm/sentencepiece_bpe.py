"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 7).

Texts are cut at the places no piece crosses (before a run of spaces, around newlines). The
distinct segments of a batch become one flat symbol array; each round finds the best-ranked
adjacent pair of every segment at once (segmented minimum), merges its occurrences from the left
and compacts the arrays, until no segment has a pair left. Where a merged occurrence makes a pair with a neighbour that
goes before the other occurrences, those to its right wait for the next round. Characters outside the
vocabulary become byte pieces. Decoding gathers the pieces' bytes.

Defined results: a null text counts as empty; an empty text has no ids and decodes to an empty
text. Texts have any length, also without a space; repeated rows are encoded alike, an empty table gives an empty one, and a
column named like a result is replaced. The ids and decoded texts are those of the sentencepiece library for models without text
normalisation (``Vocabulary.load`` refuses others).
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import map_texts
from orrery.llm.hashtable import HashTable

_MARK = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)
#: Distinct segments, and their characters, that a Python worker remembers before it starts anew.
CACHE_SEGMENTS, CACHE_CHARS = 200_000, 8_000_000


@dataclass
class Vocabulary:
    """The pieces of a model, and the tables for merging; small and of fixed size."""

    pieces: list[str]
    scores: np.ndarray
    unk_id: int
    first_byte: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        byte_ids = [i for i in range(n) if sp.is_byte(i)]
        if len(byte_ids) != 256 or byte_ids[-1] - byte_ids[0] != 255:
            raise ValueError("the model has no byte fallback")
        probe = " Ａ  éﬁ "  # full width, a ligature, repeated and outer spaces
        if sp.decode(sp.encode(probe)) != probe or not sp.id_to_piece(sp.encode("a")[0]).startswith(_MARK):
            raise ValueError("the model normalises texts, or adds no space before them")
        special = {i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        scores = np.array([np.nan if i in special else sp.get_score(i) for i in range(n)])
        return cls(pieces, scores, sp.unk_id(), byte_ids[0])


class Merger:
    """Encodes segments; built once in a Python worker from a ``Vocabulary``."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.n, self.first_byte = len(vocab.pieces), vocab.first_byte
        ids = {p: i for i, p in enumerate(vocab.pieces) if not np.isnan(vocab.scores[i])}
        order = np.unique(-vocab.scores[~np.isnan(vocab.scores)])
        self.rank = np.full(self.n + 1, _NONE, np.int32)
        for i in ids.values():
            self.rank[i] = np.searchsorted(order, -vocab.scores[i])
        self.char_ids = np.arange(self.n, self.n + 0x110000, dtype=np.int32)  # unknown: past the pieces
        keys, merged, risky = [], [], np.zeros(self.n + 1, bool)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    merged.append(i)
                    for part in (a, b):  # merging to part can make a pair that goes before its other occurrences
                        risky[part] |= self.rank[i] <= self.rank[part]
        self.table, self.merged = HashTable(np.array(keys, np.uint64)), np.array([*merged, -1], np.int32)
        self.risky = risky
        words = [p for p in ids if len(p) > 1]
        self.cut_at_space = not any(_MARK in p.lstrip(_MARK) for p in words)
        newline = not any("\n" in p for p in words)
        self.pattern = re.compile((r" *[^ \n]+| +|\n" if newline else r" *[^ ]+| +") if self.cut_at_space else r"(?s).+")
        self.bytes = [b""] * self.n
        for i, p in enumerate(vocab.pieces):
            self.bytes[i] = bytes([i - self.first_byte]) if 0 <= i - self.first_byte < 256 else b"" if np.isnan(vocab.scores[i]) and i != vocab.unk_id else " ⁇ ".encode() if i == vocab.unk_id else p.replace(_MARK, " ").encode()
        self.piece_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.piece_sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.cache: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.cache.clear()
        self.ids, self.starts, self.sizes, self.used, self.chars = np.zeros(1 << 16, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        out = self.table.find(left.astype(np.uint64) * np.uint64(self.n) + right.astype(np.uint64))
        out = self.merged[out]
        out[(left >= self.n) | (right >= self.n)] = -1
        return out

    def _in_turn(self, at: np.ndarray, sym: np.ndarray, seg: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """The places ``at`` (ascending) up to the first in each segment whose merge makes a pair that goes before the rest."""
        some = np.flatnonzero(self.risky[pair[at]])
        if not len(some):
            return at
        p, m = at[some], pair[at[some]]
        left = np.maximum(p - 1, 0)
        joined = np.r_[False, at[1:] == at[:-1] + 2][some]  # the one before has just become a piece
        before = np.where(joined, pair[at[some - 1]], sym[left])
        right = np.minimum(p + 2, len(sym) - 1)
        first, second = self._find(before, m), self._find(m, sym[right])
        stops = (p > 0) & (seg[left] == seg[p]) & (first >= 0) & (self.rank[first] <= self.rank[m])
        stops |= (p + 2 < len(sym)) & (seg[right] == seg[p]) & (second >= 0) & (self.rank[second] <= self.rank[m])
        stop = some[stops]
        if not len(stop):
            return at
        of = seg[at[stop]]
        lead = np.r_[True, of[1:] != of[:-1]]
        stop, of = stop[lead], of[lead]
        nearest = np.minimum(np.searchsorted(of, seg[at]), len(of) - 1)
        return at[(of[nearest] != seg[at]) | (np.arange(len(at)) <= stop[nearest])]

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and sizes, in the order of the segments (none of them empty)."""
        text = "".join(segments).replace(" ", _MARK)
        sym = self.char_ids[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        seg = np.repeat(np.arange(len(segments)), np.fromiter(map(len, segments), np.int64, len(segments)))
        pair = np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            inner = np.flatnonzero(seg[:-1] == seg[1:])
            pair[inner] = self._find(sym[inner], sym[inner + 1])
        done_sym, done_seg = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            rank = self.rank[pair]
            rank[pair < 0] = _NONE
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            best_of = np.repeat(best, sizes)
            hit = (rank == best_of) & (pair >= 0)
            over = best == _NONE
            if over.any():
                ended = np.repeat(over, sizes)
                done_sym.append(sym[ended])
                done_seg.append(seg[ended])
                sym, seg, pair, hit = sym[~ended], seg[~ended], pair[~ended], hit[~ended]
                if not len(sym):
                    break
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])  # of overlapping pairs, every second from the left
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = self._in_turn(at[place % 2 == 0], sym, seg, pair)
            sym[at] = pair[at]
            live = np.ones(len(sym), bool)
            live[at + 1] = False
            shifted = at - np.arange(len(at))
            sym, seg, pair = sym[live], seg[live], pair[live]
            pair[shifted] = -1
            near = np.zeros(len(sym) + 1, bool)
            near[shifted] = near[shifted - 1] = True  # -1 is the spare last place
            touched = np.flatnonzero(near[:-1])
            touched = touched[touched + 1 < len(sym)]
            pair[touched] = -1
            touched = touched[seg[touched] == seg[touched + 1]]
            pair[touched] = self._find(sym[touched], sym[touched + 1])
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(len(segments), np.int64)
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        sym, seg = sym[order], seg[order]
        if len(unknown := np.flatnonzero(sym >= self.n)):  # to the bytes of the character
            utf8 = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[unknown] - self.n).tolist()]
            width = np.ones(len(sym), np.int64)
            width[unknown] = [len(b) for b in utf8]
            first = np.cumsum(width) - width
            ids = np.repeat(sym, width)
            ids[np.concatenate([np.arange(f, f + len(b)) for f, b in zip(first[unknown].tolist(), utf8, strict=True)])] = np.frombuffer(b"".join(utf8), np.uint8).astype(np.int32) + self.first_byte
            sym, seg = ids, np.repeat(seg, width)
        return sym, np.bincount(seg, minlength=len(segments))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the offsets of each text in them."""
        cut = [self.pattern.findall(" " + t.replace(_MARK, " ")) if t else [] for t in texts]
        if len(self.cache) > CACHE_SEGMENTS or self.chars > CACHE_CHARS:
            self._forget()
        cache = self.cache
        new = list(set(itertools.chain.from_iterable(cut)).difference(cache))
        if new:
            ids, sizes = self.encode_segments(new)
            cache.update(zip(new, range(len(cache), len(cache) + len(new)), strict=True))
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.empty(max(len(ids), self.used), np.int32)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.starts = np.r_[self.starts, self.used + np.cumsum(sizes) - sizes]
            self.sizes = np.r_[self.sizes, sizes]
            self.used += len(ids)
            self.chars += sum(map(len, new))
        rows = np.array(list(map(cache.__getitem__, itertools.chain.from_iterable(cut))), np.int64)
        sizes = self.sizes[rows]
        ends = np.r_[0, np.cumsum(sizes)]
        flat = self.ids[np.repeat(self.starts[rows] - ends[:-1], sizes) + np.arange(ends[-1])]
        return flat, ends[np.r_[0, np.cumsum([len(w) for w in cut])].astype(np.int64)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each range of ids: pieces joined, the marks spaces, without the first space."""
        sizes = self.piece_sizes[ids]
        ends = np.r_[0, np.cumsum(sizes)]
        raw = self.piece_bytes[np.repeat(self.piece_starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        at = ends[offsets].tolist()
        return [raw[a + (raw[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


def encode_decode(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("ids", "decoded")) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``decoded string``, the text that the ids decode to, or other ``names`` for these."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # the vocabulary: a fixed table

    def make():
        merger = Merger(shared.value)

        def compute(texts):
            values = ["" if t is None else t for t in texts.to_pylist()]
            ids, offsets = merger.encode(values)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            return [lists, pa.array(merger.decode(ids, offsets), pa.string())]

        return compute

    return map_texts(docs, text_col, make, f"`{names[0]}` array<int>, `{names[1]}` string", keep)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of ids and SHA-256 digests of the ids and of the decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
