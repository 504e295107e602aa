"""SentencePiece-style encoding by streaming Viterbi, and decoding.

The model file gives the pieces and their scores; the segmentation with the
greatest sum of scores wins. Of equal sums the one whose last piece is longest
wins, at every boundary.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from harbormill.llm.common import worker_state

SPACE = "▁"
# Fixed value: how much less than the worst piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
MEMO_UNITS = 500_000


@dataclass(frozen=True)
class PieceTable:
    ids: dict  # piece -> (id, score)
    trie: dict  # character -> [score of the piece that ends here or None, its ids, subtree]
    pairs: frozenset  # neighbouring characters that some piece holds
    bytes_of: list  # id -> bytes
    byte_ids: list  # byte -> id
    longest: int
    unknown: float


def load_pieces(path: str) -> PieceTable:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids: dict = {}
    bytes_of: list = []
    byte_ids = [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            bytes_of.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            bytes_of.append(b"")
        else:
            ids[piece] = (i, model.get_score(i))
            bytes_of.append(piece.replace(SPACE, " ").encode())
    trie: dict = {}
    for piece, entry in ids.items():
        tree = trie
        for c in piece:
            node = tree.setdefault(c, [None, (), {}])
            tree = node[2]
        node[0], node[1] = entry[1], (entry[0],)
    pairs = frozenset(pair for p in ids for pair in zip(p, p[1:], strict=False))
    worst = min(score for _, score in ids.values())
    return PieceTable(ids, trie, pairs, bytes_of, byte_ids, max(map(len, ids)), worst - UNKNOWN_PENALTY)


def viterbi(text: str, table: PieceTable) -> list[int]:
    """Best segmentation of ``text``, in memory bounded by the longest piece.

    The lists hold, per boundary since ``base``, the best score, where its last
    piece starts, and that piece's ids. Only the last ``longest`` boundaries can still
    be extended. Once these survivors' back-pointers all pass one boundary, what lies
    before it is decided: its ids are committed and its entries dropped.
    """
    trie, longest, unknown, byte_ids = table.trie, table.longest, table.unknown, table.byte_ids
    n, out, base, at = len(text), [], 0, 0
    width = min(4 * longest, n)
    none = -math.inf
    score, start, last = [0.0] + [none] * width, [0] * (width + 1), [()] * (width + 1)
    while at < n:
        here = at - base
        own = score[here]
        tree, to = trie, here
        single = True
        for c in text[at : at + longest]:
            node = tree.get(c)
            if node is None:
                break
            to += 1
            gain, ids, tree = node
            if gain is not None:
                if own + gain > score[to]:
                    score[to], start[to], last[to] = own + gain, at, ids
            elif to == here + 1:
                single = False
        if (not single or to == here) and own + unknown > score[here + 1]:
            score[here + 1], start[here + 1] = own + unknown, at
            last[here + 1] = tuple([byte_ids[b] for b in text[at].encode("utf-8", "replace")])
        at += 1
        if at == n or at - base >= 2 * longest:
            # survivors: boundaries that a later piece may start from, or the end
            meet = at
            if at < n:
                live = {e for e in range(at, min(n, at + longest) + 1) if score[e - base] > none}
                while len(live) > 1:
                    top = max(live)
                    live.remove(top)
                    live.add(start[top - base])
                (meet,) = live
            path, e = [], meet
            while e > base:
                path.append(last[e - base])
                e = start[e - base]
            for step in reversed(path):
                out.extend(step)
            gone = meet - base
            if gone and at < n:
                top = score[gone]
                score = [s - top for s in score[gone:]] + [none] * gone
                start = start[gone:] + [0] * gone
                last = last[gone:] + [()] * gone
                base = meet
            if at - base + longest + 2 > len(score):  # the paths have not met yet
                score += [none] * width
                start += [0] * width
                last += [()] * width
    return out


class Encoder:
    """Encodes whole texts unit by unit.

    A unit is a run of spaces with the characters up to the next space. No piece
    has a space after another character, so every path passes the boundary
    between units and each unit can be committed by itself. Inside a new unit the
    same holds between two characters that are neighbours in no piece. A bounded memo
    keeps the ids of units that were seen.
    """

    def __init__(self, table: PieceTable, bound: int = MEMO_UNITS):
        if any(SPACE in piece.lstrip(SPACE) for piece in table.ids):
            raise ValueError("a piece has a space after another character")
        self.table, self.bound = table, bound
        self.memo: dict = {}
        self.older: dict = {}  # the memo before: units in use move on from it

    def _new(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is not None:
            return self._remember(unit, found)
        text, pairs = SPACE + unit, self.table.pairs
        end = len(text)
        while end > 2 and (text[end - 2], text[end - 1]) not in pairs:  # as before a full stop: only what stands before it is kept
            end -= 1
        if end < len(text):
            head = text[1:end]
            start = self.memo.get(head)
            if start is None:
                start = self._new(head)  # its last two characters are neighbours in a piece, or it is a single one
            return start + b"".join([self._part(c, ("", c)) for c in text[end:]])
        cuts = [k for k, pair in enumerate(zip(text, text[1:], strict=False), start=1) if pair not in pairs]
        if not cuts:
            return self._part(text, unit)
        ends = [*cuts, len(text)]
        parts = [text[a:b] for a, b in zip([0, *cuts], ends, strict=True)]
        # the first part has the space in front, so it is a unit itself; the rest are kept under keys that no unit has
        coded = [self._part(parts[0], parts[0][1:])] + [self._part(p, ("", p)) for p in parts[1:]]
        return self._remember(unit, b"".join(coded))

    def _part(self, text: str, key) -> bytes:
        found = self.memo.get(key)
        if found is not None:
            return found
        found = self.older.get(key)
        return self._remember(key, array("i", viterbi(text, self.table)).tobytes() if found is None else found)

    def _remember(self, key, ids: bytes) -> bytes:
        if len(self.memo) >= self.bound:
            self.memo, self.older = {}, self.memo
        if len(ids) <= 256:
            self.memo[key] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; the empty text has none."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":  # runs of spaces stay with what follows them
            units = [u[1:] for u in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        else:
            units = text.split(" ")
        found = list(map(self.memo.get, units))
        if None in found:
            found = [(self.memo.get(u) or self._new(u)) if ids is None else ids for u, ids in zip(units, found, strict=True)]
        return b"".join(found)


def decode(ids: list[int], table: PieceTable) -> str:
    """The text of a list of ids; the space that encoding put in front is taken off."""
    of = table.bytes_of
    text = b"".join([of[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


class Decoder:
    """Decodes a batch of id lists by array operations on the bytes of all pieces."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.blob = np.frombuffer(b"".join(table.bytes_of), dtype=np.uint8)
        self.size = np.array([len(b) for b in table.bytes_of], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """One text for each ``counts`` of the ids; the space that encoding put in front is taken off."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # byte k of the result is byte k - (start of its piece in the result) of the piece
        data = self.blob[np.repeat(self.start[ids] - (ends - sizes), sizes) + np.arange(total)]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        filled = np.nonzero(offsets[1:] > offsets[:-1])[0]
        spaced = filled[data[offsets[filled]] == 32]
        keep = np.ones(total, dtype=bool)
        keep[offsets[spaced]] = False
        gone = np.zeros(len(offsets), dtype=np.int64)
        gone[spaced + 1] = 1
        offsets = offsets - np.cumsum(gone)
        if total >= 1 << 31:
            return pa.array([decode(x.tolist(), self.table) for x in np.split(ids, np.cumsum(counts)[:-1])], pa.string())
        found = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[keep])))
        try:
            found.validate(full=True)
        except pa.ArrowInvalid:  # ids that no text has: bytes that are no UTF-8
            return pa.array([decode(x.tolist(), self.table) for x in np.split(ids, np.cumsum(counts)[:-1])], pa.string())
        return found


def _loaded(path: str) -> tuple[Decoder, Encoder]:
    state = worker_state("pieces " + path)
    if not state:
        table = load_pieces(path)
        state.update(decoder=Decoder(table), encoder=Encoder(table))
    return state["decoder"], state["encoder"]


def encode_pieces(docs: DataFrame, model: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with a column of piece ids (array of int) of every whole text.

    Null and empty texts have no ids. All other columns and rows stay as they
    are; a column already called ``to`` is replaced. ``model`` is read on the executors.
    """
    from pyspark.sql import types as T

    kept = docs.drop(to)
    schema = T.StructType([*kept.schema.fields, T.StructField(to, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _loaded(model)
        for batch in batches:
            coded = [encoder.encode(x or "") for x in batch.column(text).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, to])

    return kept.mapInArrow(run, schema)


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text that a column of piece ids stands for; null ids give an empty text."""
    from pyspark.sql import types as T

    kept = rows.drop(to)
    schema = T.StructType([*kept.schema.fields, T.StructField(to, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, _ = _loaded(model)
        for batch in batches:
            lists = batch.column(ids)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = decoder.texts(lists.flatten().to_numpy(zero_copy_only=False), counts.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, to])

    return kept.mapInArrow(run, schema)
