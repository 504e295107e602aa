"""Documents packed into sequences of bounded length by multiway differencing."""

from __future__ import annotations

import heapq
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harbormill.llm.common import worker_state

CAPACITY = 2048
END_ID = 1  # Fixed value: the id that ends a document.
PIECE = 512  # a document is cut into pieces of at most so many ids
GROUP_WINDOWS = 64  # ids are gathered for so many windows, then packed
SLACK = 8  # ids a window that a group leaves free, so that nearly equal windows fit
MEMO_WORDS = 500_000
LATIN_END = "\u0250"  # letters below it that normalisation leaves alone make one word

SCHEMA = T.StructType(
    [
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("doc_tokens", T.LongType(), False),
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
    ]
)


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers in ``k`` windows of nearly equal sums.

    Every item starts as a partition with one filled window. The two partitions
    that are least even are merged, the fullest windows of one with the emptiest
    of the other, so that their imbalances cancel. Windows are (sum, members),
    members a tree of pairs.
    """
    heap = [(-size, n, [(size, n)]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]  # fullest first; empty windows are not stored
        if len(a) < len(b):
            a, b = b, a
        over = max(0, len(a) + len(b) - k)  # so many windows of b meet the emptiest of a
        keep, meet = a[: len(a) - over], a[len(a) - over :]
        free = len(b) - over
        # the fullest of b go to empty windows, the others meet windows of a in opposing order
        merged = keep + b[:free] + [(x[0] + y[0], (x[1], y[1])) for x, y in zip(meet, reversed(b[free:]), strict=True)]
        merged.sort(key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], serial, merged))
        serial += 1
    out = []
    for _, members in heap[0][2] if heap else []:
        flat, stack = [], [members]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                flat.append(x)
        out.append(sorted(flat))
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Fewest nearly equal windows, none above ``capacity``: their number rises until all fit."""
    k = -(-sum(sizes) // capacity)
    while True:
        windows = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        k += 1


_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _byte_letters(word: str) -> str:
    """The letters that byte-level tokenizers have for the UTF-8 bytes of a word."""
    return word.encode().decode("latin-1").translate(_LETTERS)


class _Memo(dict):
    """Ids by chunk; ``missing`` finds and may keep those of a chunk that is not there."""

    def __init__(self, missing: Callable[[str], bytes]):
        self.__missing = missing

    def __missing__(self, chunk: str) -> bytes:
        return self.__missing(chunk)


class WordCoder:
    """Ids of whole texts by a word tokenizer, white space being dropped.

    Spaces and line breaks end a word for this tokenizer, so a text's ids are those
    of its chunks in order. A bounded memo keeps the ids of chunks that were seen. A
    new chunk goes through the tokenizer's own steps one by one, without the
    bookkeeping of offsets that a whole encoding makes.
    """

    def __init__(self, path: str, bound: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = tuple({t[:2] for t in added})  # a chunk without these holds no special token
        self.memo = _Memo(self._found)
        self.older: dict[str, bytes] = {}  # the memo before: words in use move on from it
        self.bound = bound
        self.plain: dict[str, bool] = {}  # letters that normalisation leaves as one letter
        self._check()
        # whether words of Latin letters beyond ASCII need no more than this
        sample = "Éœuvreßñğž"
        letters = [t.id for t in self.tokenizer.model.tokenize(_byte_letters(sample.lower()))]
        self.latin = self.tokenizer.encode(sample, add_special_tokens=False).ids == letters

    def _check(self) -> None:
        """What the shortcuts below rely on: lower case, words of letters, marks and white space that part them."""

        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        lower = [t.id for t in self.tokenizer.model.tokenize("wordy")]
        if not (ids("Wordy") == lower and all(ids(f"Wordy{m}") == lower + ids(m) for m in ",.") and ids("a b\nc") == ids("a") + ids("b") + ids("c")):
            raise ValueError("not a tokenizer of lower-cased words")

    def _plain_letter(self, c: str) -> bool:
        """A letter that stays one letter when normalised; others can become a letter and a mark, which joins what follows."""
        found = self.plain.get(c)
        if found is None:
            found = self.plain[c] = c.isalpha() and unicodedata.normalize("NFC", c) == c and len(c.lower()) == 1 and c.lower().isalpha()
        return found

    def _coded(self, chunk: str) -> bytes:
        tok = self.tokenizer
        if chunk.isascii() and chunk.isalpha():
            return array("I", [t.id for t in tok.model.tokenize(chunk.lower())]).tobytes()
        if self.latin and chunk and max(chunk) < LATIN_END and all(map(self._plain_letter, chunk)):
            return array("I", [t.id for t in tok.model.tokenize(_byte_letters(chunk.lower()))]).tobytes()
        if any(m in chunk for m in self.marks):
            return array("I", tok.encode(chunk, add_special_tokens=False).ids).tobytes()
        words = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(chunk))
        return array("I", [t.id for word, _ in words for t in tok.model.tokenize(word)]).tobytes()

    def _found(self, chunk: str) -> bytes:
        if chunk in self.memo:  # which has changed since the caller took it
            return self.memo[chunk]
        ids = self.older.get(chunk)
        if ids is None:
            if len(chunk) > 1 and chunk[-1] in ",." and self._plain_letter(chunk[-2]):  # the mark is a word of its own
                ids = self.of(chunk[:-1]) + self.of(chunk[-1])
            else:
                ids = self._coded(chunk)
        if len(chunk) <= 64:
            if len(self.memo) >= self.bound:
                self.memo, self.older = _Memo(self._found), self.memo
            self.memo[chunk] = ids
        return ids

    def of(self, chunk: str) -> bytes:
        return self.memo[chunk]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        # chunks in the memo never leave C
        return b"".join(map(self.memo.__getitem__, text.replace("\n", " ").split(" ")))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, piece: int = PIECE, group_windows: int = GROUP_WINDOWS
) -> DataFrame:
    """Documents as pieces laid out in sequences of at most ``capacity`` ids.

    Every document is tokenized once (``tokenizer`` is read on the executors), ended
    by one more id and cut into pieces of at most ``piece`` ids. A task gathers pieces
    for ``group_windows`` windows, balances them by multiway differencing and goes
    on, so memory is bounded by a group and the longest document, and nothing is
    shuffled. A document that straddles two groups is cut at their border.

    Result: one row per piece with the columns of ``docs`` but the text, then start
    (ids of the document before it), length, ids (little-endian unsigned 32-bit
    integers), doc_tokens, sequence_id, offset (place in the sequence, without
    gaps). A sequence is as long as its pieces; padding it is left to the reader.

    Null and empty texts give one piece with the ending id alone. Every row is a document
    of its own, repeated rows too. Columns of the same name as a new one are replaced. An
    empty table gives no rows. sequence_id is made of the partition's number and a
    counter: a task that runs again over the same partition gives the same ids.
    """
    if piece > capacity:
        raise ValueError("a piece must fit a sequence")
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in SCHEMA.names]
    names = [f.name for f in kept]
    room = group_windows * capacity - group_windows * min(SLACK, capacity // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = worker_state("words")
        if tokenizer not in state:
            state[tokenizer] = WordCoder(tokenizer)
        coder = state[tokenizer]
        serial = TaskContext.get().partitionId() << 33
        gathered: list = []  # (columns of the row, start, length, ids, doc_tokens)
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal serial, gathered, size
            rows: list = []
            for window in windows_of([g[2] for g in gathered], capacity):
                offset = 0
                for i in window:
                    rows.append((*gathered[i], serial, offset))
                    offset += gathered[i][2]
                serial += 1
            columns = list(zip(*rows, strict=True))
            own = zip(*columns[0], strict=True) if names else ()
            arrays = [pa.array(list(x), t) for x, t in zip(own, types, strict=True)]
            arrays += [pa.array(list(x), pa.binary() if n == 2 else pa.int64()) for n, x in enumerate(columns[1:])]
            gathered, size = [], 0
            return pa.RecordBatch.from_arrays(arrays, [*names, *SCHEMA.names])

        types: list = []
        for batch in batches:
            types = [batch.schema.field(n).type for n in names]
            columns = [batch.column(n).to_pylist() for n in names]
            own = list(zip(*columns, strict=True)) if names else [()] * batch.num_rows
            texts = batch.column("text").to_pylist()
            for n, text in enumerate(texts):
                ids = coder.encode(text or "") + END_ID.to_bytes(4, "little")
                total = len(ids) // 4
                at = 0
                while at < total:
                    take = min(piece, total - at, room - size)
                    gathered.append((own[n], at, take, ids[4 * at : 4 * (at + take)], total))
                    at += take
                    size += take
                    if size == room:
                        yield flush()
        if gathered:
            yield flush()

    schema = T.StructType([*kept, *SCHEMA.fields])
    return docs.select("text", *[f"`{n}`" for n in names]).mapInArrow(run, schema)
