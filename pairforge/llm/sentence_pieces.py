"""SentencePiece encoding and decoding with a merge-type vocabulary.

Encoding is an agenda of adjacent symbol pairs. A text starts as one symbol per code
point; every pair of neighbours that makes a piece of the vocabulary waits in a heap,
highest score first and leftmost first among equals. The best pair is merged, its two new
neighbours join the heap, and entries whose symbols have changed meanwhile are passed
over. What is left and is no piece becomes the pieces of its bytes.

A space is written as ``▁``. If no piece has ``▁`` after another character, as is checked
when a vocabulary is read, no merge crosses the border before a ``▁``: the agenda of a text
is then the agendas of its stretches, runs of ``▁`` with what follows. Each stretch is merged
by itself and frequent ones are remembered, which changes no result. Short stretches of a
chunk of text are merged together, one merge of each at a time. With another vocabulary the
whole text is one stretch.

Decoding joins the bytes of the pieces, reads them as UTF-8 and takes off the space that
encoding put in front.

``encode_documents`` compares both directions with the sentencepiece library, batch by batch;
``agrees`` tells the outcome per document. A null text is empty and has no ids. Repeated rows
and ids come back as often as they occur. An empty table gives no rows. Only ``doc_id`` and
``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SPACE = "▁"
#: Stretches that a Python worker remembers before it forgets all. Stretches of more code points than
#: SHORT have a heap each.
REMEMBERED, SHORT = 1 << 18, 48
#: Bytes of text that are encoded and compared at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
ENCODED = "doc_id bigint, ids array<int>, decoded string, agrees boolean"

#: Fixed values of the model file: numbers of its fields, kinds of pieces and of models.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_MODEL = 2

#: No score; symbols that occur in no piece, and places without a symbol.
NONE, UNHEARD, ABSENT = np.float32(-np.inf), -1, -2


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver; tasks get them from there."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"no SentencePiece model at {path}; give the path of one that the driver can read")
    return Path(path).read_bytes()


def gathered(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - sizes), sizes)]


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a message in protocol buffer form."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class MergeVocabulary:
    """Pieces, scores and rules of a model file.

    A *symbol* is a piece, or a code point that occurs in pieces but is none; its number is
    the piece's id or one above all ids.
    """

    def __init__(self, model: bytes) -> None:
        parts: dict[int, list] = {PIECES: [], TRAINER: [b""], NORMALIZER: [b""]}
        for number, value in _fields(model):
            parts.setdefault(number, []).append(value)
        trainer, rules = dict(_fields(parts[TRAINER][-1])), dict(_fields(parts[NORMALIZER][-1]))
        self.prefix = bool(rules.get(3, 1))
        if trainer.get(3, 1) != MERGE_MODEL or trainer.get(24) or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only merge-type vocabularies over unchanged text with escaped spaces are supported")
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i, piece in enumerate(parts[PIECES]):
            field = dict(_fields(piece))
            text, kind = field[1].decode(), field.get(3, NORMAL)
            if kind == NORMAL:
                self.ids[text] = i
                self.scores[text] = float(np.frombuffer(field.get(2, bytes(4)), "<f4")[0])
                self.bytes_of.append(text.replace(SPACE, " ").encode())
            elif kind == BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            elif kind in (UNKNOWN, CONTROL):
                self.bytes_of.append(" ⁇ ".encode() if kind == UNKNOWN else b"")
            else:
                raise ValueError(f"piece {text!r} is of a kind that is not supported")
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no piece for every byte")
        crossing = any(SPACE in text.lstrip(SPACE) for text in self.ids)
        self.stretch = re.compile("(?s).+" if crossing else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.byte_sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_begin = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._forget()
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Tables by symbol number: of code points, and of pairs that make a piece."""
        size = len(self.bytes_of)
        number = dict(self.ids)
        for c in sorted(set("".join(self.ids)) - set(self.ids)):
            number[c] = size + len(number) - len(self.ids)
        self.base = size + len(number) - len(self.ids)
        self.symbol_of = np.full(0x110000, UNHEARD, np.int64)
        for text, i in number.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        pairs = [
            (number[text[:k]] * self.base + number[text[k:]], i, self.scores[text])
            for text, i in self.ids.items()
            for k in range(1, len(text))
            if text[:k] in number and text[k:] in number
        ]
        # An open-addressed table: a pair lies in its slot or in the next free one after it.
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), 1 << bits
        self.pair_keys = np.full(self.slots, -1, np.int64)
        self.pair_pieces = np.zeros(self.slots, np.int64)
        self.pair_scores = np.full(self.slots, NONE)
        slots = self._slot(np.array([key for key, _, _ in pairs], np.int64)).tolist()
        for at, (key, piece, score) in zip(slots, pairs):
            while self.pair_keys[at] >= 0:
                at = (at + 1) % self.slots
            self.pair_keys[at], self.pair_pieces[at], self.pair_scores[at] = key, piece, score

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and piece of each pair of symbols; minus infinity where they make none."""
        key = left * self.base + right
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        found = self.pair_keys[at]
        other = np.flatnonzero((found != key) & (found >= 0))
        while len(other):
            at.flat[other] = (at.flat[other] + 1) % self.slots
            there = self.pair_keys[at.flat[other]]
            other = other[(there != key.flat[other]) & (there >= 0)]
        fits = self.pair_keys[at] == key
        return np.where(fits, self.pair_scores[at], NONE), self.pair_pieces[at]

    def _bytes_where_unknown(self, symbols: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in symbols:
            i = self.ids.get(symbol)
            out += [i] if i is not None else [self.byte_ids[b] for b in symbol.encode()]
        return tuple(out)

    def merge(self, stretch: str) -> tuple[int, ...]:
        """Ids of one stretch, by a heap of its symbol pairs."""
        symbols, scores = list(stretch), self.scores
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            score = scores.get(symbols[i] + symbols[i + 1])
            if score is not None:
                agenda.append((-score, i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, ""
            beyond = after[left] = after[right]
            if beyond < n:
                before[beyond] = left
            for i, j in ((before[left], left), (left, beyond)):
                if i >= 0 and j < n:
                    piece = symbols[i] + symbols[j]
                    score = scores.get(piece)
                    if score is not None:
                        heappush(agenda, (-score, i, j, len(piece)))
        return self._bytes_where_unknown([s for s in symbols if s])

    def merge_all(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short stretches in a row, and how many each has; those of like length are merged together."""
        lengths = np.array([len(s) for s in stretches], np.int64)
        order = np.argsort(lengths, kind="stable")
        sizes, ids = np.zeros(len(stretches), np.int64), [np.zeros(0, np.int64)]
        cuts = np.searchsorted(lengths[order], [0, 6, 9, 13, 20, 32, 1 << 62])
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                own, sizes[order[a:b]] = self._merge_rows([stretches[i] for i in order[a:b].tolist()], lengths[order[a:b]])
                ids.append(own)
        sorted_sizes = sizes[order]
        begin = np.empty(len(stretches), np.int64)
        begin[order] = np.cumsum(sorted_sizes) - sorted_sizes
        return gathered(np.concatenate(ids), begin, sizes), sizes

    def _merge_rows(self, stretches: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One stretch a row; in each round every row merges the head of its agenda.

        ``score`` has the agenda of a row: at a symbol's column, the score of it and its right
        neighbour. The first of the largest is the head. The last column stands for the place
        before the first symbol and after the last one.
        """
        n, width = len(stretches), int(sizes.max())
        used = np.arange(width + 1) < sizes[:, None]
        points = np.zeros((n, width + 1), np.int64)
        points[used] = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbol = np.where(used, self.symbol_of[points], ABSENT)
        after = np.where(np.arange(1, width + 2) < sizes[:, None], np.arange(1, width + 2), width)
        before = np.tile(np.append(width, np.arange(width)), (n, 1))
        score, piece = np.full((n, width + 1), NONE), np.zeros((n, width + 1), np.int64)
        score[:, :-1], piece[:, :-1] = self._pairs(symbol[:, :-1], symbol[:, 1:])
        rows = np.arange(n)
        while True:
            head = score[rows].argmax(1)
            going = score[rows, head] > NONE
            rows, head = rows[going], head[going]
            if not len(rows):
                break
            gone = after[rows, head]
            symbol[rows, head] = piece[rows, head]
            symbol[rows, gone], score[rows, gone] = ABSENT, NONE
            right = after[rows, gone]
            after[rows, head], before[rows, right] = right, head
            left = before[rows, head]
            score[rows, head], piece[rows, head] = self._pairs(symbol[rows, head], symbol[rows, right])
            score[rows, left], piece[rows, left] = self._pairs(symbol[rows, left], symbol[rows, head])
            score[rows, width] = NONE
        present = symbol > ABSENT
        ids, counts, spelt = symbol[present], present.sum(1), points[present]
        odd = np.flatnonzero((ids < 0) | (ids >= len(self.bytes_of)))
        if len(odd):
            each = {i: [self.byte_ids[b] for b in chr(spelt[i]).encode()] for i in odd.tolist()}
            times = np.ones(len(ids), np.int64)
            times[odd] = [len(x) for x in each.values()]
            row = np.repeat(np.arange(n), counts)
            counts = np.bincount(row, times, n).astype(np.int64)
            put = np.repeat(times > 1, times)
            put[(np.cumsum(times) - times)[odd]] = True
            ids = np.repeat(ids, times)
            ids[put] = list(chain.from_iterable(each.values()))
        return ids, counts

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, without begin and end, and how many each text has."""
        front = SPACE if self.prefix else ""
        parts = [self.stretch.findall(front + text.replace(" ", SPACE)) if text else [] for text in texts]
        words = list(chain.from_iterable(parts))
        if len(self.known) > REMEMBERED:
            self._forget()
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(number < 0).tolist()
        if missing:
            self._remember(list(dict.fromkeys(map(words.__getitem__, missing))))
            number[missing] = list(map(self.known.__getitem__, map(words.__getitem__, missing)))
        sizes = self.sizes[number]
        ends = np.append(0, np.cumsum(sizes))
        ids = gathered(self.flat, self.begin[number], sizes)
        return ids, np.diff(ends[np.cumsum([0, *map(len, parts)])])

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.begin, self.sizes = (np.zeros(0, np.int64) for _ in range(3))

    def _remember(self, stretches: list[str]) -> None:
        """Merge stretches and keep their ids by number."""
        short = [s for s in stretches if len(s) <= SHORT]
        long = [s for s in stretches if len(s) > SHORT]
        ids, sizes = self.merge_all(short)
        merged = [self.merge(s) for s in long]
        sizes = np.append(sizes, [len(m) for m in merged]).astype(np.int64)
        self.known.update(zip(short + long, range(len(self.sizes), len(self.sizes) + len(sizes))))
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(sizes) - sizes)
        self.flat = np.concatenate([self.flat, ids, *map(np.array, merged)]).astype(np.int64)
        self.sizes = np.append(self.sizes, sizes)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids in a row; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.byte_sizes[ids]
        data = gathered(self.piece_bytes, self.byte_begin[ids], sizes).tobytes()
        cut = np.append(0, np.cumsum(sizes))[np.cumsum(np.append(0, counts))].tolist()
        skip = 1 if self.prefix else 0
        return [data[a + (skip and data[a : min(b, a + 1)] == b" ") : b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0]


@lru_cache(maxsize=2)
def vocabulary_and_library(model: bytes):
    """The vocabulary, and the library's processor to compare with; read once per worker."""
    from sentencepiece import SentencePieceProcessor

    return MergeVocabulary(model), SentencePieceProcessor(model_proto=model)


def row_chunks(batch: pa.RecordBatch, column: int, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, of whole rows."""
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
    ends, at = np.cumsum(lengths), 0
    while at < batch.num_rows:
        start = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, start + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document ``doc_id, ids, decoded, agrees``; ``decoded`` is the text that the ids stand for."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one file of a fixed vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, library = vocabulary_and_library(shared.value)
        for batch in batches:
            for rows in row_chunks(batch, 1):
                texts = rows.column(1).fill_null("").to_pylist()
                flat, counts = vocabulary.encode_all(texts)
                decoded = vocabulary.decode_all(flat, counts)
                ends = np.cumsum(np.append(0, counts))
                numbers, cut = flat.tolist(), ends.tolist()
                ids = [numbers[a:b] for a, b in zip(cut, cut[1:])]
                same_ids = [a == b for a, b in zip(ids, library.encode(texts, num_threads=1))]
                same_text = [a == b for a, b in zip(decoded, library.decode(ids, num_threads=1))]
                yield pa.record_batch(
                    [
                        rows.column(0),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32))),
                        pa.array(decoded, pa.string()),
                        pa.array([a and b for a, b in zip(same_ids, same_text)], pa.bool_()),
                    ],
                    names=["doc_id", "ids", "decoded", "agrees"],
                )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(encode, ENCODED)
