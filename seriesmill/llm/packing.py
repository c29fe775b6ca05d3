"""Packing token sequences: overlong documents are cut into full windows, the rest goes best-fit decreasing."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from seriesmill.llm.common import in_parts, pick, texts

WINDOW = 2048
END = 1
#: Rests that are packed together and the tokens they may hold; more are packed in several rounds of a task.
PACK_ITEMS, PACK_TOKENS = 60_000, 40_000_000
#: Likewise where their ids are held as well.
PACK_IDS = 8_000_000
#: Bytes of text that are encoded at a time, and rows handed on at a time, or fewer where they hold so many tokens of ids.
PART_BYTES, ROWS, ROWS_IDS = 1_000_000, 4_000, 500_000
#: Pieces that a worker remembers before it starts over, with as many of those before at hand; of words, that are cut one by
#: one, half as many. Bounds memory only.
REMEMBERED = 150_000

# How the tokenizer of words cuts lower case, in printable ASCII and in characters of which it is known that
# Python's classes are the tokenizer's.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
# Fixed value: the characters by which byte-level tokenizers spell bytes; printable ones stand for themselves.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(SHOWN)))}
#: What is neither printable nor white space where bytes are split.
CONTROLS = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Asked(dict):
    """What a function gives for each key, called once while it is remembered."""

    def __init__(self, ask: Callable) -> None:
        self.ask, self.before = ask, {}

    def __missing__(self, key) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.ask(key)
        self[key] = found
        return found

    def start_over(self, most: int) -> None:
        """Beyond ``most`` keys begin anew; keys in use come back from those before without a call."""
        if len(self) > most:
            self.before = dict(self)
            self.clear()


@dataclass
class WordIds:
    """Ids by the tokenizers library, asked once per distinct piece of a word: no piece spans white space. A text in normal
    form, of characters that Python lowers and classes as the tokenizer does, is cut into pieces as a whole, others word by
    word. Which characters these are the tokenizer is asked once for each that occurs."""

    path: str

    def __post_init__(self) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        tokenize = self.tokenizer.model.tokenize

        def of_piece(piece: str) -> bytes:
            if not (piece.isascii() and piece.isprintable()):
                piece = piece.encode().decode("latin-1").translate(SPELLED)
            return np.array([t.id for t in tokenize(piece)], "<u4").tobytes()

        self.pieces = Asked(of_piece)
        self.alike: set[str] = set()
        self.unlike: set[str] = set()
        self.known = Asked(self.of_word)

    def cut(self, word: str) -> list[str]:
        if word.isascii() and word.isprintable():
            return ASCII_PIECES.findall(word.lower())
        # In characters, not yet spelled in bytes: a piece names its place in the word.
        low = self.tokenizer.normalizer.normalize_str(word)
        return [low[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(low)]

    def same(self, c: str) -> bool:
        """Whether a character is lowered and cut from its neighbours by ``PIECES`` as by the tokenizer."""
        if unicodedata.category(c) == "Cn" or self.tokenizer.normalizer.normalize_str(c) != (" " if c.isspace() else c.lower()):
            return False
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        beside = [text.replace("?", c.lower()) for text in ("a?a", "0?0", "!?!", "??", "'?")]
        return all([text[a:b] for _, (a, b) in cut(text)] == PIECES.findall(text) for text in beside)

    def whole(self, text: str) -> bool:
        """Whether a text, not of plain ASCII alone, may be cut as a whole."""
        held = set(text)
        if not held <= self.alike:
            for c in held - self.alike - self.unlike:
                (self.alike if self.same(c) else self.unlike).add(c)
        return held <= self.alike and unicodedata.is_normalized("NFC", text)

    def of_word(self, raw: bytes) -> bytes:
        word = raw.decode()
        if self.special.search(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.pieces.__getitem__, self.cut(word)))

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text. Splitting bytes cuts at ASCII white space only."""
        for text in batch:
            self.pieces.start_over(REMEMBERED)
            self.known.start_over(REMEMBERED // 2)
            special = self.special.search(text)
            if not special and text.isascii() and not CONTROLS.search(text):
                yield b"".join(map(self.pieces.__getitem__, ASCII_PIECES.findall(text.lower())))
            elif not special and self.whole(text):
                # The tokenizer knows no final sigma.
                yield b"".join(map(self.pieces.__getitem__, PIECES.findall(text.replace("\u03a3", "\u03c3").lower())))
            else:
                yield b"".join(map(self.known.__getitem__, text.encode().split()))


_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


class OpenWindows:
    """A segment tree over remaining capacities: each node counts the open windows below it."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def change(self, capacity: int, by: int) -> None:
        at, counts = capacity + self.leaves, self.counts
        while at:
            counts[at] += by
            at >>= 1

    def put(self, capacity: int, name: int) -> None:
        if capacity:
            self.open[capacity].append(name)
            self.change(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take the open window of least capacity that holds ``length``: (capacity, name)."""
        at, counts = length + self.leaves, self.counts
        if not counts[at]:
            while at > 1 and not (at % 2 == 0 and counts[at + 1]):  # up to where something lies to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if counts[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self.change(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each item, longest first, and how many windows there are; ties keep their order."""
    tree, names, offsets, made = OpenWindows(window), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        found = tree.tightest(length)
        if found is None:
            found = window, made
            made += 1
        capacity, name = found
        names[k], offsets[k] = name, window - capacity
        tree.put(capacity - length, name)
    return names, offsets, made


def packed(documents: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text) placed in sequences of at most ``window`` tokens.

    A document is its ids and one ``end``. It is cut into full windows from its start; each is a sequence of its own.
    The rest is placed among the rests of the same task, so nothing is shuffled and a task holds at most
    ``PACK_ITEMS`` rests or ``PACK_TOKENS`` tokens (``PACK_IDS`` with their ids); what is left open is at most a few windows in each round.
    A sequence_id is the task's number and a count within it. ``with_ids`` adds the ids of each piece
    (little-endian unsigned 32-bit).

    Null and empty texts are one ``end``. Null or repeated doc_ids are packed row by row. Other columns are ignored.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base, made = word_ids(vocabulary), TaskContext.get().partitionId() << 36, 0
        held: list[tuple] = []
        tokens = 0
        rows_out = max(1, min(ROWS, ROWS_IDS // window)) if with_ids else ROWS

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 8
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
            arrays = {n: pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)}
            order = [n for n in names if n != "ids"] + ["ids"] * with_ids
            return pa.RecordBatch.from_arrays([arrays[n] for n in order], order)

        def place() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, tokens
            names, offsets, windows = best_fit(np.array([row[2] for row in held], np.int64), window)
            rows = [(*row, base + made + n, o) for row, n, o in zip(held, names.tolist(), offsets.tolist())]
            made, held, tokens = made + windows, [], 0
            for lo in range(0, len(rows), rows_out):
                yield out(rows[lo:lo + rows_out])

        tail = np.array([end], "<u4").tobytes()
        for doc_ids, batch in texts(in_parts(batches, most=PART_BYTES, rows=10_000)):
            full: list[tuple] = []
            for doc_id, ids in zip(doc_ids, own.encode(batch)):
                ids += tail
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None)
                    if row[2] == window:
                        full.append((*row, base + made, 0))
                        made += 1
                        if len(full) >= rows_out:
                            yield out(full)
                            full = []
                    else:
                        held.append(row)
                        tokens += row[2]
                if len(held) >= PACK_ITEMS or tokens >= (PACK_IDS if with_ids else PACK_TOKENS):
                    yield from place()
            if full:
                yield out(full)
        if held:
            yield from place()

    return pick(documents, "doc_id", "text").mapInArrow(run, SCHEMA + ", ids binary" * with_ids)
