"""Byte-level BPE through an index from each pair of symbols to all its positions."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from seriesmill.llm.common import pick, texts

#: Distinct pieces that one index holds, and encoded chunks that a task remembers before it starts over. Both bound
#: memory only: what is forgotten is encoded again.
INDEX_PIECES = 500_000
REMEMBERED = 700_000

# Fixed value: how this tokenizer family cuts text into pieces before merging.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files: itself where it is printable Latin-1,
    else the next unused code point from 256 on."""
    shown = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@dataclass
class Codec:
    """Encoder and decoder of one vocabulary file, with what it has encoded so far."""

    path: str
    spelled: dict[int, bytes] = field(default_factory=dict)
    specials: dict[str, int] = field(default_factory=dict)
    known: dict[str, bytes] = field(default_factory=dict)
    pieces: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        with open(self.path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, shown = spec["model"]["vocab"], byte_characters()
        self.symbols = np.array([vocabulary[c] for c in shown], np.int64)
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in spec["model"]["merges"]]
        self.rules = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        keys = np.array([a << 32 | b for a, b, _ in self.rules], np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.pairs = keys[self.ranks]
        number = {c: b for b, c in enumerate(shown)}
        self.spelled = {i: bytes(number[c] for c in token) for token, i in vocabulary.items() if all(c in number for c in token)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelled.update({i: token.encode() for token, i in self.specials.items()})
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or "(?!)")

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or -1."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], -1)

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct pieces, and where those of each piece begin (and, last, the end).

        All pieces lie in one row of symbols. ``places`` maps each pair, named by its rank, to its positions. The
        active pair of lowest rank is merged at all its positions at once, which adds the pairs that this makes to
        the left and right, until no pair is left.
        """
        spelled = [piece.encode() for piece in pieces]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        symbols = self.symbols[np.frombuffer(b"".join(spelled), np.uint8)]
        n = len(symbols)
        ahead, behind = np.arange(1, n + 1), np.arange(-1, n - 1)
        ahead[starts[1:] - 1] = behind[starts[:-1]] = -1
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(at: np.ndarray, right: np.ndarray) -> None:
            ranks = self.rank(symbols[at], symbols[right])
            found = np.flatnonzero(ranks >= 0)
            if not len(found):
                return
            at, ranks = at[found], ranks[found]
            if len(found) > 1:
                order = np.argsort(ranks, kind="stable")
                at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            edges = [0, *cuts.tolist(), len(ranks)]
            for lo, hi, rank in zip(edges, edges[1:], ranks[edges[:-1]].tolist()):
                if rank in places:
                    places[rank].append(at[lo:hi])
                else:
                    places[rank] = [at[lo:hi]]
                    heapq.heappush(queue, rank)

        first = np.flatnonzero(ahead >= 0)
        add(first, first + 1)
        while queue:
            rank = heapq.heappop(queue)
            a, b, new = self.rules[rank]
            lists = places.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            after = ahead[at]
            valid = (symbols[at] == a) & (after >= 0)
            valid &= symbols[after] == b
            at, after = at[valid], after[valid]
            if a == b and len(at) > 1:  # a run of equal symbols pairs up from its left
                taken, gone = [], -1
                for k, (x, y) in enumerate(zip(at.tolist(), after.tolist())):
                    if x != gone:
                        taken.append(k)
                        gone = y
                at, after = at[taken], after[taken]
            if not len(at):
                continue
            far = ahead[after]
            symbols[at], symbols[after], ahead[at] = new, -1, far
            inner = far >= 0
            behind[far[inner]] = at[inner]
            before = behind[at]
            outer = before >= 0
            add(np.concatenate([at[inner], before[outer]]), np.concatenate([far[inner], at[outer]]))
        left = symbols >= 0
        return symbols[left].astype("<u4"), np.concatenate([[0], np.cumsum(left)])[starts]

    def learn(self, chunks: set[str]) -> None:
        """Encode new chunks of text, each free of effects on its neighbours."""
        cut = {chunk: PIECES.findall(chunk) for chunk in chunks}
        new = list({piece for found in cut.values() for piece in found if piece not in self.pieces})
        for lo in range(0, len(new), INDEX_PIECES):
            part = new[lo:lo + INDEX_PIECES]
            ids, starts = self.merge(part)
            ids, starts = ids.tobytes(), (starts * 4).tolist()
            self.pieces.update((piece, ids[x:y]) for piece, x, y in zip(part, starts, starts[1:]))
        pieces = self.pieces
        self.known.update((chunk, b"".join([pieces[piece] for piece in found])) for chunk, found in cut.items())

    def chunks(self, text: str) -> list[str]:
        """Cut so that each chunk is encoded alike alone and in place: before each space, unless white space
        follows white space there, which the pieces' expression looks ahead over. The vocabulary's special tokens
        are chunks of their own."""
        parts, at = [], 0
        for m in self.special.finditer(text) if any(token in text for token in self.specials) else ():
            parts += [*self.chunks(text[at:m.start()]), m.group()]
            at = m.end()
        rest = text[at:]
        if rest.startswith(" ") or rest.endswith(" ") or "  " in rest:
            return parts + PIECES.findall(rest)
        return parts + rest.replace(" ", "\0 ").split("\0") if "\0" not in rest else parts + PIECES.findall(rest)

    def encode(self, batch: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit integers; special tokens are found in texts."""
        new: set[str] = set()
        for text in batch:
            new.update(self.chunks(text))
        new -= self.known.keys()
        new -= self.specials.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            self.pieces.clear()
            new = {chunk for text in batch for chunk in self.chunks(text)} - self.specials.keys()
        self.learn(new)
        self.known.update((token, np.uint32(i).astype("<u4").tobytes()) for token, i in self.specials.items())
        known = self.known
        for text in batch:
            yield b"".join([known[chunk] for chunk in self.chunks(text)])

    def decode(self, ids: bytes) -> str:
        spelled = self.spelled
        return b"".join([spelled[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", errors="replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per vocabulary file in each Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def some(ids: list, batch: list[str], most: int = 24_000_000) -> Iterator[tuple[list, list[str]]]:
    """A batch in runs of at most ``most`` characters, or one text."""
    lo, held = 0, 0
    for k, text in enumerate(batch):
        if held and held + len(text) > most:
            yield ids[lo:k], batch[lo:k]
            lo, held = k, 0
        held += len(text)
    yield ids[lo:], batch[lo:]


def coded(documents: DataFrame, vocabulary: str, keep_text: bool = True) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): n_tokens, ids (little-endian unsigned 32-bit integers) and,
    with ``keep_text``, decoded; without it, the SHA-256 of both instead, which is all that a check of the round trip
    needs.

    Nulls count as empty texts, empty texts have no ids, doc_id may be null or repeated, other columns are ignored.
    A text is held whole, as its row is; beside it a task remembers a bounded number of encoded chunks.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for all_ids, all_texts in texts(batches):
            for doc_ids, batch in some(all_ids, all_texts):
                ids = list(own.encode(batch))
                decoded = [own.decode(x) for x in ids]
                first = [pa.array(doc_ids, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if keep_text:
                    yield pa.RecordBatch.from_arrays([*first, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                                     ["doc_id", "n_tokens", "ids", "decoded"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*first, pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                         pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = SCHEMA if keep_text else "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return pick(documents, "doc_id", "text").mapInArrow(run, schema)
