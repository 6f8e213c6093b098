"""SentencePiece model files: the protobuf read by hand, and byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import heapq
import re
import struct
from dataclasses import dataclass, field

MARK = "▁"
# Piece types and model types of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Pieces hold the mark at their start only, or nothing but marks, so text may be cut before a mark that follows
# another character. Read from the model by ``cuttable``.
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass
class PieceModel:
    """Pieces in the order of their identifiers, and the settings that change results."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    add_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True
    normaliser: str = "identity"
    charsmap: bytes = b""
    rank: dict[str, float] = field(default_factory=dict)
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)
    unk: int = 0

    def __post_init__(self):
        for i, (piece, kind) in enumerate(zip(self.pieces, self.types)):
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError(f"piece {piece!r}: user-defined and unused pieces are not handled")
            if kind == NORMAL:
                self.ids[piece] = i
                self.rank[piece] = -self.scores[i]
            elif kind == UNKNOWN:
                self.unk = i
        self.byte_ids = [i for i, kind in enumerate(self.types) if kind == BYTE]
        if self.byte_fallback and len(self.byte_ids) != 256:
            raise ValueError("byte fallback needs 256 byte pieces")

    @property
    def cuttable(self) -> bool:
        return not any(MARK in piece.lstrip(MARK) for piece in self.ids)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(number, value) of each field of a message; value: int or bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"wire type {kind} isn't used by model files")
        yield tag >> 3, value


def parse_model(data: bytes) -> PieceModel:
    """The model in a ``.model`` file. Only identity normalisation is rebuilt; others raise."""
    pieces, scores, types, trainer, normal = [], [], [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own[1].decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            types.append(own.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    model = PieceModel(
        pieces, scores, types, kind=trainer.get(3, UNIGRAM), byte_fallback=bool(trainer.get(35, 0)),
        add_prefix=bool(normal.get(3, 1)), squeeze_spaces=bool(normal.get(4, 1)), escape_spaces=bool(normal.get(5, 1)),
        normaliser=normal.get(1, b"").decode() or "identity", charsmap=normal.get(2, b""))
    if model.charsmap or not model.escape_spaces or trainer.get(24, 0):
        raise ValueError(f"the normaliser {model.normaliser} isn't rebuilt here")
    return model


def normalised(model: PieceModel, text: str) -> str:
    """The text as the model sees it: marks for spaces, one before it."""
    if model.squeeze_spaces:
        text = re.sub(" +", " ", text.strip(" "))
    return (MARK if model.add_prefix else "") + text.replace(" ", MARK) if text else ""


def merged(model: PieceModel, word: str) -> tuple[list[str], int]:
    """The final symbols of ``word`` and the number of merges.

    The heap holds (rank, left position) of adjacent pairs whose joint text is a piece; symbols are a doubly
    linked list. An entry whose pair has changed meanwhile is left out. Equal ranks: the leftmost goes first.
    """
    rank, symbols = model.rank, list(word)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = rank.get(symbols[i] + symbols[i + 1])
        if r is not None:
            heap.append((r, i))
    heapq.heapify(heap)
    merges, pop, push = 0, heapq.heappop, heapq.heappush
    while heap:
        r, i = pop(heap)
        left = symbols[i]
        if left is None or (j := after[i]) >= n:
            continue
        joint = left + symbols[j]
        if rank.get(joint) != r:
            continue
        merges += 1
        symbols[i], symbols[j] = joint, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = rank.get(joint + symbols[k])
            if r is not None:
                push(heap, (r, i))
        h = before[i]
        if h >= 0:
            r = rank.get(symbols[h] + joint)
            if r is not None:
                push(heap, (r, h))
    return [s for s in symbols if s is not None], merges


def count_word(model: PieceModel, word: str) -> int:
    """Tokens of a word: its initial symbols less the merges.

    A character that is no piece stands for its UTF-8 bytes (one unknown token without byte fallback).
    """
    symbols, merges = merged(model, word)
    tokens = len(word) - merges
    for s in symbols:
        if s not in model.ids and model.byte_fallback:
            tokens += len(s.encode()) - 1
    return tokens


def encode_word(model: PieceModel, word: str) -> list[int]:
    ids: list[int] = []
    for s in merged(model, word)[0]:
        i = model.ids.get(s)
        if i is not None:
            ids.append(i)
        elif model.byte_fallback:
            ids.extend(model.byte_ids[b] for b in s.encode())
        else:
            ids.append(model.unk)
    return ids


class WordCounts(dict):
    """Token counts of words met so far; emptied at ``most`` entries, so memory stays bounded."""

    def __init__(self, model: PieceModel, most: int = 300_000, longest: int = 48):
        super().__init__()
        self.model, self.most, self.longest = model, most, longest
        self.cuttable = model.cuttable

    def __missing__(self, word: str) -> int:
        n = count_word(self.model, word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = n
        return n

    def total(self, text: str) -> int:
        text = normalised(self.model, text)
        words = WORD.findall(text) if self.cuttable else [text] if text else []
        return sum(map(self.__getitem__, words))
