"""Byte-level BPE: pre-tokenisation by scans over character classes, cached pair merging, decoding.

The places where one piece of text ends and the next begins are found without a regular expression.
Each character has a class (letter, number, blank, ...) from an array over all code points; class
and the two characters after it give a symbol; each symbol is a function on eight states ("in a run of
letters", "after a joining blank", ...). Functions compose associatively and only a few dozen
compositions exist, so the state before every character comes from a blocked prefix scan over small
numbers, many texts at a time. A piece begins where the table of starts has (state, symbol). Long
texts are scanned in parts, with the state handed on.

Pieces are merged by rank, lowest first, leftmost of equal ones, and remembered. Token numbers are
kept as little-endian 32-bit integers, with the byte offset of each token, so that any range of
tokens can be decoded on its own.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.llm.support import kept_in_worker, slices, trimmed

# ---- character classes ----------------------------------------------------------------

LETTER, NUMBER, OTHER, SPACE, BLANK, END = range(6)
CODE_POINTS = 0x110000

#: Characters of a text that are scanned at a time.
PART = 1 << 19
#: Pieces a worker remembers the tokens of, and the longest that it remembers.
CACHE_PIECES, CACHE_LENGTH = 200_000, 64


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point, as the reference tokeniser library itself has it.

    The library's tables decide what is a letter, a number or white space: all code points are run
    through it once per class.
    """
    ranks = {bytes([value]): value for value in range(256)}
    classes = np.full(CODE_POINTS, OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for start in range(0, CODE_POINTS, 1 << 11):
            if not 0xD800 <= start < 0xE000:  # surrogates are no characters
                codes = np.arange(start, start + (1 << 11), dtype="<u4").tobytes().decode("utf-32-le")
                text = bytes(found.encode_ordinary(codes)).decode()
                classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)] = kind
    classes[ord(" ")] = SPACE
    return classes


# ---- transition functions ---------------------------------------------------------------

# States: what stands before a character.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, JOINING, SHORT_1, SHORT_2 = range(8)
# Symbols: the class, with what the next characters make of it.
#   SHORT2, SHORT3  an apostrophe that begins 's 't 'm 'd, or 're 've 'll
#   JOIN            a space before a character that is not blank: it begins that character's piece
#   ALONE           another blank in that place: a piece of its own
#   RUN             a blank before a blank or the end
L, N, O, SHORT2, SHORT3, JOIN, ALONE, RUN = range(8)
SYMBOLS, STATES = 8, 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece begins at the character)."""
    if symbol == L:
        if state in (SHORT_1, SHORT_2):
            return (FRESH if state == SHORT_1 else SHORT_1), False
        return IN_LETTERS, state not in (IN_LETTERS, JOINING)
    if symbol == N:
        return IN_NUMBERS, state not in (IN_NUMBERS, JOINING)
    if symbol in (O, SHORT2, SHORT3):
        if state in (IN_OTHERS, JOINING):
            return IN_OTHERS, False
        return {O: IN_OTHERS, SHORT2: SHORT_1, SHORT3: SHORT_2}[symbol], True
    if symbol == JOIN:
        return JOINING, True
    if symbol == ALONE:
        return FRESH, True
    return IN_BLANKS, state != IN_BLANKS


class Transitions:
    """All compositions of the symbols' functions, numbered, with the table of their products.

    Symbols 8 to 15 are the same at the first character of a text: whatever the state, they begin
    afresh.
    """

    def __init__(self):
        plain = [tuple(_step(state, symbol)[0] for state in range(STATES)) for symbol in range(SYMBOLS)]
        first = [(_step(FRESH, symbol)[0],) * STATES for symbol in range(SYMBOLS)]
        identity = tuple(range(STATES))
        number = {identity: 0}
        functions, at = [identity], 0
        generators = plain + first
        while at < len(functions):  # closure under composition
            for generator in generators:
                product = tuple(generator[state] for state in functions[at])
                if product not in number:
                    number[product] = len(functions)
                    functions.append(product)
            at += 1
        self.count = len(functions)
        self.of_symbol = np.array([number[function] for function in generators], dtype=np.uint8)
        self.apply = np.array(functions, dtype=np.uint8)
        self.compose = np.array(
            [[number[tuple(g[state] for state in f)] for g in functions] for f in functions], dtype=np.uint8
        )
        starts = [[_step(state, symbol)[1] for symbol in range(SYMBOLS)] for state in range(STATES)]
        self.starts = np.array([row + [True] * SYMBOLS for row in starts])

    def scan(self, functions: np.ndarray) -> np.ndarray:
        """Inclusive prefix products. In blocks: down all blocks at once, then over block totals."""
        size = len(functions)
        if size <= 64:
            out, total = np.empty_like(functions), 0
            for i in range(size):
                total = self.compose[total, functions[i]]
                out[i] = total
            return out
        block = 64 if size < 1 << 14 else 256
        rows = -(-size // block)
        padded = np.zeros(rows * block, dtype=np.uint8)
        padded[:size] = functions
        columns = np.ascontiguousarray(padded.reshape(rows, block).T)
        flat, count = self.compose.ravel(), np.intp(self.count)
        for i in range(1, block):
            columns[i] = flat[columns[i - 1] * count + columns[i]]
        totals = self.scan(columns[-1].copy())
        before = np.concatenate((np.zeros(1, np.uint8), totals[:-1]))
        columns = flat[before[None, :] * count + columns]
        return columns.T.reshape(-1)[:size]


@lru_cache(maxsize=1)
def transitions() -> Transitions:
    return Transitions()


def _symbols(codes: np.ndarray, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol of each character. `codes` ends with two characters of what follows, or zeros;
    `ends` are the places of texts' last characters."""
    size = len(codes) - 2
    kinds = classes[codes[:size]]
    one, two = codes[1 : size + 1].copy(), codes[2:].copy()
    following = classes[one]
    following[ends] = END
    one[ends] = 0
    two[ends] = 0
    two[ends[ends > 0] - 1] = 0
    symbols = np.array([L, N, O, RUN, RUN, RUN], dtype=np.uint8)[kinds]
    last = (kinds >= SPACE) & (following < SPACE)
    symbols[last] = np.where(kinds[last] == SPACE, JOIN, ALONE)
    quotes = np.flatnonzero(codes[:size] == ord("'"))
    if len(quotes):
        after, then = one[quotes], two[quotes]
        short = np.isin(after, [ord(c) for c in "stmd"])
        long = ((after == ord("r")) | (after == ord("v"))) & (then == ord("e"))
        long |= (after == ord("l")) & (then == ord("l"))
        symbols[quotes] = np.where(short, SHORT2, np.where(long, SHORT3, O))
    return symbols


def piece_starts(
    codes: np.ndarray, firsts: np.ndarray, ends: np.ndarray, state: int = FRESH
) -> tuple[np.ndarray, int]:
    """Where pieces begin in `codes` (see `_symbols`), and the state after its last character.

    `firsts` and `ends` are the places of the first and last characters of the texts in it.
    """
    table = transitions()
    symbols = _symbols(codes, character_classes(), ends)
    symbols[firsts] += SYMBOLS
    after = table.apply[table.scan(table.of_symbol[symbols]), state]
    before = np.concatenate((np.array([state], dtype=np.uint8), after[:-1]))
    return np.flatnonzero(table.starts[before, symbols]), int(after[-1]) if len(after) else state


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


_NOTHING = np.zeros(2, dtype=np.uint32)


def split_texts(texts: list[str]) -> Iterator[list[str]]:
    """The pieces of each text, all texts scanned at once."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    filled = lengths > 0
    firsts, ends = bounds[:-1][filled], bounds[1:][filled] - 1
    starts, _ = piece_starts(np.concatenate((_codes(whole), _NOTHING)), firsts, ends)
    places = np.append(starts, len(whole))
    cuts = np.searchsorted(starts, bounds)
    for a, b in pairwise(cuts.tolist()):
        edges = places[a : b + 1].tolist()
        yield [whole[i:j] for i, j in pairwise(edges)] if b > a else []


def split_long(text: str, part: int = PART) -> Iterator[list[str]]:
    """The pieces of one text, scanned in parts; a piece that a part leaves open goes on in the next."""
    state, open_at = FRESH, 0
    for begin in range(0, len(text), part):
        codes = _codes(text[begin : begin + part + 2])
        size = min(part, len(text) - begin)
        codes = np.concatenate((codes, _NOTHING))[: size + 2]
        final = begin + size == len(text)
        firsts = np.array([0] if begin == 0 else [], dtype=np.int64)
        ends = np.array([size - 1] if final else [], dtype=np.int64)
        starts, state = piece_starts(codes, firsts, ends, state)
        edges = [open_at, *[at for at in (starts + begin).tolist() if at > open_at]]
        open_at = edges[-1]
        yield [text[i:j] for i, j in pairwise(edges)]
    yield [text[open_at:]] if text else []


# ---- merging ------------------------------------------------------------------------------


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token numbers of a piece: adjacent parts of the lowest rank are joined, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    # parts as a linked list of start offsets; a heap holds the ranks of adjacent pairs
    ends = list(range(1, size + 1))
    befores = list(range(-1, size - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(size - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * size
    while heap:
        _, left, stop = heapq.heappop(heap)
        if not alive[left] or ends[left] >= stop:
            continue
        right = ends[left]
        if ends[right] != stop:
            continue
        alive[right] = False
        ends[left] = stop
        if stop < size:
            befores[stop] = left
            rank = ranks.get(piece[left : ends[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, ends[stop]))
        if befores[left] >= 0:
            rank = ranks.get(piece[befores[left] : stop])
            if rank is not None:
                heapq.heappush(heap, (rank, befores[left], stop))
    return [ranks[piece[i : ends[i]]] for i in range(size) if alive[i]]


class Merges(dict):
    """Piece to token numbers as bytes; forgets the later half when full, so memory is bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode(), self.ranks), dtype="<u4").tobytes()
        if len(piece) <= CACHE_LENGTH:
            trimmed(self, CACHE_PIECES)
            self[piece] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file with a base64 token and its number on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Encodes and decodes with the ranks of one file."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.merges = Merges(ranks)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(token) for token in self.tokens], dtype=np.int64)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Token numbers of each text as bytes."""
        group: list[str] = []
        size, known = 0, self.merges.__getitem__
        for text in [*texts, None]:
            if group and (text is None or size + len(text) > PART):
                for pieces in split_texts(group):
                    yield b"".join(map(known, pieces))
                group, size = [], 0
            if text is None:
                return
            if len(text) > PART:
                yield b"".join(b"".join(map(known, pieces)) for pieces in split_long(text))
            else:
                group.append(text)
                size += len(text)

    def offsets(self, ids: bytes) -> bytes:
        """The byte offset of each token in the text, as 32-bit integers: no text has 4 GB."""
        lengths = self.lengths[np.frombuffer(ids, dtype="<u4")]
        return (np.cumsum(lengths) - lengths).astype("<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def codec(path: str) -> Codec:
    """One per worker and file, so that its memory of pieces outlives a task."""
    return kept_in_worker(("byte_bpe", path), lambda: Codec(path))


def with_tokens(
    docs: DataFrame,
    path: str,
    text_column: str = "text",
    ids: str = "ids",
    offsets: str | None = "offsets",
    decoded: str | None = None,
) -> DataFrame:
    """`docs` with the tokens of a text in place of it: `ids`, and the byte `offsets` of each unless None.

    Both are little-endian unsigned 32-bit integers. Null counts as empty; an empty text has no tokens.
    `decoded`, if given, names a column of the bytes that the ids stand for, as `with_decoded` adds it
    to tokens read from elsewhere; done here, a core needs one worker with its tables instead of two.
    All rows and other columns stay; the names added must be new.
    """
    kept = [name for name in docs.columns if name != text_column]
    added = [name for name in (ids, offsets, decoded) if name]
    if {name.lower() for name in kept} & {name.lower() for name in added}:
        raise ValueError(f"docs already has a column of {added}")
    rows = docs.select(F.col(text_column).alias(text_column), *[F.col(name) for name in kept])
    schema = T.StructType([docs.schema[name] for name in kept] + [T.StructField(x, T.BinaryType()) for x in added])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, 0):
                found = list(own.encode([text or "" for text in part.column(0).to_pylist()]))
                columns = [*part.columns[1:], pa.array(found, pa.binary())]
                if offsets:
                    columns.append(pa.array(map(own.offsets, found), pa.binary(), size=len(found)))
                if decoded:
                    columns.append(pa.array(map(own.decode, found), pa.binary(), size=len(found)))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    return rows.mapInArrow(encode, schema)


def with_decoded(tokens: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`tokens` with the bytes that the column `ids` stands for as the new column `decoded`; null stays null."""
    if decoded.lower() in {name.lower() for name in tokens.columns}:
        raise ValueError(f"tokens already has a column {decoded}")
    names, at = tokens.columns, tokens.columns.index(ids)
    schema = T.StructType([*tokens.schema.fields, T.StructField(decoded, T.BinaryType())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in slices(batch, at):
                found = [None if row is None else own.decode(row) for row in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*names, decoded])

    return tokens.mapInArrow(decode, schema)


def decode_range(ids: bytes, offsets: bytes, path: str, first: int, last: int) -> tuple[int, bytes]:
    """Where tokens `first` to `last` (without it) begin in the text, and their bytes."""
    places = np.frombuffer(offsets, dtype="<u4")
    part = ids[4 * first : 4 * last]
    begin = int(places[first]) if first < len(places) else 0
    return begin, codec(path).decode(part)
