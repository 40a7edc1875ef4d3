"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text starts as its characters, one symbol each. The agenda holds every pair of adjacent symbols whose
joined text is a piece, ordered by the piece's score, the leftmost first among equals; the best pair is
joined, its new neighbours enter the agenda, and pairs that a join has changed are passed over when
they come up. Symbols that are no piece become their UTF-8 bytes.

Two neighbouring characters that stand side by side in no piece are never joined, nor is anything that
spans them, so a text is divided there, and parts that were merged before are looked up: the result is
that of one agenda over the whole text. Spaces are such places (no piece goes on with a space after
another character), and a text is first divided at them.

With ``verify`` the sentencepiece library encodes, batch by batch, every part that was merged, too, and a
difference fails the job; ``same_as_library`` compares whole texts.

Texts are whole, of any length: time grows with n log n in the longest part, memory with a few texts and
a bounded cache. A null text counts as empty; an empty text has the begin and end ids only. Rows are
handled one by one, so repeated rows, empty tables and extra columns need no care; a column with the
name of a result is replaced."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import groupby, pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from salesflow.llm.shipping import resident

# Fixed values of the model format: field numbers, piece types, the mark that stands for a space.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT, _SCORE, _TYPE = 1, 2, 3
_MODEL_TYPE, _BYTE_FALLBACK, _BPE = 3, 35, 2
_CHAR_MAP, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE_SPACES = 2, 3, 4, 5
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BEGIN, _END = "<s>", "</s>"
_SPACE = "▁"
_NO_PREFIX = bytes([_NORMALIZER << 3 | 2, 2, _DUMMY_PREFIX << 3, 0])  # read after the rest of a model

_MAX_MODEL_BYTES = 64 << 20
_CACHE_PARTS = 1 << 19  # in either of two generations
_CACHED_LENGTH = 64
_ROWS = 256  # rows handled at once, of an Arrow batch


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of an encoded message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, message[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """``pieces``: (text, score, type) by id."""

    pieces: list[tuple[str, float, int]]
    dummy_prefix: bool


def read_model(data: bytes) -> Model:
    """The parts of a model file that encoding needs. Models of another type than BPE, without byte
    pieces, with user-defined or unused pieces, or that rewrite characters are refused."""
    pieces: list[tuple[str, float, int]] = []
    trainer: dict[int, int | bytes] = {}
    rules: dict[int, int | bytes] = {_DUMMY_PREFIX: 1, _REMOVE_SPACES: 1, _ESCAPE_SPACES: 1, _CHAR_MAP: b""}
    for field, value in _fields(data):
        if field == _PIECES:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece.get(_SCORE, bytes(4)))[0]
            pieces.append((piece[_TEXT].decode(), score, piece.get(_TYPE, _NORMAL)))
        elif field == _TRAINER:
            trainer |= _fields(value)
        elif field == _NORMALIZER:
            rules |= _fields(value)
    if trainer.get(_MODEL_TYPE) != _BPE or not trainer.get(_BYTE_FALLBACK):
        raise ValueError("not a merge-type vocabulary with byte pieces")
    if rules[_CHAR_MAP] or rules[_REMOVE_SPACES] or not rules[_ESCAPE_SPACES]:
        raise ValueError("the model rewrites texts")
    if {kind for _, _, kind in pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("the model has user-defined or unused pieces")
    return Model(pieces, bool(rules[_DUMMY_PREFIX]))


class Tokenizer:
    """Encodes and decodes single texts. ``data``: the bytes of a model file."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        model = read_model(data)
        self._prefix = _SPACE if model.dummy_prefix else ""
        self._ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind == _NORMAL}
        self._order = {text: -score for text, score, kind in model.pieces if kind == _NORMAL}
        self._bytes = [0] * 256
        self._texts = [b""] * len(model.pieces)
        self._starts_with_space = [False] * len(model.pieces)
        control = {}
        for i, (text, _, kind) in enumerate(model.pieces):
            if kind == _BYTE:
                value = int(text[1:-1], 16)
                self._bytes[value], self._texts[i] = i, bytes([value])
            elif kind == _CONTROL:
                control[text] = i
            else:
                shown = " ⁇ " if kind == _UNKNOWN else text.replace(_SPACE, " ")
                self._texts[i] = shown.encode()
                self._starts_with_space[i] = kind == _NORMAL and text.startswith(_SPACE)
        self._control = frozenset(control.values())
        self._is_byte = frozenset(self._bytes)
        self.begin, self.end = control[_BEGIN], control[_END]
        self._adjacent = {a + b for text in self._ids for a, b in pairwise(text)}
        # a space ends a part if no piece has one after another character
        ends = not any(pair[1] == _SPACE and pair[0] != _SPACE for pair in self._adjacent)
        lone = "".join(c for c in "\t\n\r" if not any(c in pair for pair in self._adjacent))
        self._parts = re.compile(f"{_SPACE}*[^{_SPACE}{lone}]+|{_SPACE}+" + (f"|[{lone}]" if lone else "") if ends else "(?s).+")
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._unchecked: dict[str, tuple[int, ...]] | None = None
        self._library: SentencePieceProcessor | None = None

    def encode(self, text: str | None) -> list[int]:
        """Ids with begin and end."""
        ids = [self.begin]
        self._age()
        if text:
            get, encode = self._cache.get, self._encode_part
            for part in self._parts.findall(self._prefix + text.replace(" ", _SPACE)):
                ids += get(part) or encode(part)
        ids.append(self.end)
        return ids

    def _encode_part(self, part: str) -> tuple[int, ...]:
        known = self._older.get(part)
        if known is not None:
            return self._keep(part, known)
        ids = self._divided(part)
        if self._unchecked is not None:
            self._unchecked[part] = ids
        return self._keep(part, ids)

    def _divided(self, part: str) -> tuple[int, ...]:
        adjacent = self._adjacent
        cuts = [at for at, pair in enumerate(map(add, part, part[1:]), 1) if pair not in adjacent]
        if not cuts:
            return self._merged(part)
        ids: list[int] = []
        for start, stop in pairwise((0, *cuts, len(part))):
            piece = part[start:stop]
            ids += self._cache.get(piece) or self._older.get(piece) or self._keep(piece, self._merged(piece))
        return tuple(ids)

    def _keep(self, part: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(part) <= _CACHED_LENGTH:
            self._cache[part] = ids
        return ids

    def encode_checked(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of texts; the parts that were not looked up are encoded by the library as well."""
        self._unchecked = parts = {}
        found = [self.encode(text) for text in texts]
        self._unchecked = None
        if self._library is None:
            self._library = SentencePieceProcessor(model_proto=self.data + _NO_PREFIX)
        for (part, ids), wanted in zip(parts.items(), self._library.encode(list(parts), num_threads=1), strict=True):
            if list(ids) != wanted:
                raise RuntimeError(f"not encoded as by the library: {part!r}")
        return found

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_library": None}

    def _age(self) -> None:
        """Between texts: what has not been looked up for a generation is forgotten."""
        if len(self._cache) >= _CACHE_PARTS:
            self._older, self._cache = self._cache, {}

    def _merged(self, part: str) -> tuple[int, ...]:
        """The ids of the symbols that are left when no adjacent pair makes a piece."""
        order, n = self._order, len(part)
        end = list(range(1, n + 1))  # where the symbol that starts here ends; 0: joined to another
        before = list(range(-1, n - 1))  # where the symbol before it starts
        agenda = [(order[pair], i, i + 2) for i, pair in enumerate(map(add, part, part[1:])) if pair in order]
        heapify(agenda)
        while agenda:
            _, left, stop = heappop(agenda)
            right = end[left]
            if not right or right >= n or end[right] != stop:
                continue  # a join has changed one of the two
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
                after = end[stop]
                score = order.get(part[left:after])
                if score is not None:
                    heappush(agenda, (score, left, after))
            if left:
                first = before[left]
                score = order.get(part[first:stop])
                if score is not None:
                    heappush(agenda, (score, first, stop))
        ids: list[int] = []
        known, at = self._ids, 0
        while at < n:
            symbol = part[at : end[at]]
            if symbol in known:
                ids.append(known[symbol])
            else:
                ids += [self._bytes[b] for b in symbol.encode("utf-8", "replace")]
            at = end[at]
        return tuple(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids. A run of byte pieces that is no UTF-8 gives U+FFFD for each such byte."""
        first = next((i for i in ids if i not in self._control), None)
        try:
            if not self._control.isdisjoint(ids[1:-1]):  # ends a run of bytes, as other pieces do
                raise ValueError
            text = b"".join(map(self._texts.__getitem__, ids)).decode()
        except ValueError:
            runs = groupby(ids, lambda i: 0 if i in self._is_byte else 2 if i in self._control else 1)
            parts = (b"".join(map(self._texts.__getitem__, run)) for _, run in runs)
            text = "".join(_lenient(part) for part in parts)
        stripped = bool(self._prefix) and first is not None and self._starts_with_space[first]
        return text[1:] if stripped else text


def _lenient(data: bytes) -> str:
    codecs.register_error("one_by_one", lambda e: ("�", e.start + 1))
    return data.decode("utf-8", "one_by_one")


def load(spark: SparkSession, path: str) -> Callable[[], Tokenizer]:
    """A tokenizer for use in tasks. ``path``: a model file, of at most 64 MB, that the driver or all
    of Spark can read; its bytes are broadcast."""
    try:
        with open(path, "rb") as file:
            data = file.read(_MAX_MODEL_BYTES + 1)
    except OSError:
        files = spark.read.format("binaryFile").load(path)
        data = bytes(files.filter(F.col("length") <= _MAX_MODEL_BYTES).select("content").first()["content"])
    if len(data) > _MAX_MODEL_BYTES:
        raise ValueError(f"model file above {_MAX_MODEL_BYTES} bytes: {path}")
    return resident(spark, Tokenizer(data))


def _lists(lists: list[list[int]]) -> pa.ListArray:
    arrays = [np.array(one, dtype=np.int32) for one in lists]
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, dtype=np.int32)])))


# What can be computed of a batch's texts and their ids.
_OUTPUTS: dict[str, tuple[str, Callable[[Tokenizer, list[list[int]]], pa.Array]]] = {
    "ids": ("array<int>", lambda tokenizer, ids: _lists(ids)),
    "packed": ("binary", lambda tokenizer, ids: pa.array([np.array(i, "<u4").tobytes() for i in ids], pa.binary())),
    "n_tokens": ("long", lambda tokenizer, ids: pa.array(list(map(len, ids)), pa.int64())),
    "decoded": ("string", lambda tokenizer, ids: pa.array(list(map(tokenizer.decode, ids)), pa.string())),
}


def encode(
    docs: DataFrame,
    tokenizer: Callable[[], Tokenizer],
    outputs: tuple[str, ...] = ("ids",),
    *,
    text_col: str = "text",
    verify: bool = True,
) -> DataFrame:
    """``docs`` with the chosen columns: ``ids`` with begin and end, array<int>; ``packed``, the ids as
    unsigned 32-bit integers, the low byte first, as training files hold them; ``n_tokens``; ``decoded``,
    the text that the ids give. A text column is read as a string."""
    kept = [c for c in docs.columns if c not in outputs and c != text_col]
    keep_text = text_col not in outputs
    text = F.col(text_col).cast("string").alias("_text")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept or (keep_text and f.name == text_col)]
    kinds += [f"{name} {_OUTPUTS[name][0]}" for name in outputs]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = tokenizer()
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(start, _ROWS)
                texts = rows["_text"].to_pylist()
                ids = ours.encode_checked(texts) if verify else list(map(ours.encode, texts))
                columns = {name: rows[name] for name in rows.schema.names if name != "_text"}
                columns |= {name: _OUTPUTS[name][1](ours, ids) for name in outputs}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    wanted = [c for c in docs.columns if c in kept or (keep_text and c == text_col)]
    return docs.select(*wanted, text).mapInArrow(of_task, ", ".join(kinds))


def decode(ids: Column | str, tokenizer: Callable[[], Tokenizer]) -> Column:
    """The text of an array of any ids; null stays null."""

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        decode_one = tokenizer().decode
        return pa.array([decode_one(i.as_py()) if i.is_valid else None for i in lists], pa.string())

    return text(ids)


def same_as_library(
    text: Column | str, ids: Column | str, decoded: Column | str, tokenizer: Callable[[], Tokenizer]
) -> Column:
    """Whether the sentencepiece library gives these ids for a text and this text for the ids, batch by
    batch."""

    @F.arrow_udf("boolean")
    def same(texts: pa.Array, lists: pa.Array, decoded: pa.Array) -> pa.Array:
        library = SentencePieceProcessor(model_proto=tokenizer().data)
        found: list[bool] = []
        for start in range(0, len(texts), _ROWS):
            some = [t or "" for t in texts.slice(start, _ROWS).to_pylist()]
            wanted = library.encode(some, add_bos=True, add_eos=True, num_threads=1)
            back = library.decode(wanted, num_threads=1)
            rows = zip(wanted, lists.slice(start, _ROWS), back, decoded.slice(start, _ROWS).to_pylist(), strict=True)
            found += [np.array_equal(w, f.values.to_numpy()) and b == d for w, f, b, d in rows]
        return pa.array(found, pa.bool_())

    return same(text, ids, decoded)
