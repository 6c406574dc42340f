"""SentencePiece BPE ids by a table of prefixes.

Every prefix of a text has one encoding, so also one last token.  The table
stores it: of the tokens that an automaton finds to end at a position, the one
that fits the last token of the prefix before it, where a pair fits if merging
its joined characters gives back the pair.  The ids are then read off backwards.
This is linear in the text and the same as merging the whole text, because a
sequence of tokens is an encoding exactly if all its neighbours fit.

The model file must be BPE without user-defined pieces and with the identity
normalizer, escaped white space and no removal of extra white space.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

#: Words and pairs a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Longer words are not remembered.
LONG_WORD = 64

#: Fixed values of the model format: kinds of pieces, the escaped space.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
SPACE = "▁"


class PieceModel:
    """Pieces of a model file and their ids, encoding and decoding."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        size = model.get_piece_size()
        kind = [
            UNKNOWN if model.is_unknown(i) else CONTROL if model.is_control(i) else BYTE if model.is_byte(i) else NORMAL
            for i in range(size)
        ]
        names = [model.id_to_piece(i) for i in range(size)]
        _check_settings(model.serialized_model_proto())
        self.ids = {names[i]: i for i in range(size) if kind[i] == NORMAL}
        self.score = {names[i]: model.get_score(i) for i in range(size) if kind[i] == NORMAL}
        #: Id of a byte, for characters that are no piece.
        self.byte_id = {int(names[i][3:5], 16): i for i in range(size) if kind[i] == BYTE}
        shown = {NORMAL: lambda s: s.replace(SPACE, " "), CONTROL: lambda s: "", UNKNOWN: lambda s: " \N{DOUBLE QUESTION MARK} "}
        self.raw = [bytes([int(names[i][3:5], 16)]) if k == BYTE else shown[k](names[i]).encode() for i, k in enumerate(kind)]
        self.silent = {i for i in range(size) if kind[i] == CONTROL}
        self.starts_word = {i for i in range(size) if kind[i] == NORMAL and names[i].startswith(SPACE)}
        # No piece has a space behind another character (checked), so a text can be
        # cut before its runs of spaces, and around characters of no piece.
        if any(SPACE in name.lstrip(SPACE) for name in self.ids):
            raise ValueError("pieces with inner spaces are not supported")
        alphabet = {c for name in self.ids for c in name}
        self.cuts_lines = "\n" not in alphabet
        self.strangers = re.compile("([^" + "".join(map(re.escape, sorted(alphabet))) + "]+)")
        # Every character stands for itself, whether it is a piece or not.
        self.tokens = ["", *self.ids, *(alphabet - set(self.ids))]
        self.numbers = [[self.ids[t]] if t in self.ids else self._bytes(t) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens[1:], 1):
            self.automaton.add_word(token, (number, len(token)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def _bytes(self, text: str) -> list[int]:
        return [self.byte_id.get(b, self.unknown) for b in text.encode()]

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by the definition: the best pair first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best = max(
                ((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score),
                default=None,
            )
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether the tokens ``left`` (0: none) and ``right`` stay two when joined."""
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        pair = [self.tokens[i] for i in (left, right) if i]
        known = self.pairs[left << 20 | right] = self.merged("".join(pair)) == pair
        return known

    def prefixes(self, text: str) -> list[int]:
        """Tokens of an escaped text without strangers, by the table of its prefixes."""
        last, lengths = [0] * (len(text) + 1), [0] * (len(text) + 1)
        known, fits = self.pairs.get, self.fits
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            left = last[end - length]
            fit = known(left << 20 | token)
            if fit or fit is None and fits(left, token):
                last[end] = token
                lengths[end] = length
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= lengths[at]
        out.reverse()
        return out

    def _word(self, word: str) -> bytes:
        """Ids of a piece of text that is cut from its neighbours, as unsigned 32-bit numbers."""
        ids: list[int] = []
        # Every second part holds characters of no piece, which join nothing.
        for k, part in enumerate(self.strangers.split(word.replace(" ", SPACE))):
            if k % 2:
                ids += self._bytes(part)
            else:
                for token in self.prefixes(part):
                    ids += self.numbers[token]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids (little-endian unsigned 32 bits) of a whole text, begin and end included."""
        out = [struct.pack("<I", self.begin)]
        if text:
            # One space goes before the text; after a line end nothing does.
            lines = (" " + text).split("\n") if self.cuts_lines else [" " + text]
            feed = self._word("\n")
            for k, line in enumerate(lines):
                if k:
                    out.append(feed)
                out.append(self._line(line))
        out.append(struct.pack("<I", self.end))
        return b"".join(out)

    def _line(self, line: str) -> bytes:
        known = self.words
        if "  " in line or line.endswith(" ") or SPACE in line:
            cut = re.findall(" *[^ ]+| +", line.replace(SPACE, " "))
        else:
            head, *rest = line.split(" ")
            cut = [head] if head else []
            cut += [" " + word for word in rest]
        try:
            return b"".join(map(known.__getitem__, cut))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        out = []
        for word in cut:
            ids = known.get(word)
            if ids is None:
                ids = self._word(word)
                if len(word) <= LONG_WORD:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, bytes read as UTF-8, the space before the text dropped."""
        first = next((i for i in ids if i not in self.silent), None)
        line = b"".join(map(self.raw.__getitem__, ids))
        ends = len(ids) > 0 and (ids[0] in self.silent) + (len(ids) > 1 and ids[-1] in self.silent)
        try:
            text = line.decode() if sum(map(ids.count, self.silent)) == ends else None
        except UnicodeDecodeError:
            text = None
        if text is None:
            # Only ids that no text has: bytes join up to the next control id, and
            # each that belongs to no character becomes one replacement character.
            runs = (b"".join(self.raw[i] for i in run) for quiet, run in groupby(ids, self.silent.__contains__) if not quiet)
            text = "".join(re.sub("[\udc80-\udcff]", "\N{REPLACEMENT CHARACTER}", run.decode("utf-8", "surrogateescape")) for run in runs)
        return text[1:] if first in self.starts_word else text


def _check_settings(proto: bytes) -> None:
    """Raise if the model file asks for anything this module does not do."""
    trainer, normalizer = ({n: v for n, v in _fields(part)} for part in (_message(proto, 2), _message(proto, 3)))
    plain = not normalizer.get(2) and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
    if trainer.get(3, 1) != 2 or trainer.get(24, 0) or not trainer.get(35, 0) or not plain:
        raise ValueError("only BPE models with byte fallback, a space before the text and no normalization are supported")


def _message(proto: bytes, number: int) -> bytes:
    return b"".join(value for n, value in _fields(proto) if n == number)


def _fields(proto: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = proto[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(proto):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, proto[at:at + size]
        at += size


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text, begin and end ids included.

    A NULL text is empty: only the begin and end ids.  NULL and repeated doc_ids
    are rows like any other, very long texts are never cut, other columns are
    ignored and an empty table gives an empty result.  ``path`` is a model file
    every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _model(path).encode
        for batch in batches:
            ids = [np.frombuffer(encoded(t.as_py() or ""), "<u4").astype("i4") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids, such as those of :func:`encode`.

    NULL ids give a NULL text.  Bytes that form no character become replacement
    characters; an id outside the model raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = _model(path).decode
        for batch in batches:
            texts = [None if ids.as_py() is None else decoded(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    picked = rows.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return picked.mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    Like :func:`encode` followed by :func:`decode`, without moving the ids out
    of the task; the same rules for NULLs, repeated ids and long texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for text in batch.column(1):
                ids = model.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                ids_digest.append(hashlib.sha256(ids).hexdigest())
                back = model.decode(np.frombuffer(ids, "<u4").tolist())
                text_digest.append(hashlib.sha256(back.encode()).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
