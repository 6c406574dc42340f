"""Best-fit packing planned over a histogram of lengths.

Texts become token pieces of at most ``CAPACITY`` ids.  The plan sees only how
many pieces have each length (at most ``CAPACITY`` counts, whatever the corpus):
lengths are placed in falling order, each into the fullest sequences that still
have room, many sequences at a time.  The pieces then look up their place by
their rank within their length.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from punctua.llm.common import ranked, stored

#: Tokens a sequence holds.
CAPACITY = 2048
#: Id after every document.
END_ID = 0
#: Fixed value: the public pre-tokenizer pattern of byte-level BPE.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters are split alike by every regex engine.
SAFE = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")
#: Words a worker remembers before it starts anew.
REMEMBERED = 400_000


class Vocabulary:
    """Ids of texts by a byte-level BPE file, each distinct word tokenized once.

    A piece of the pre-tokenizer never reaches over a space that follows a
    visible character, so such a text is cut there and the words are looked up.
    Words are encoded from the same vocabulary's rank file, which is the faster
    of the two and gives the same ids (tests compare them).  Texts with
    characters that regex engines may class differently, and texts that spell a
    special token, are encoded as a whole by the BPE file.
    """

    def __init__(self, bpe: str, ranks: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=table, special_tokens={})
        self.whole = Tokenizer.from_file(bpe)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        """Ids (little-endian unsigned 32 bits) without the end id."""
        if not SAFE.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        plain = self.words.encode_ordinary
        if any(run in text for run in ("  ", "\n ", "\t ", "\r ")):
            return np.array(plain(text), "<u4")
        head, *rest = text.split(" ")
        known, first = self.known, np.array(plain(head), "<u4").tobytes()
        try:
            return np.frombuffer(first + b"".join(map(known.__getitem__, rest)), "<u4")
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for word in rest:
            if word not in known:
                known[word] = np.array(plain(" " + word), "<u4").tobytes()
        return np.frombuffer(first + b"".join(map(known.__getitem__, rest)), "<u4")


@lru_cache(maxsize=2)
def _vocabulary(bpe: str, ranks: str) -> Vocabulary:
    return Vocabulary(bpe, ranks)


def token_pieces(docs: DataFrame, bpe: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    Every document has at least its end id.  One longer than ``CAPACITY`` is cut
    so that only its first piece is shorter.  ``bpe`` and ``ranks`` are the paths of
    a byte-level BPE file and of its rank file, which every executor can open.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _vocabulary(bpe, ranks).encode
        for batch in batches:
            rows = [[] for _ in range(6 if with_ids else 5)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % CAPACITY or CAPACITY
                edges = [0, *range(min(first, len(ids)), len(ids) + 1, CAPACITY)]
                for k, (i, j) in enumerate(zip(edges, edges[1:])):
                    part = ids[i:j]
                    for column, value in zip(rows, (doc, k, i, j - i, zlib.crc32(part.tobytes()), part.astype("i4"))):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(r, k) for r, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset): the pieces of ``length`` from
    ``first rank`` on take one sequence each, from ``first sequence`` on.

    Open sequences with equal room are kept as runs (first, how many), so work
    and result depend on the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    levels: list[int] = []
    out, opened = [], 0

    def add(left: int, first: int, n: int) -> None:
        if left == 0:
            return
        if left not in room:
            room[left] = []
            bisect.insort(levels, left)
        room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            at = bisect.bisect_left(levels, length)
            if at == len(levels):
                need = -(-todo // (capacity // length))
                add(capacity, opened, need)
                opened += need
                continue
            left = levels[at]
            first, n = room[left].pop()
            used = min(n, todo)
            if used < n:
                room[left].append((first + used, n - used))
            if not room[left]:
                del room[left]
                levels.pop(at)
            out.append((length, rank, first, capacity - left))
            add(left - length, first, used)
            rank, todo = rank + used, todo - used
    return out


def pack(docs: DataFrame, bpe: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of :func:`token_pieces` with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0.  A NULL text is empty: its one token is
    the end id.  A NULL or repeated doc_id is packed like any other row.  Other
    columns are ignored; an empty table gives an empty result.
    """
    pieces = stored(token_pieces(docs, bpe, ranks, id_col, text_col, with_ids), "pieces")
    # At most CAPACITY rows: one per length.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = np.array(sorted(plan(counts)), "i8").reshape(-1, 4)
    at_least = steps[:, 0] << 48 | steps[:, 1]
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            step = steps[np.searchsorted(at_least, length << 48 | rank, side="right") - 1]
            taken = [pa.array(step[:, 2] + rank - step[:, 1]), pa.array(step[:, 3])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *taken], names=[*names, "sequence_id", "offset"])

    many = F.coalesce(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("length")], F.lit(0)) if counts else F.lit(0)
    order = [F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")]
    slots = ranked(pieces.withColumn("__many", many), ["length"], order, "rank", per_key="__many").drop("__many")
    kinds = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    return slots.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")
