"""Bounded-space online packing of token sequences.

Each partition streams its documents: ids of the whole text and one separator.
Full windows are cut off the front of a document; the rest (shorter than a
window) is placed into one of a fixed number of *open windows*, best fit first.
When it fits into none, the fullest open window is emitted and the rest starts
a new one.  A window that gets full is emitted at once.  A partition therefore
holds ``open_windows`` windows at any time, however many rows it has.

The windows still open at the end of a partition are written with their ids (at
most ``open_windows * window`` ids a partition).  ``merge_fan_in`` neighbouring
partitions put them together: their pieces are laid end to end and cut at
window boundaries, so one window a group of partitions stays partly empty.

Null texts count as empty: a document of the separator alone.  Repeated rows
are packed each on their own.  An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from campanula.session import materialize

#: sequence ids: the maker (partition, or group of partitions above MERGED) times this, plus a counter
_PER_MAKER = 1 << 32
_MERGED = 1 << 30


#: texts of these characters alone (ASCII from space on, line feeds, Latin letters with marks) are split alike by any
#: implementation of the tokenizer's pattern
_PLAIN = re.compile(r"[\x20-\x7e\n\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*")


class TextIds:
    """Ids of a whole text, equal to the tokenizer's own.

    With ``ranks_file``, the same byte-level vocabulary as a list of ranks,
    texts of plain characters are encoded by the faster library for that form;
    all others, and those with the text of an added (special) token in them, go
    to the tokenizer itself."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None = None) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.fast = None
        if ranks_file:
            import public_tokenizers
            import tiktoken
            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.fast is not None and _PLAIN.fullmatch(text) and not self.added.search(text):
            return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class OpenWindows:
    """A fixed number of open windows, kept sorted by the room that is left."""

    def __init__(self, window: int, most: int) -> None:
        self.window, self.most = window, most
        self.room: list[tuple[int, int]] = []  # (ids that still fit, key), ascending
        self.pieces: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, piece) -> list | None:
        """Puts a piece into the best fitting window; returns a window to emit."""
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            left, key = self.room.pop(at)
            self.pieces[key].append(piece)
            if left == length:
                return self.pieces.pop(key)
            insort(self.room, (left - length, key))
            return None
        out = None
        if len(self.room) >= self.most:
            out = self.pieces.pop(self.room.pop(0)[1])
        self.made += 1
        self.pieces[self.made] = [piece]
        insort(self.room, (self.window - length, self.made))
        return out

    def rest(self) -> list[list]:
        return [self.pieces[key] for _, key in self.room]


def _crc(ids: bytes) -> int:
    return zlib.crc32(ids)


def _schema(id_type: T.DataType) -> T.StructType:
    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
              ("sequence_id", T.LongType()), ("offset", T.LongType()), ("maker", T.LongType()), ("ids", T.BinaryType())]
    return T.StructType([T.StructField("__id", id_type), *(T.StructField(n, t) for n, t in fields)])


def pack(documents: DataFrame, tokenizer_file: str, window: int = 1024, separator: int = 0, open_windows: int = 64,
         merge_fan_in: int = 16, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
         ranks_file: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` ids.

    Columns: the id, ``start`` (ids of the document before the piece),
    ``length``, ``ids_crc32``, ``doc_tokens`` (with the separator),
    ``sequence_id``, ``offset`` in the sequence and, with ``with_ids``, the ids
    as little-endian unsigned 32-bit numbers.
    """
    tail = separator.to_bytes(4, "little")
    columns = [f.name for f in _schema(T.LongType())]

    def table(rows: list[tuple], kinds: list[pa.DataType]) -> list[pa.Array]:
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = TextIds(tokenizer_file, ranks_file)
        maker = TaskContext.get().partitionId()
        open_ = OpenWindows(window, open_windows)
        sequence = maker * _PER_MAKER

        def emit(pieces, rows):
            nonlocal sequence
            offset = 0
            for doc, start, ids, tokens in pieces:
                n = len(ids) // 4
                rows.append((doc, start, n, _crc(ids), tokens, sequence, offset, maker, ids if with_ids else None))
                offset += n
            sequence += 1

        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("__id").to_pylist(), batch.column("__text").to_pylist()):
                ids = to_ids(text or "") + tail
                tokens = len(ids) // 4
                whole = tokens - tokens % window
                for start in range(0, whole, window):
                    emit([(doc, start, ids[4 * start:4 * (start + window)], tokens)], rows)
                if whole < tokens and (full := open_.place(tokens - whole, (doc, whole, ids[4 * whole:], tokens))):
                    emit(full, rows)
            yield pa.RecordBatch.from_arrays(table(rows, kinds), names=columns)
        left = [(doc, start, len(ids) // 4, None, tokens, None, None, maker, ids)
                for pieces in open_.rest() for doc, start, ids, tokens in pieces]
        yield pa.RecordBatch.from_arrays(table(left, kinds), names=columns)

    def merge(key: tuple, left: pa.Table) -> pa.Table:
        maker = _MERGED + key[0].as_py()
        rows, used, sequence = [], 0, maker * _PER_MAKER
        pieces = sorted(left.to_pylist(), key=lambda r: (r["maker"], -r["length"], r["start"]))
        for doc, start, length, tokens, ids in ((r["__id"], r["start"], r["length"], r["doc_tokens"], r["ids"]) for r in pieces):
            cut = 0
            while cut < length:
                n = min(length - cut, window - used)
                part = bytes(ids[4 * cut:4 * (cut + n)])
                rows.append((doc, start + cut, n, _crc(part), tokens, sequence, used, maker, part if with_ids else None))
                cut += n
                used += n
                if used == window:
                    used, sequence = 0, sequence + 1
        return pa.Table.from_arrays(table(rows, kinds), names=columns)

    rows = documents.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = _schema(rows.schema["__id"].dataType)
    kinds = [to_arrow_type(f.dataType) for f in schema]
    # one run of the stream feeds both readers below: a second run could meet the rows in another order
    streamed = materialize(rows.mapInArrow(stream, schema))
    merged = (streamed.where("sequence_id is null")
              .groupBy(F.floor(F.col("maker") / merge_fan_in).alias("__group")).applyInArrow(merge, schema))
    out = streamed.where("sequence_id is not null").unionByName(merged)
    return out.select(F.col("__id").alias(id_col), *[c for c in columns[1:-2]], *(["ids"] if with_ids else []))
