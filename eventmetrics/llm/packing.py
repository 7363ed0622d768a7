"""Documents as tokens in windows of a fixed length, packed by Karmarkar-Karp differencing.

A document longer than a window fills whole windows by itself. What is left of it is cut into
pieces of a quarter of a window at most, because numbers that are small against the sum of a part
are what differencing makes even. The pieces of one task are packed in blocks of PACK_WINDOWS
windows or PACK_PIECES pieces: differencing deals them to as few windows as could hold them, and to one more as long as
a window's capacity is exceeded. Nothing is shuffled, and a task holds the tokens of a few texts
and the sizes of one block's pieces.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from eventmetrics.llm.differencing import windows
from eventmetrics.llm.hashing import column_bytes, row_blocks

WINDOW = 2048
END = 1  # the id after each document
PACK_WINDOWS = 256
#: A block has at most so many pieces, which are a few tokens each in a run of tiny documents.
PACK_PIECES = 16_384

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class Tokens:
    """Token ids of texts as little-endian 32-bit bytes.

    The vocabulary's rank file gives the same ids several times faster than its JSON file does,
    except that it knows no special tokens: texts with one go through the JSON file.
    """

    def __init__(self, path: str, ranks: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return array("I", ids).tobytes()


@lru_cache
def tokens_of(path: str, ranks: str) -> Tokens:
    """One tokenizer for each worker process."""
    return Tokens(path, ranks)


def default_tokenizer() -> tuple[str, str]:
    """The public byte-level vocabulary: its JSON file and its rank file."""
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _pieces(ids: bytes, window: int) -> Iterator[tuple[int, int, int]]:
    """Start, length and crc32 of a document's pieces: whole windows, then quarters."""
    n, at = len(ids) // 4, 0
    while at < n:
        length = window if n - at >= window else min(n - at, max(1, window // 4))
        yield at, length, zlib.crc32(ids[4 * at:4 * (at + length)])
        at += length


class _Packer:
    """Rows of pieces with their places, as blocks fill up."""

    def __init__(self, window: int):
        self.window = window
        self.next_sequence = TaskContext.get().partitionId() << 33
        self.waiting: list[tuple] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // 4
        for start, length, crc in _pieces(ids, self.window):
            if length == self.window:
                self.rows.append((doc_id, start, length, crc, n, self.next_sequence, 0))
                self.next_sequence += 1
            else:
                self.waiting.append((doc_id, start, length, crc, n))
                self.tokens += length
        if self.tokens >= PACK_WINDOWS * self.window or len(self.waiting) >= PACK_PIECES:
            self.pack()

    def pack(self) -> None:
        for part in windows([p[2] for p in self.waiting], self.window):
            offset = 0
            for i in part:
                self.rows.append((*self.waiting[i], self.next_sequence, offset))
                offset += self.waiting[i][2]
            self.next_sequence += 1
        self.waiting, self.tokens = [], 0

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         tokenizer: tuple[str, str] | None = None, end: int = END) -> DataFrame:
    """The pieces of all documents and the windows they lie in.

    Columns: doc_id, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    doc_tokens, sequence_id and offset. A document is its text's ids and then `end`; an empty or
    null text is `end` alone. A row without an id, and a row that is repeated, are documents of
    their own. An empty table has no pieces.
    """
    paths = tokenizer or default_tokenizer()
    schema = to_arrow_schema(_parse_datatype_string(PIECES))
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        tokens, packer = tokens_of(*paths), _Packer(window)
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            _, offsets = column_bytes(column)
            for first, stop in row_blocks(offsets):
                texts = column.slice(first, stop - first).to_pylist()
                for doc, text in zip(ids[first:stop], texts):
                    packer.add(doc, tokens(text or "") + last)
                yield packer.take(schema)
        packer.pack()
        yield packer.take(schema)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)
