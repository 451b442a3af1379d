"""Byte-level BPE by the tiktoken library and a rank file.

The rank file is read where the driver runs and its ranks (50,256 short byte strings in the
public file; `MAX_RANK_BYTES` is checked) are broadcast, so executors need no file. Long texts are
cut before encoding at places where every tokenization by the pattern has a break, so that the
library never gets a huge string and the ids stay those of the whole text. Decoding joins raw
bytes: ids of a part of a character come back as the bytes they stand for.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import small_batches

MAX_RANK_BYTES = 64 << 20
#: Characters a piece may have before it is cut, at the next safe place.
PIECE_CHARS = 1 << 16

#: No match of the pattern holds a visible ASCII character and then a blank or a line feed: white space
#: joins only white space before it, and a blank leads a word only from its front. Nor does a match
#: look past a visible character's end. So a match ends before such a blank, wherever it began.
_SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")

_made: list = []


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks by byte string, from lines of base64 text and a number; any path that Spark reads."""
    if "://" not in path:
        path = f"file://{path}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = there.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(there).getLen()
    if size > MAX_RANK_BYTES:
        raise ValueError(f"{path}: {size} bytes; a rank file may have {MAX_RANK_BYTES}")
    if path.startswith("file://"):
        with open(path[len("file://") :], "rb") as f:
            rows = f.read().splitlines()
    else:
        rows = [r["value"].encode() for r in spark.read.text(path).toLocalIterator()]
    return {base64.b64decode(token): int(rank) for token, rank in (row.split() for row in rows if row.strip())}


class Codec:
    """Ranks and a pre-split pattern, broadcast; columns of ids and bytes are made with it."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str, piece_chars: int = PIECE_CHARS):
        if len(set(ranks.values())) != len(ranks):
            raise ValueError("ranks must be distinct")
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        small_batches(spark)
        self.ranks: Broadcast = spark.sparkContext.broadcast(ranks)
        self.pattern, self.piece_chars = pattern, piece_chars

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """All rows and columns, and `ids` (array of int; empty for null or empty text). A column
        named like `ids` is replaced. Special tokens are ordinary text."""
        ranks, pattern, most = self.ranks, self.pattern, self.piece_chars

        @F.pandas_udf("array<int>")
        def to_ids(parts):
            import pandas as pd

            coder = _coder(ranks, pattern)
            return pd.Series([_ids(coder, t, most) if t else np.zeros(0, np.int32) for t in parts], dtype=object)

        return df.withColumn(ids, to_ids(F.coalesce(F.col(f"`{text}`"), F.lit(""))))

    def decode(self, df: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """All rows and columns, and `out` (binary): the bytes of the ids, joined. Null ids are no ids;
        an id without a token raises KeyError."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def to_bytes(lists):
            import pandas as pd

            coder = _coder(ranks, pattern)
            return pd.Series([coder.decode_bytes(x) if x is not None else b"" for x in lists], dtype=object)

        return df.withColumn(out, to_bytes(F.col(f"`{ids}`")))


def _coder(ranks: Broadcast, pattern: str) -> tiktoken.Encoding:
    """One encoding a Python worker, as long as it is given the same ranks."""
    if not _made or _made[0] is not ranks.value or _made[1] != pattern:
        _made[:] = [ranks.value, pattern, tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})]
    return _made[2]


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of `most` characters and as many more as the next safe place takes."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _ids(coder: tiktoken.Encoding, text: str, most: int) -> np.ndarray:
    if len(text) <= most:
        return np.asarray(coder.encode_ordinary(text), np.int32)
    return np.concatenate([np.asarray(coder.encode_ordinary(p), np.int32) for p in safe_pieces(text, most)])


@F.pandas_udf(T.StringType())
def ids_sha256(lists):
    """Hex SHA-256 of ids as little-endian unsigned 32-bit integers."""
    import hashlib

    return lists.map(lambda x: hashlib.sha256(np.asarray(x, "<u4").tobytes()).hexdigest())
