"""SentencePiece encoding and decoding by distinct chunks.

No piece of the model holds a white space marker after another character, so no merge crosses the
place before a marker: a text falls into *marked words* (a run of markers and what follows up to the
next marker) that are segmented independently. Each task keeps a table of distinct marked words;
a word is segmented once and its ids are joined back by position.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rillwork.llm.common import arrow_map, quoted

MARK = "▁"
#: A marked word; the text is given a leading space, as the model's dummy prefix does.
CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")
#: Entries of a task's chunk table; it starts anew beyond that. Longer words are not kept.
TABLE_ROWS, KEPT_CHARS = 100_000, 64


class ChunkTable:
    """Distinct marked words with their ids and decoded text."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.sp = SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, bytes] = {}
        # A lone marker, as at the end of a text: the library gives the empty text no dummy prefix.
        self.marker = self.sp.encode("a ")[len(self.sp.encode("a")):]

    def lookup(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as 32-bit integers: those of its marked words, in order."""
        split = [CHUNK.findall(" " + t) if t else [] for t in texts]
        used = set().union(*split)
        new = list(used.difference(self.ids))
        if len(self.ids) + len(new) > TABLE_ROWS:
            self.ids.clear()
            new = list(used)
        # The leading marker is left to the dummy prefix.
        found = self.sp.encode([c[1:] for c in new], num_threads=1) if new else []
        self.ids.update((c, array("i", ids if len(c) > 1 else self.marker).tobytes())
                        for c, ids in zip(new, found))
        out = [b"".join(map(self.ids.__getitem__, words)) for words in split]
        for c in new:
            if len(c) > KEPT_CHARS:
                del self.ids[c]
        return out


def independent(model: bytes) -> bool:
    """Whether marked words can be segmented one by one: no piece has a marker after another
    character, and the normalizer only escapes spaces and adds the dummy prefix."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_proto=model)
    inner = re.compile(f"[^{MARK}]{MARK}")
    probe = "a  b\tc  　ﬁ é "
    plain = sp.decode(sp.encode(probe)) == probe and sp.encode("a") == [*sp.encode("a b")][:1]
    return plain and not any(inner.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))


def encoder(model_path: str):
    """Column function: text -> array of ids, without begin and end ids. Null and empty give none."""
    with open(model_path, "rb") as f:
        model = f.read()
    if not independent(model):
        raise ValueError("pieces of this model cross white space markers")
    tables: list[ChunkTable] = []

    def encode(texts):
        if not tables:
            tables.append(ChunkTable(model))
        found = tables[0].lookup(texts)
        offsets = np.cumsum([0, *(len(ids) // 4 for ids in found)]).astype(np.int32)
        values = np.frombuffer(b"".join(found), np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    return arrow_map(encode, "array<int>")


def decoder(model_path: str):
    """Column function: array of ids -> text, as the library's ``decode``. Null gives the empty
    text."""
    with open(model_path, "rb") as f:
        model = f.read()
    found: list = []

    def decode(rows):
        from sentencepiece import SentencePieceProcessor
        if not found:
            found.append(SentencePieceProcessor(model_proto=model))
        return pa.array([found[0].decode(ids) if ids else "" for ids in rows], pa.string())

    return arrow_map(decode, "string")


def encode_documents(df: DataFrame, model_path: str, text_col: str = "text",
                     ids_col: str = "ids") -> DataFrame:
    """The frame with a column of ids. A column of that name is replaced; all others stay."""
    return df.withColumn(ids_col, encoder(model_path)(quoted(text_col)))


def decode_documents(df: DataFrame, model_path: str, ids_col: str = "ids",
                     text_col: str = "decoded") -> DataFrame:
    """The frame with the text of the ids. A column of that name is replaced; all others stay."""
    return df.withColumn(text_col, decoder(model_path)(quoted(ids_col)))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
