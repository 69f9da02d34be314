"""Packing by concatenate and cut.

The first pass turns texts into ids, each followed by an end id, and writes them with
their place among the tokens of their partition. Totals of the partitions, summed up
in order, give every partition its global offset. The second pass reads the written
ids in order and cuts them at multiples of `LENGTH`. A window that lies within what
one task reads is whole; where a task begins or ends within a window it hands on a
boundary record, and the few records of a window are put together by its number.
All sequences are full but the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.llm.common import give_back, slices, text_or_empty
from fieldledger.llm.registry import query, reach, table
from fieldledger.llm.tokens import VOCABULARY, encoder
from fieldledger.scratch import staged

LENGTH, END_ID = 2048, 1

_PIECE = "struct<doc: {doc}, start: long, length: long, offset: long, tokens: long>"


class _Encode:
    """Ids of each text, their number, and the tokens before them in the partition."""

    def __init__(self, path: str, end: int):
        self.path, self.end = path, end

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(self.path), TaskContext.get().partitionId(), 0
        narrow = np.uint16 if max(encode.size, self.end + 1) <= 1 << 16 else np.uint32
        for batch in slices(batches, "text"):
            found = [np.append(x, self.end) for x in encode(batch.column("text").to_pylist())]
            n = np.array([len(x) for x in found], np.int64)
            places = before + np.cumsum(n) - n
            before += int(n.sum())
            ids = pa.array([x.astype(narrow).tobytes() for x in found], pa.binary())
            parts = pa.array(np.full(len(n), part, np.int32))
            width = pa.array(np.full(len(n), narrow().itemsize, np.int32))
            columns = [batch.column("doc"), parts, pa.array(n), pa.array(places), width, ids]
            names = ["doc", "part", "n", "before", "width", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
        encode.clear()
        give_back()


class _Cut:
    """Windows, or what a task sees of them: number, offset, ids, pieces."""

    def __init__(self, length: int, schema: pa.Schema):
        self.length, self.schema = length, schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, size, pieces, ids = 0, [], self.length, [], []

        def close():
            nonlocal pieces, ids
            if pieces:
                first = pieces[0]["offset"]
                out.append({"sequence_id": (at - 1) // size, "offset": first, "ids": b"".join(ids), "pieces": pieces})
            pieces, ids = [], []

        for batch in slices(batches, "ids"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc", "place", "n", "width", "ids")), strict=True)
            for doc, place, n, width, raw in rows:
                if place != at:
                    close()
                    at = place
                wide = np.frombuffer(raw, f"<u{width}").astype("<u4")
                done = 0
                while done < n:
                    offset = at % size
                    take = min(n - done, size - offset)
                    pieces.append({"doc": doc, "start": done, "length": take, "offset": offset, "tokens": n})
                    ids.append(wide[done : done + take].tobytes())
                    done, at = done + take, at + take
                    if at % size == 0:
                        close()
            if out:
                yield pa.RecordBatch.from_pylist(out, self.schema)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, self.schema)


def windows(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    length: int = LENGTH,
    end: int = END_ID,
) -> DataFrame:
    """(sequence_id, offset, ids, pieces): whole windows and boundary records.

    `ids` are little-endian unsigned 32-bit. A piece has its document's id, its start
    among the document's tokens, its length, its offset in the sequence and the
    document's number of tokens, with the end id. A null text is an empty one and has
    the end id alone; rows with equal ids are packed each for itself; an empty table
    has no windows. Other columns are not read.
    """
    reach(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    encoded = slim.mapInArrow(
        _Encode(path, end),
        f"doc {kind}, part int, n long, before long, width int, ids binary",
    )
    tokens = staged(encoded, "token-ids")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    upto = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(upto, F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(offsets), "part").select(
        "doc", (F.col("base") + F.col("before")).alias("place"), "n", "width", "ids"
    )
    schema = f"sequence_id long, offset long, ids binary, pieces array<{_PIECE.format(doc=kind)}>"
    empty = docs.sparkSession.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    return placed.mapInArrow(_Cut(length, to_arrow_schema(empty.schema)), schema)


def sequences(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequence_id, ids, pieces) with one row per sequence, from written `windows`."""
    whole = F.octet_length("ids") == 4 * length
    parts = cut.where(~whole).groupBy("sequence_id")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "pieces"))).alias("x"))
    merged = parts.select(
        "sequence_id",
        F.aggregate("x", F.lit(b""), lambda a, x: F.concat(a, x.ids)).alias("ids"),
        F.flatten("x.pieces").alias("pieces"),
    )
    return cut.where(whole).select("sequence_id", "ids", "pieces").unionByName(merged)


def packed_pieces(docs: DataFrame, **options) -> DataFrame:
    """One row per piece, with the checksum of its ids."""
    cut = windows(docs, **options)
    rows = cut.select("sequence_id", F.col("offset").alias("first"), "ids", F.explode("pieces").alias("p"))
    begin = (4 * (F.col("p.offset") - F.col("first")) + 1).cast("int")
    own = F.substring(F.col("ids"), begin, (4 * F.col("p.length")).cast("int"))
    return rows.select(
        F.col("p.doc").alias("doc_id"), "p.start", "p.length", F.crc32(own).alias("ids_crc32"),
        F.col("p.tokens").alias("doc_tokens"), "sequence_id", "p.offset",
    )


@query("op4_packing")
def op4_packing(spark, folder):
    return packed_pieces(table(spark, folder, "documents"))
