"""Best-fit packing of tokenised documents into sequences, planned on the length histogram.

The plan works on counts per length (at most ``size`` numbers, whatever the input), never
on documents.  Pieces then take the planned slots by joining on their rank within length;
ranks are made from per-bucket counts, so no length is sorted or numbered in one task.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import durable

SIZE = 1024
END_ID = 2
CACHE = 300_000
_AMBIGUOUS = re.compile(r"\s \s|\s \Z")


class Encoder:
    """Ids of the byte-level BPE vocabulary, equal to ``tokenizers`` on the .json file of the same name.

    A boundary of the vocabulary's pattern stands before every single space, so space-led
    units are encoded once and kept in a bounded cache.  Texts where a space stands between
    or after white space are encoded whole.  Texts are split at the vocabulary's added tokens first, each
    of which is one id wherever its characters stand.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._known: dict[str, list[int]] = {}
        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
            self._added = {t["content"]: int(t["id"]) for t in json.load(f).get("added_tokens", [])}
        # The longest of those that start at a place counts.
        longest = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(longest)})") if longest else None

    def _unit(self, unit: str) -> list[int]:
        ids = self._known.get(unit)
        if ids is None:
            ids = self._bpe.encode_ordinary(" " + unit)
            if len(self._known) < CACHE and len(unit) < 64:
                self._known[unit] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if self._split is None or not self._split.search(text):
            return self._plain(text)
        parts = [np.array([self._added[x]], dtype="<u4") if k % 2 else self._plain(x) for k, x in enumerate(self._split.split(text))]
        return np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        if _AMBIGUOUS.search(text):
            return np.array(self._bpe.encode_ordinary(text), dtype="<u4")
        first, *units = text.split(" ")
        ids = self._bpe.encode_ordinary(first)
        return np.fromiter(chain(ids, chain.from_iterable(map(self._unit, units))), dtype="<u4")


def _pieces(size: int, end_id: int, tokenizer: str):
    def run(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            out = [[] for _ in range(5)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encoder.encode(text or ""), np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for column, value in zip(out, (doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, tokenizer: str = "byte_bpe_50k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's token ids plus the end id.

    A null text is empty.  Documents of more than ``size`` ids are cut into pieces of
    ``size``; the first piece takes what is over.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pieces(size, end_id, tokenizer), "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: rows (length, first rank, end rank, first sequence, per sequence, offset).

    Sequences of equal content are one group.  Lengths come longest first; each takes the
    group with the least room that still holds it.  A group is split only where a length
    ends within it, so there are at most three more groups a length.
    """
    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room left -> groups (first sequence, sequences)
    rooms: list[int] = []
    rows, sequences = [], 0

    def put(room: int, group: tuple[int, int]) -> None:
        if room > 0 and group[1] > 0:
            if room not in open_by_room:
                open_by_room[room] = []
                heapq.heappush(rooms, room)
            open_by_room[room].append(group)

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        for room in sorted(r for r in open_by_room if r >= length):
            while todo and open_by_room.get(room):
                first, n = open_by_room[room].pop()
                per = room // length
                full = min(n, todo // per)
                if full:
                    rows.append((length, rank, rank + full * per, first, per, size - room))
                    rank, todo = rank + full * per, todo - full * per
                    put(room - per * length, (first, full))
                if full < n and todo:  # fewer than one sequence takes
                    rows.append((length, rank, rank + todo, first + full, todo, size - room))
                    put(room - todo * length, (first + full, 1))
                    full, rank, todo = full + 1, rank + todo, 0
                put(room, (first + full, n - full))
            if not open_by_room[room]:
                del open_by_room[room]
            if not todo:
                break
        if todo:
            per = size // length
            full, rest = divmod(todo, per)
            if full:
                rows.append((length, rank, rank + full * per, sequences, per, 0))
                put(size - per * length, (sequences, full))
                rank, sequences = rank + full * per, sequences + full
            if rest:
                rows.append((length, rank, rank + rest, sequences, rest, 0))
                put(size - rest * length, (sequences, 1))
                sequences += 1
    return rows


def pack(found: DataFrame, size: int = SIZE, buckets: int | None = None) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Ties in length are taken in the order of bucket, doc_id, piece and start; repeated rows
    take a slot each, a null doc_id is allowed.  ``buckets`` salts the ranks.
    """
    spark = found.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = durable(found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")), "pieces")
    counts = durable(kept.groupBy("length", "bucket").agg(F.count("*").alias("n")), "counts")
    before = counts.selectExpr("length", "bucket", "sum(n) over (partition by length order by bucket) - n as base")
    # At most one row a length: the histogram is bounded by ``size``.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, size)
    slots = spark.createDataFrame(rows, "length long, low long, high long, first long, per long, place long")
    local = "row_number() over (partition by length, bucket order by doc_id, piece, start, ids_crc32) - 1"
    ranked = kept.withColumn("local", F.expr(local)).join(before, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("local"))
    # The plan has a few rows a length, at most about 45 * 3 * size of 48 bytes: it can be broadcast.
    met = ranked.join(F.broadcast(slots), "length").where("rank >= low and rank < high")
    return met.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.expr("first + (rank - low) div per").alias("sequence_id"),
        F.expr("place + ((rank - low) % per) * length").alias("offset"),
    )


def best_fit_packing(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """Tokenise and pack: one row per piece with its sequence and its offset there; an empty table gives none."""
    return pack(pieces(docs, size, end_id, tokenizer), size)
