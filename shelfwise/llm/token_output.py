"""Token shards in training order.

Texts become token ids of a public tokenizer, each followed by an end mark, and
the stream of one input partition is cut into sequences of equal length.  All
sequences have a number: partitions one after the other.  A keyed Feistel
network over the next power of four permutes the numbers; values beyond the
last sequence are put in again until they fall inside (cycle walking), so every
sequence has exactly one global slot and no table of the permutation exists.
Slots are cut into shards; a shard is one file of records of a fixed stride,
written through Spark's writer, so lost tasks are written again.  A reader that
stopped at some slot goes on at a known byte of a known file.

A record is the ids as little-endian 16-bit numbers and one line feed.
"""

from __future__ import annotations

import base64
import glob
import importlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, read
from shelfwise.llm.registry import query
from shelfwise.llm.shingles import mix64

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits a text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
LENGTH = 2048
#: Sequences of a shard.
SHARD = 8192
KEY = 20240229
ROUNDS = 6
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """Tokenizer of a rank file, once per worker."""
    if path not in _ENCODERS:
        tiktoken = importlib.import_module("tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def feistel(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of the numbers ``index`` below ``n``: a permutation of 0 ... n - 1."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.asarray(index).astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


_SEQUENCES = "part int, local long, n_tokens int, doc_ids array<long>, payload binary"


def _pack(path: str, length: int):
    """Cuts the token stream of one partition into sequences; the last one is filled up with end marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local = TaskContext.get().partitionId(), 0
        encode = encoder(path).encode_ordinary
        waiting: list[np.ndarray] = []  # tokens not yet in a sequence
        spans: list[tuple] = []  # their (document, tokens left)
        held = 0
        schema = pa.schema([
            ("part", pa.int32()), ("local", pa.int64()), ("n_tokens", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary()),
        ])

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, spans, held, local
            stream = np.concatenate(waiting) if waiting else np.zeros(0, np.uint16)
            rows: list[tuple] = []
            at = 0
            while len(stream) - at >= length or last and at < len(stream):
                n = min(length, len(stream) - at)
                inside, room = [], n
                while room:
                    doc, left = spans[0]
                    inside.append(doc)
                    used = min(left, room)
                    room -= used
                    if used == left:
                        spans.pop(0)
                    else:
                        spans[0] = (doc, left - used)
                record = np.full(length, END, "<u2")
                record[:n] = stream[at : at + n]
                rows.append((part, local, n, inside, record.tobytes()))
                local, at = local + 1, at + n
                if len(rows) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            waiting, held = [stream[at:]], len(stream) - at

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END], np.uint16)
                waiting.append(ids)
                spans.append((doc, len(ids)))
                held += len(ids)
                if held >= 64 * length:
                    yield from cut(False)
        yield from cut(True)

    return run


class Sequences:
    """Numbered and permuted sequences of a run: ``table`` has part, local, n_tokens, doc_ids, payload, slot, shard, at."""

    def __init__(self, table: DataFrame, n: int, length: int, shard: int):
        self.table, self.n, self.length, self.shard = table, n, length, shard

    @property
    def stride(self) -> int:
        return 2 * self.length + 1


def sequences(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    shard: int = SHARD,
    key: int = KEY,
) -> Sequences:
    """Sequences of all texts with their slots.

    Null and empty texts are an end mark alone.  Ids may be null or repeat.  No
    rows make no sequences.  Token ids are written once; the numbering reads
    only how many sequences each input partition has.
    """
    spark = docs.sparkSession
    packed = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    written = packed.mapInArrow(_pack(vocabulary, length), _SEQUENCES)
    path = f"{scratch.root}/tokens"
    written.write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "7"}).parquet(path)
    tokens = spark.read.schema(written.schema).parquet(path)
    counts = tokens.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    n = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    # One row per input partition: read by all, like the list of input files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))

    @F.pandas_udf(T.LongType())
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(feistel(index.to_numpy(), n, key))

    placed = tokens.join(F.broadcast(starts), "part").withColumn("slot", slot(F.col("_start") + F.col("local")))
    placed = placed.withColumns(
        {
            "shard": F.floor(F.col("slot") / shard).cast("int"),
            "at": (F.col("slot") % shard) * F.lit(2 * length + 1),
        }
    )
    return Sequences(placed.drop("_start"), n, length, shard)


@F.pandas_udf(T.BinaryType())
def _squeeze(payload: pd.Series) -> pd.Series:
    squeeze = zstandard.ZstdCompressor(level=7).compress
    return payload.map(lambda b: squeeze(bytes(b)))


@F.pandas_udf(T.BinaryType())
def _unsqueeze(payload: pd.Series) -> pd.Series:
    full = zstandard.ZstdDecompressor().decompress
    return payload.map(lambda b: full(bytes(b)))


def write_shards(found: Sequences, path: str) -> DataFrame:
    """Write one file per shard below ``path`` (shard=N/part-...) and the layout; returns the layout's row.

    A partition of the one shuffle is one shard, in slot order.
    """
    spark = found.table.sparkSession
    shards = max(1, -(-found.n // found.shard))
    (
        found.table.select("shard", "slot", _squeeze("payload").alias("payload"))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "slot")
        .select("shard", _unsqueeze("payload").cast("string").alias("value"))
        .write.partitionBy("shard")
        .option("lineSep", "\n")
        .text(f"{path}/shards")
    )
    layout = spark.createDataFrame(
        [(found.n, found.length, found.shard, found.stride, END)],
        "sequences long, length int, per_shard int, stride int, end int",
    )
    layout.coalesce(1).write.json(f"{path}/layout")
    return layout


def read_from(path: str, slot: int, layout: dict) -> Iterator[np.ndarray]:
    """Records from ``slot`` on, in training order, of shards on a mounted path; seeks once per shard."""
    while slot < layout["sequences"]:
        shard, inside = divmod(slot, layout["per_shard"])
        (name,) = glob.glob(f"{path}/shards/shard={shard}/part-*")
        with open(name, "rb") as file:
            file.seek(inside * layout["stride"])
            while record := file.read(layout["stride"]):
                yield np.frombuffer(record[:-1], "<u2")
                slot += 1


def materialise(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """Write the shards of ``docs``; one row per sequence: slot, shard, byte offset, documents, tokens, checksum."""
    found = sequences(docs, scratch, **options)
    write_shards(found, scratch.root)
    return found.table.select(
        "slot", "shard", F.col("at").alias("byte_offset"), "n_tokens", "doc_ids", F.crc32("payload").alias("crc32")
    )


@query("op6_token_shards")
def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents in training order; the result lists every sequence."""
    return materialise(read(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "tokens"))
