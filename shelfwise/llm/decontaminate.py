"""Benchmark decontamination by spaced seeds.

A mask picks six of at most 10 neighbouring words and ignores the others; the
picked words of every window are hashed, in the test items and in the documents.
A substituted word leaves the windows alone whose masks ignore it.  The masks
are chosen together: whatever the verification accepts has a window that one of
them matches.  Documents are
filtered against a bitmap of the test hashes of fixed size, the few hits left
are joined with the test hashes, and each (document, item, offset) is verified:
word by word along the offset, the best-scoring stretch of matches and
substitutions must be long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, packed, read, unpacked
from shelfwise.llm.registry import query
from shelfwise.llm.shingles import mix64, word_hashes

# Masks, 1 for the words that count.  Every stretch of LEAST_WORDS matches or more, SHARE of it or more and
# nowhere below zero with PENALTY, has a window where all words of some mask match (tested up to 60 words).
MASKS = ("111111", "110001111", "101010111", "1100101011", "1010011011", "1110100101", "1110100011")
#: Items of fewer words have no seeds.
ITEM_WORDS = 8
#: Words that must match in a stretch, and their share of it.
LEAST_WORDS, SHARE = 10, 0.75
#: A stretch loses so much by a substitution.
PENALTY = 1.5
#: Bits of the bitmap (4 MB), whatever the size of the benchmark; each hash sets two.
BITS = 1 << 25
_GOLD = 0x9E3779B97F4A7C15

_HITS = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("hash", T.LongType())]))


def masked_hashes(words: np.ndarray, counts: np.ndarray, mask: str, name: int) -> tuple[np.ndarray, np.ndarray]:
    """Place (in all words) and hash of every window of a mask that lies in one text."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    value = np.full(len(at), (name + 1) * _GOLD & (2**64 - 1), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            value = mix64(value + words[at + k])
    return at, value


def seed_hits(texts: list[str | None], bitmap: np.ndarray | None, items: bool) -> list[list[tuple[int, int]]]:
    """(word offset, hash) of each text's windows, of those in the bitmap if there is one.

    Items of fewer than ITEM_WORDS words have none.
    """
    words, counts = word_hashes(texts, folded=True)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for name, mask in enumerate(MASKS):
        at, value = masked_hashes(words, counts, mask, name)
        if items:
            long = counts[owner[at]] >= ITEM_WORDS
            at, value = at[long], value[long]
        if bitmap is not None:
            found = _bits(bitmap, value) & _bits(bitmap, mix64(value))
            at, value = at[found], value[found]
        for i, place, h in zip(owner[at], at - first[owner[at]], value.view(np.int64), strict=True):
            out[i].append((int(place), int(h)))
    return out


def _bits(bitmap: np.ndarray, value: np.ndarray) -> np.ndarray:
    at = value % np.uint64(BITS)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


@F.pandas_udf(_HITS)
def _item_seeds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series(seed_hits(batch.tolist(), None, True))


def _bit_rows(values: pd.Series) -> pd.Series:
    value = values.to_numpy().view(np.uint64)
    both = np.stack([value % np.uint64(BITS), mix64(value) % np.uint64(BITS)], 1)
    return pd.Series(both.astype(np.int64).tolist())


def bitmap_of(seeds: DataFrame, hash_col: str = "hash") -> np.ndarray:
    """Bitmap of all test hashes, put together on the executors; at most BITS / 64 numbers come to the driver."""
    bits = F.explode(F.pandas_udf(_bit_rows, T.ArrayType(T.LongType()))(F.col(hash_col)))
    word = F.shiftright("bit", 6)
    rows = (
        seeds.select(bits.alias("bit"))
        .groupBy(word.alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
        .toPandas()
    )
    bitmap = np.zeros(BITS // 64, np.uint64)
    bitmap[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


_STRETCH = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "words", "matched")])


def best_stretch(doc: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int, int]:
    """(start in the document, words, matched words) of the best stretch along one offset."""
    lo, hi = max(0, -offset), min(len(item), len(doc) - offset)
    same = doc[lo + offset : hi + offset] == item[lo:hi]
    total = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, -PENALTY))))
    lowest = np.minimum.accumulate(total)
    end = int((total - lowest).argmax())
    start = int(total[: end + 1].argmin())
    return lo + offset + start, end - start, int(same[start:end].sum())


def counts_as_found(stretch: tuple[int, int, int], item_words: int) -> bool:
    _, words, matched = stretch
    return matched >= min(LEAST_WORDS, item_words) and matched >= SHARE * words


@F.pandas_udf(_STRETCH)
def _verify(texts: pd.Series, items: pd.Series, offsets: pd.Series) -> pd.DataFrame:
    rows = []
    for text, item, some in zip(texts, items, offsets, strict=True):
        doc, own = word_hashes([text], folded=True)[0], word_hashes([item], folded=True)[0]
        # A longer stretch that does not count must not hide one that does, at another offset.
        found = (best_stretch(doc, own, int(o)) for o in some)
        rows.append(max(found, key=lambda s: (counts_as_found(s, len(own)), s[2], -s[1], -s[0])))
    return pd.DataFrame(rows, columns=["start", "words", "matched"], dtype="int32")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(_key, item, start, words, matched): md5 of a document's text, and the test items found in it.

    A stretch counts with LEAST_WORDS matching words (or all of an item with
    fewer) that are SHARE of it or more.  Items of fewer than 8 words are never
    found; null texts are empty.  Equal documents are looked at once.
    """
    item_text = F.coalesce(F.col(item_text_col), F.lit(""))
    tests = scratch.table(items.select(F.col(item_col).alias("item"), item_text.alias("item_text")).distinct(), "items")
    seeds = tests.select("item", "item_text", F.explode(_item_seeds("item_text")).alias("s"))
    seeds = scratch.table(seeds.select("item", "item_text", F.col("s.at").alias("item_at"), F.col("s.hash").alias("hash")), "seeds")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(seeds))

    @F.pandas_udf(_HITS)
    def doc_seeds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = batch.tolist(), []
            for at in range(0, len(texts), 128):
                out += seed_hits(texts[at : at + 128], shared.value, False)
            yield pd.Series(out)

    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = docs.select(text.alias("doc_text")).withColumn("_hits", doc_seeds("doc_text")).where(F.size("_hits") > 0)
    hits = hits.withColumn("_key", F.unhex(F.md5("doc_text"))).groupBy("_key").agg(
        F.first("doc_text").alias("doc_text"), F.first("_hits").alias("_hits")
    )
    suspects = scratch.table(hits, "suspects")
    places = suspects.select("_key", F.explode("_hits").alias("h")).select("_key", "h.at", "h.hash").join(
        seeds.select("item", "item_text", "item_at", "hash"), "hash"
    )
    offsets = places.groupBy("_key", "item", "item_text").agg(F.collect_set(F.col("at") - F.col("item_at")).alias("offsets"))
    found = (
        offsets.join(suspects.select("_key", "doc_text"), "_key")
        .withColumn("_s", _verify("doc_text", "item_text", "offsets"))
        .select("_key", "item", "item_text", "_s.*")
    )
    length = _n_words("item_text")
    return found.where(
        (F.col("matched") >= F.least(F.lit(LEAST_WORDS), length)) & (F.col("matched") >= SHARE * F.col("words"))
    ).select("_key", "item", "start", "words", "matched")


@F.pandas_udf(T.IntegerType())
def _n_words(texts: pd.Series) -> pd.Series:
    return pd.Series(word_hashes(texts.tolist(), folded=True)[1].astype("int32"))


def text_key(text_col: str = "text"):
    """Key that ``contaminated`` gives a document."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def clean(docs: DataFrame, items: DataFrame, scratch: Scratch, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that contain a test item."""
    keys = scratch.table(contaminated(docs, items, scratch, text_col).select(F.col("_key").alias("key")).distinct(), "keys")
    return packed(docs, key=text_key(text_col)).join(keys, "key", "left_anti").select(*unpacked(docs.columns))


@query("op2_decontaminate_spaced_seeds")
def op2_decontaminate_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) overlap: where it starts, its words and how many match."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "leaks")
    found = scratch.table(contaminated(docs, read(spark, sf_dir, "benchmark"), scratch), "found")
    return (
        docs.select("doc_id", text_key().alias("_key")).join(found, "_key").select(
            "doc_id", F.col("item").alias("item_id"), F.col("start").cast("long"), F.col("words").cast("long"),
            F.col("matched").cast("long"),
        )
    )
