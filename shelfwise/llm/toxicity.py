"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is its own text in angle brackets and the character 3- to 5-grams of it;
each gram has a hashed row in an embedding table, and a word is the mean of its
rows.  A passage is the mean of the words of a sliding window; a linear softmax
reads it.  A document is as toxic as its most toxic window, so a few words in a
long text are not averaged away.  Embeddings and softmax are trained together,
in numpy, on a bounded sample of labelled texts; unseen misspellings share most
grams with the words they come from.

Scoring needs only the difference of the two softmax columns seen through the
embedding table: one number per hashed gram, 1 MB whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import hash32, packed, read, unpacked
from shelfwise.llm.registry import query

ROWS = 1 << 18
WIDTH = 8
WINDOW = 4
#: Labelled texts of each class the model is fit on, about, at most.
TRAIN_EACH = 1200
BATCH, RATE = 32, 0.5
#: Texts visited in training, whole passes over the sample; a small sample is passed more often.
VISITS = 15_000
#: Share of training steps in which the words of the window are misspelt.
MISSPELT = 0.5
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


def words_of(text: str | None) -> list[str]:
    """Lower-case words of a text; none for null."""
    return WORD.findall(text.lower()) if text else []


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed grams of all words, one after the other, and where each word's begin."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    left = np.repeat(ends, sizes) - np.arange(len(points))  # characters from here to the word's end
    owner = np.repeat(np.arange(len(marked)), sizes)
    mix = np.uint64(0x9E3779B97F4A7C15)
    ids, owners = [], []
    value = np.zeros(len(points), np.uint64)
    for n in range(1, 6):
        shifted = np.zeros_like(points)
        rest = points[n - 1 :]
        shifted[: len(rest)] = rest
        value = (value + shifted + np.uint64(1)) * mix
        value ^= value >> np.uint64(29)
        if n >= 3:
            inside = left >= n
            ids.append(value[inside])
            owners.append(owner[inside])
    # The whole word, from the sum of its characters' mixed values by place.
    place = np.arange(len(points), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    mixed = (points * mix) ^ ((place + np.uint64(11)) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    total = np.add.reduceat(mixed, starts) if len(marked) else np.zeros(0, np.uint64)
    ids.append(total * mix)
    owners.append(np.arange(len(marked)))
    owner, flat = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owner, kind="stable")
    flat = (flat[order] >> np.uint64(40)).astype(np.int64) % ROWS
    return flat, np.searchsorted(owner[order], np.arange(len(marked)))


def word_values(per_gram: np.ndarray, words: list[str]) -> np.ndarray:
    """Mean over each word's grams."""
    if not words:
        return np.zeros(0)
    flat, begins = grams(words)
    counts = np.diff(np.append(begins, len(flat)))
    return np.add.reduceat(per_gram[flat], begins) / counts


def window_means(values: np.ndarray) -> np.ndarray:
    """Means of all windows of WINDOW words (one of all words if there are fewer)."""
    size = min(WINDOW, len(values))
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[size:] - total[:-size]) / size


class ToxicModel:
    """Per gram: embedding times difference of the softmax columns; and the bias."""

    def __init__(self, per_gram: np.ndarray, bias: float):
        self.per_gram, self.bias = per_gram, bias

    def logits(self, texts: list, known: dict | None = None) -> np.ndarray:
        """Logit per text; an empty text has the bias.

        Goes through the texts in small groups, so that few words are held at a time.
        """
        known = {} if known is None else known
        out = np.full(len(texts), self.bias)
        for at in range(0, len(texts), 64):
            bags = [words_of(t) for t in texts[at : at + 64]]
            new = list({w for bag in bags for w in bag if w not in known})
            if len(known) + len(new) > 200_000:  # keep the worker's memory bounded
                known.clear()
                new = list({w for bag in bags for w in bag})
            known.update(zip(new, word_values(self.per_gram, new).tolist(), strict=True))
            for i, bag in enumerate(bags, at):
                if bag:
                    out[i] += window_means(np.fromiter(map(known.__getitem__, bag), float, len(bag))).max()
        return out

    @staticmethod
    def fit(texts: list[str], labels: np.ndarray, share: float = 0.5, seed: int = 5) -> ToxicModel:
        """Joint stochastic gradient descent on embeddings and softmax.

        Classes weigh equally in training; at the end the bias goes half the way
        to ``share``, the share of toxic texts where the sample comes from.  The gradient of a text flows through its most
        toxic window, in half of the steps with each word of it misspelt.  With
        one class or no texts the score is constant.
        """
        labels = np.asarray(labels, float)
        if not len(labels) or labels.min() == labels.max():
            constant = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
            return ToxicModel(np.zeros(ROWS), constant)
        rng = np.random.default_rng(seed)
        vocabulary: dict[str, int] = {}
        docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int32) for t in texts]
        spelling = list(vocabulary)
        del vocabulary
        flat, counts = _vocabulary_grams(spelling)
        begins = np.cumsum(counts) - counts
        embed = rng.normal(0, 0.05, (ROWS, WIDTH))
        embed_sq = np.full(ROWS, 1e-3)  # AdaGrad, one sum per row
        soft = rng.normal(0, 0.3, (WIDTH, 2))
        soft_sq = np.full((WIDTH, 2), 1e-3)
        bias, bias_sq = np.zeros(2), np.full(2, 1e-3)
        weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        for _ in range(-(-VISITS // len(docs))):
            turn = rng.permutation(len(docs))
            for at in range(0, len(turn), BATCH):
                batch = [i for i in turn[at : at + BATCH] if len(docs[i])]
                per_gram = embed @ (soft[:, 1] - soft[:, 0])
                used = np.unique(np.concatenate([docs[i] for i in batch])) if batch else np.zeros(0, np.int64)
                if not len(used):
                    continue
                rows, first = _slices(flat, begins, counts, used)
                values = np.add.reduceat(per_gram[rows], first) / counts[used]
                grad_embed: dict[str, list] = {"rows": [], "by": []}
                grad_soft, grad_bias = np.zeros_like(soft), np.zeros(2)
                for i in batch:
                    means = window_means(values[np.searchsorted(used, docs[i])])
                    best = int(means.argmax())
                    picked = docs[i][best : best + WINDOW]
                    if rng.random() < MISSPELT:
                        rows, first = grams([misspell(spelling[w], rng) for w in picked])
                    else:
                        rows, first = _slices(flat, begins, counts, picked)
                    sizes = np.diff(np.append(first, len(rows)))
                    vectors = np.add.reduceat(embed[rows], first) / sizes[:, None]
                    bag = vectors.mean(0)
                    score = bag @ soft + bias
                    score = np.exp(score - score.max())
                    error = score / score.sum() - np.array([1 - labels[i], labels[i]])
                    error *= weight[i]
                    grad_soft += np.outer(bag, error)
                    grad_bias += error
                    by = (soft @ error) / len(picked)
                    grad_embed["rows"].append(rows)
                    grad_embed["by"].append(np.repeat(1 / sizes, sizes)[:, None] * by)
                rows = np.concatenate(grad_embed["rows"])
                by = np.concatenate(grad_embed["by"])
                unique, inverse = np.unique(rows, return_inverse=True)
                total = np.zeros((len(unique), WIDTH))
                np.add.at(total, inverse, by)
                embed_sq[unique] += (total**2).mean(1)
                embed[unique] -= RATE * total / np.sqrt(embed_sq[unique])[:, None]
                soft_sq += grad_soft**2
                soft -= 0.3 * RATE * grad_soft / np.sqrt(soft_sq)
                bias_sq += grad_bias**2
                bias -= 0.3 * RATE * grad_bias / np.sqrt(bias_sq)
        share = min(max(share, 1e-3), 1 - 1e-3)
        bias = bias[1] - bias[0] + 0.5 * np.log(share / (1 - share))
        return ToxicModel(embed @ (soft[:, 1] - soft[:, 0]), float(bias))


def _vocabulary_grams(spelling: list[str], step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all words one after the other, and each word's number of them; a slice of the words at a time."""
    flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(spelling), step):
        rows, begins = grams(spelling[at : at + step])
        flat.append(rows.astype(np.int32))
        counts.append(np.diff(np.append(begins, len(rows))).astype(np.int32))
    return np.concatenate(flat), np.concatenate(counts).astype(np.int64)


def misspell(word: str, rng: np.random.Generator) -> str:
    """A word of five characters or more with one dropped, doubled, swapped or replaced."""
    if len(word) < 5:
        return word
    at, how = int(rng.integers(1, len(word) - 1)), int(rng.integers(4))
    middle = ("", word[at] * 2, word[at + 1] + word[at], chr(97 + int(rng.integers(26))))[how]
    return word[:at] + middle + word[at + 1 + (how == 2) :]


def _slices(flat: np.ndarray, begins: np.ndarray, counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of the given words one after the other, and where each word's begin."""
    sizes = counts[words]
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(first, sizes) + np.repeat(begins[words], sizes)
    return flat[at], first


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", each: int = TRAIN_EACH) -> ToxicModel:
    """Fit on about ``each`` texts of either class, chosen by hash of the id.

    That many texts come to the driver, no more; rows with a null label are
    left out, null texts are empty.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        hash32(F.concat(F.lit("fit|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_hash"),
        F.col(text_col).alias("_text"),
        (F.col(label_col) > 0).cast("int").alias("_label"),
    )
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("_label") == label) & (F.col("_hash") < F.lit(int(min(1.0, each / n) * 4294967296))))
    sample = sorted(map(tuple, rows.where(keep).collect()), key=lambda r: (r[0], r[2], r[1] or ""))
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return ToxicModel.fit([r[1] for r in sample], np.array([r[2] for r in sample]), share)


def score(df: DataFrame, model: ToxicModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability that its text is toxic; whole texts, null as empty."""
    logit = _logit(model, df.sparkSession)
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-logit(F.coalesce(F.col(text_col), F.lit(""))))))


def _logit(model: ToxicModel, spark: SparkSession):
    shared = spark.sparkContext.broadcast((model.per_gram.astype(np.float32), model.bias))

    @F.pandas_udf("double")
    def logit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        per_gram, bias = shared.value
        own, known = ToxicModel(per_gram.astype(float), bias), {}
        for batch in batches:
            yield pd.Series(own.logits(batch.tolist(), known))

    return logit


def clean(df: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """``df`` without the rows with a score of 0.5 or more."""
    scored = score(packed(df, text=F.col(text_col).cast("string")), model)
    return scored.where("score < 0.5").select(*unpacked(df.columns))


def held_out(id_col: str = "doc_id"):
    """True for the fifth of ids that training must not see."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicModel:
    """Model from the labels table, without the held-out fifth."""
    labels = read(spark, sf_dir, "labels").where(F.col("toxic").isNotNull() & ~held_out())
    return train(docs.select("doc_id", "text").join(labels.select("doc_id", "toxic").distinct(), "doc_id"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit_on_tables(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
