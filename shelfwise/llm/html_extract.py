"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A block's features are the tags and marks of the elements around it and a few
properties of its text; neighbouring blocks in one parent, and in different
parents, have transition weights of their own.  Weights are trained on labelled
pages put together by rule; Viterbi finds the best labelling of a page.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import read
from shelfwise.llm.html_blocks import Block, blocks
from shelfwise.llm.html_pages import labelled_pages
from shelfwise.llm.registry import query

#: Pages the field is trained on, passes over them, and the weight of the squared norm.
TRAIN_PAGES, STEPS, RIDGE = 1200, 200, 0.02


def path_features(path: tuple[str, ...]) -> list[str]:
    """Tags and marks around a block."""
    out = set()
    for element in path:
        tag, *marks = element.split(" ")
        out.add(f"tag {tag}")
        for mark in marks:
            out.add(f"mark {mark}")
            if mark.endswith("s") and len(mark) > 3:
                out.add(f"mark {mark[:-1]}")
    last = [element.split(" ")[0] for element in path[-2:]]
    out.add("own " + (last[-1] if last else ""))
    out.add("two " + "/".join(last))
    return sorted(out)


def text_features(block: Block) -> list[str]:
    """Length, links, ends and odd characters of a block's text."""
    text = block.text
    words = text.count(" ") + 1
    out = [f"words {min(words, 64).bit_length()}", f"links {min(4, 4 * block.link_chars // max(1, len(text)))}"]
    out.append("stop" if text[-1] in ".!?…:;\"”»" else "no stop")
    if "©" in text:
        out.append("copyright")
    if "|" in text or "·" in text or "»" in text:
        out.append("separator")
    return out


class Field:
    """Weights of label 1 against 0 per feature, and transitions [same parent][from][to]."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray, start: float):
        self.weights, self.moves, self.start = weights, moves, start
        self._of_path = lru_cache(maxsize=20_000)(
            lambda path: sum(self.weights.get(f, 0.0) for f in path_features(path))
        )

    def __reduce__(self):
        return Field, (self.weights, self.moves, self.start)

    def labels(self, page: list[Block]) -> list[int]:
        """The best labelling of a page's blocks."""
        if not page:
            return []
        moves = self.moves.tolist()
        back = []
        score = (0.0, 0.0)
        for i, block in enumerate(page):
            own = self._of_path(block.path) + sum(self.weights.get(f, 0.0) for f in text_features(block))
            if i == 0:
                score = (0.0, own + self.start)
                continue
            m = moves[block.parent == page[i - 1].parent]
            from0, from1 = (score[0] + m[0][0], score[1] + m[1][0]), (score[0] + m[0][1], score[1] + m[1][1])
            back.append((from0[1] > from0[0], from1[1] > from1[0]))
            score = (max(from0), max(from1) + own)
        at = int(score[1] > score[0])
        out = [at]
        for step in reversed(back):
            at = int(step[at])
            out.append(at)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        """Blocks of the article, in page order, one to a line; empty for null and for pages without one."""
        found = blocks(page)
        return "\n".join(b.text for b, keep in zip(found, self.labels(found), strict=True) if keep)

    @staticmethod
    def fit(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, ridge: float = RIDGE) -> Field:
        """Most likely weights given the labels, by Adam on all pages at once; without any block, zeros."""
        pages = [p for p in pages if p[0]]
        if not pages:
            return Field({}, np.zeros((2, 2, 2)), 0.0)
        names: dict[str, int] = {}
        longest = max((len(p[0]) for p in pages), default=0)
        n = len(pages)
        feature, place = [], []
        label, same, inside = np.zeros((n, longest), int), np.zeros((n, longest), int), np.zeros((n, longest), bool)
        for r, (page, labels) in enumerate(pages):
            for c, block in enumerate(page):
                for f in path_features(block.path) + text_features(block):
                    feature.append(names.setdefault(f, len(names)))
                    place.append(r * longest + c)
                label[r, c], inside[r, c] = labels[c], True
                same[r, c] = c > 0 and page[c - 1].parent == block.parent
        feature, place = np.array(feature, int), np.array(place, int)
        size = len(names)
        theta, m1, m2 = np.zeros(size + 9), np.zeros(size + 9), np.zeros(size + 9)
        rows = np.arange(n)
        for step in range(1, steps + 1):
            w, moves, start = theta[:size], theta[size : size + 8].reshape(2, 2, 2), theta[-1]
            own = np.bincount(place, w[feature], n * longest).reshape(n, longest)
            unary = np.stack([np.zeros_like(own), own], -1)
            unary[:, 0, 1] += start
            # Forward and backward sums in logarithms; a page's last blocks stand still beyond its end.
            ahead = np.zeros((n, longest, 2))
            ahead[:, 0] = unary[:, 0]
            for t in range(1, longest):
                step_to = ahead[:, t - 1, :, None] + moves[same[:, t]]
                moved = np.logaddexp(step_to[:, 0], step_to[:, 1]) + unary[:, t]
                ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
            behind = np.zeros((n, longest, 2))
            grad_moves = np.zeros((2, 2, 2))
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            for t in range(longest - 1, 0, -1):
                onward = moves[same[:, t]] + (unary[:, t] + behind[:, t])[:, None, :]
                pair = np.exp(ahead[:, t - 1, :, None] + onward - total[:, None, None]) * inside[:, t, None, None]
                pair[rows, label[:, t - 1], label[:, t]] -= inside[:, t]
                np.add.at(grad_moves, same[:, t], pair)
                moved = np.logaddexp(onward[:, :, 0], onward[:, :, 1])
                behind[:, t - 1] = np.where(inside[:, t, None], moved, behind[:, t])
            shape = np.exp(ahead + behind - total[:, None, None])[:, :, 1]
            error = np.where(inside, shape - label, 0.0)
            grad = np.concatenate(
                [np.bincount(feature, error.reshape(-1)[place], size), grad_moves.reshape(-1), [error[:, 0].sum()]]
            )
            grad += ridge * theta
            m1 += 0.1 * (grad - m1)
            m2 += 0.01 * (grad * grad - m2)
            theta = theta - 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        weights = {f: float(theta[i]) for f, i in names.items()}
        return Field(weights, theta[size : size + 8].reshape(2, 2, 2), float(theta[-1]))


def trained(pages: int = TRAIN_PAGES, seed: int = 3) -> Field:
    """A field fit on that many labelled pages."""
    return Field.fit([(blocks(page), labels) for page, labels in labelled_pages(pages, seed)])


def extract(df: DataFrame, field: Field, html_col: str = "html", out: str = "main_text") -> DataFrame:
    """``df`` with the main text of its pages; empty where there is none and for null."""

    @F.pandas_udf(T.StringType())
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(field.main_text)

    return df.withColumn(out, main_text(F.coalesce(F.col(html_col), F.lit(""))))


@query("op4_html_crf")
def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"), trained(), out="text")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
