"""The main text of web pages: boosted trees over DOM nodes, decoded down the tree.

Nodes are block elements and text blocks. Features are the node's tag and attribute tokens, those
of its ancestors, density and length of its subtree, depth and statistics of its siblings. The
trees say of each node whether it holds main text. Decoding picks the set of nodes with the
largest sum of scores in which every kept node's ancestors are kept: a subtree whose sum isn't
positive goes as a whole, so no text is kept inside a rejected part, nor a part without text.

The trees are trained here, on ``TEACHING`` generated pages of many layouts (``teaching``); the
bound is on the training only, every page is extracted.

Cases: a null or empty html, or a page without main text, gives the empty text. Pages that are cut
off in the middle of a tag, with unclosed or stray tags, are read as far as they go. Rows are
independent; null or repeated page_ids, urls and other columns make no difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.boosting import Trees
from cohortlake.llm.common import batch, prepare
from cohortlake.llm.dom import Page
from cohortlake.llm.teaching import pages as teaching_pages

#: Pages that the trees are trained on.
TEACHING = 1500
#: Pages whose nodes are scored together.
TOGETHER = 256


def labelled(source: str, truth: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Features of a teaching page's nodes and whether each is or holds main text."""
    page = Page(source)
    y = np.zeros(len(page.tag))
    blocks = [i for i, text in enumerate(page.text) if text]
    if len(blocks) != len(truth):
        raise ValueError(f"{len(blocks)} text blocks, {len(truth)} were written")
    for i, main in zip(blocks, truth, strict=True):
        while main and i >= 0 and not y[i]:
            y[i], i = 1, page.parent[i]
    return page.features(), y


@cache
def trained(count: int = TEACHING) -> Trees:
    rows = [labelled(*page) for page in teaching_pages(count)]
    x, y = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    return Trees().fit(x, y, np.ones(len(y)))


def decode(page: Page, scores: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the best set that is closed under ancestors. The root is always kept,
    and an element whose text blocks all go brings nothing."""
    best = scores.astype(np.float64).copy()
    best[0] = 0
    below = np.zeros(len(best))
    for i in range(len(best) - 1, 0, -1):
        best[i] = scores[i] + below[i] if page.text[i] or below[i] > 0 else 0
        if best[i] > 0:
            below[page.parent[i]] += best[i]
    keep = best > 0
    keep[0] = True
    for i in range(1, len(best)):
        keep[i] &= keep[page.parent[i]]
    return keep


def main_texts(sources: list[str], trees: Trees) -> list[list[str]]:
    """The main text blocks of each page."""
    pages = [Page(source) for source in sources]
    features = [page.features() for page in pages]
    scores = trees.logits(np.concatenate(features))
    out, at = [], 0
    for page in pages:
        keep = decode(page, scores[at : at + len(page.tag)])
        at += len(page.tag)
        out.append([text for text, kept in zip(page.text, keep, strict=True) if kept and text])
    return out


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, blocks) of every row of (page_id, url, html)."""
    prepare(pages.sparkSession)
    model = trees or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sources = [h or "" for h in part.column("html").to_pylist()]
            blocks: list[list[str]] = []
            for begin in range(0, len(sources), TOGETHER):
                blocks += main_texts(sources[begin : begin + TOGETHER], model)
            texts = ["\n".join(b) for b in blocks]
            yield batch(
                ["page_id", "url", "text", "n_chars", "blocks"],
                part.column("page_id"),
                part.column("url"),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
                pa.array(blocks, pa.list_(pa.string())),
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return rows.mapInArrow(
        run, "page_id long, url string, text string, n_chars long, blocks array<string>"
    )
