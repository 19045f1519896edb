"""Find corpus documents that contain passages of held-out test items.

Winnowing: every window of `window` successive k-grams of words gives its smallest hash as a
fingerprint, so that any run of `gram + window - 1` words two texts share gives both of them the same
fingerprint. Documents and items are joined on fingerprints and each hit is extended word by word to
the whole shared run, which also removes chance hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import materialize

_WORDS = regex.compile(r"[\p{L}\p{N}]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Fingerprints of the items that are broadcast; 16 bytes each and their key.
BROADCAST_FINGERPRINTS = 1_000_000


def words(text: str | None) -> list[str]:
    """Unbroken runs of letters and digits, in lower case."""
    return _WORDS.findall(text.lower()) if text else []


def _hashes(texts: list[str | None], gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the k-grams of words of all texts, the text of each, and the (0-based) word it begins with."""
    split = [words(t) for t in texts]
    flat = [w for own in split for w in own]
    codes, distinct = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, int), [])
    one = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), np.uint64, len(distinct))[codes]
    sizes = np.fromiter((len(own) for own in split), np.int64, len(split))
    first = np.cumsum(sizes) - sizes
    n = max(len(one) - gram + 1, 0)
    hashes = np.zeros(n, np.uint64)
    for j in range(gram):
        hashes = (hashes ^ one[j : j + n]) * _MIX
        hashes ^= hashes >> np.uint64(31)
    text = np.repeat(np.arange(len(split)), sizes)[:n]
    word = np.arange(n) - first[text] if n else np.zeros(0, np.int64)
    whole = word + gram <= sizes[text] if n else np.zeros(0, bool)
    return hashes[whole], text[whole], word[whole]


def fingerprint_rows(texts: list[str | None], gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The winnowed hashes, the text of each, and the word it begins with.

    Of equal smallest hashes in a window the rightmost is kept. A text with fewer k-grams than a
    window gives the smallest of those it has; one with fewer words than a k-gram gives none.
    """
    hashes, text, word = _hashes(texts, gram)
    if not len(hashes):
        return hashes, text, word
    at = np.arange(len(hashes))
    best = at.copy()
    last = np.searchsorted(text, text, side="right") - 1
    for step in range(1, window):
        other = np.minimum(at + step, last)
        best = np.where(hashes[other] <= hashes[best], other, best)
    start = np.searchsorted(text, text, side="left")
    # A window that the text's end cuts short is left out, but for the first of the text.
    full = (at + window - 1 <= last) | (at == start)
    keep = np.unique(best[full])
    return hashes[keep], text[keep], word[keep]


def _fingerprints(df: DataFrame, key: str, text: str, gram: int, window: int, side: str) -> DataFrame:
    """`side`, _h LONG and `side`_at INT: the fingerprints of a table of texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, which, word = fingerprint_rows(batch["text"].tolist(), gram, window)
            yield pd.DataFrame({side: batch[side].to_numpy()[which], "_h": h.view(np.int64), f"{side}_at": word.astype(np.int32)})

    rows = df.select(F.col(key).alias(side), F.col(text).alias("text")).filter(F.col(side).isNotNull() & F.col("text").isNotNull())
    kind = rows.schema[side].dataType.simpleString()
    return rows.mapInPandas(run, f"{side} {kind}, _h long, {side}_at int")


def longest_runs(a: list[str], b: list[str], gaps: list[int]) -> tuple[int, int]:
    """Length and first word (of `a`) of the longest run of equal words that lie `gap` words further on in `a` than in `b`.

    Of equally long ones the first in `a` counts. Each gap costs one comparison along both texts.
    """
    codes = pd.factorize(np.array([*a, *b], object))[0]
    x, y = codes[: len(a)], codes[len(a) :]
    best = (0, 0)
    for gap in gaps:
        at = max(gap, 0)
        n = min(len(x) - at, len(y) - max(-gap, 0))
        if n <= 0:
            continue
        same = np.concatenate([[False], x[at : at + n] == y[max(-gap, 0) : max(-gap, 0) + n], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        starts, sizes = turns[::2], turns[1::2] - turns[::2]
        if len(sizes):
            top = int(sizes.argmax())
            best = max(best, (int(sizes[top]), -(at + int(starts[top]))))
    return best[0], -best[1]


def leaks(
    corpus: DataFrame,
    corpus_id: str,
    corpus_text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    min_words: int = 12,
    gram: int = 8,
) -> DataFrame:
    """doc, item, shared_words INT, doc_word INT: each document and item that share a run of `min_words` words.

    `shared_words` is the longest such run and `doc_word` the (0-based) word of the document where the
    first of the longest begins. Rows with a NULL id are left out; NULL and empty texts and texts of fewer
    words share nothing. Repeated rows of an id are one case. Texts are compared whole. Every run of at
    least `min_words` words is found, because `gram` plus the window spans exactly that many.
    """
    window = min_words - gram + 1
    if window < 1:
        raise ValueError("gram must not exceed min_words")
    # The items' fingerprints are written first, so that their number is known before they may be broadcast.
    tested = materialize(_fingerprints(items, item_id, item_text, gram, window, "item"), "fingerprints").df
    if tested.count() <= BROADCAST_FINGERPRINTS:
        tested = F.broadcast(tested)
    met = _fingerprints(corpus, corpus_id, corpus_text, gram, window, "doc").join(tested, "_h")
    # A run lies at one gap between the places in both texts; a document and an item have at most as many gaps as words.
    gaps = met.select("doc", "item", (F.col("doc_at") - F.col("item_at")).alias("gap")).distinct()
    hits = materialize(gaps.groupBy("doc", "item").agg(F.collect_list("gap").alias("gaps")), "hits").df

    # The texts of the few documents that were hit are looked up again, once for each item, to extend the hits.
    docs = corpus.select(F.col(corpus_id).alias("doc"), F.col(corpus_text).alias("doc_text")).filter("doc_text IS NOT NULL")
    tests = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("item_text")).filter("item_text IS NOT NULL")
    pairs = docs.join(hits, "doc").join(tests, "item").select("doc", "item", "gaps", "doc_text", "item_text")

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            split = {t: words(t) for t in {*batch["doc_text"], *batch["item_text"]}}
            runs = [longest_runs(split[d], split[t], g) for d, t, g in zip(batch["doc_text"], batch["item_text"], batch["gaps"])]
            found = pd.DataFrame(runs, columns=["shared_words", "doc_word"])
            found = pd.concat([batch[["doc", "item"]].astype(object).reset_index(drop=True), found], axis=1)
            yield found[found["shared_words"] >= min_words]

    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("doc", "item"))
    runs = pairs.mapInPandas(extend, f"{kinds}, shared_words int, doc_word int")
    best = F.max(F.struct("shared_words", (-F.col("doc_word")).alias("_w"))).alias("_b")
    return runs.groupBy("doc", "item").agg(best).select(
        "doc", "item", F.col("_b.shared_words").alias("shared_words"), (-F.col("_b._w")).alias("doc_word")
    )
