"""Removal of repeated passages, found by anchors at difference-cover positions.

Positions whose residue modulo PERIOD is in COVER are anchors. For any two positions there is a shift below PERIOD that
takes both to anchors, so two equal windows of WINDOW words hold an equal pair of anchors of WINDOW - PERIOD + 1 words,
whatever their offsets. Only anchors are hashed and shuffled (4 of 13 positions); those seen in more than one document
are extended to whole windows, and these are compared by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.packed import bucket_count, forward_blocks, receive_blocks, rows, runs, send_blocks, text_size
from tandem.llm.words import WordHashes, covered, mix, small, split_words, text_bytes, window_hashes

WINDOW = 20
#: A perfect difference set: every residue modulo 13 is a difference of two members.
PERIOD, COVER = 13, (0, 1, 3, 9)
BYTES_PER_WORD = 6
LAST = 2**63 - 1


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors; none in texts shorter than a window."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    found = window_hashes(words, window - PERIOD + 1, seed=1)
    at = np.flatnonzero(np.isin(np.arange(len(found)) % PERIOD, COVER))
    return at, found[at]


def _per_document(blocks: DataFrame, turn, dtypes: tuple[str, ...], buckets: int) -> DataFrame:
    """`doc`, `keys`: one row per document with the packed keys that `turn` finds for it, as arrays (keys, documents)."""
    onward = ("u8", "i8", "u8")

    def send(columns):
        keys, doc = turn(columns)
        yield mix(doc.astype(np.uint64)), doc, keys

    def receive(columns):
        spread, doc, keys = columns
        order = np.lexsort((doc, spread))
        doc, keys = doc[order], keys[order]
        edges = runs(doc)
        packed = [keys[i:j].tobytes() for i, j in zip(edges, edges[1:], strict=False)]
        yield from rows([doc[edges[:-1]], packed], [("doc", pa.int64()), ("keys", pa.binary())])

    return receive_blocks(forward_blocks(blocks, send, dtypes, onward, buckets), receive, onward, buckets, "doc bigint, keys binary")


def _shared_anchors(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """`doc`, `keys`: hashes of a document's anchors that another document has too."""
    kinds = ("u8", "i8")

    def send(batches, box):
        hashes = WordHashes()
        for batch in small(batches):
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                _, found = anchors(hashes.of(split_words(text)), window)
                found = np.unique(found)
                yield from box.add(found, np.full(len(found), doc, np.int64))

    def turn(columns):
        keys, doc = columns
        edges = runs(keys)
        differ = np.minimum.reduceat(doc, edges[:-1]) != np.maximum.reduceat(doc, edges[:-1])
        kept = np.repeat(differ, np.diff(edges))
        return keys[kept], doc[kept]

    return _per_document(send_blocks(texts, send, kinds, buckets), turn, kinds, buckets)


def _earlier_windows(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """`doc`, `keys`: hashes of a document's windows that a document with a smaller id has too."""
    kinds = ("u8", "u8", "i8")

    def send(batches, box):
        hashes = WordHashes()
        for batch in small(batches):
            for doc, text, keys in zip(*(batch.column(c).to_pylist() for c in ("doc", "_text", "keys")), strict=True):
                words = hashes.of(split_words(text)) if keys else ()
                if len(words) < window:
                    continue
                at, found = anchors(words, window)
                at = at[np.isin(found, np.frombuffer(keys, np.uint64))]
                # A window that holds the anchor begins at most PERIOD - 1 words before it.
                first = np.maximum(at - PERIOD + 1, 0)
                start = np.flatnonzero(_spans(first, at + 1, len(words) - window + 1))
                one, two = window_hashes(words, window, seed=2)[start], window_hashes(words, window, seed=3)[start]
                one, pick = np.unique(one, return_index=True)
                yield from box.add(one, two[pick], np.full(len(one), doc, np.int64))

    def turn(columns):
        one, two, doc = columns
        several = np.repeat(np.diff(runs(one)) > 1, np.diff(runs(one)))
        one, two, doc = one[several], two[several], doc[several]
        order = np.lexsort((doc, two, one))
        one, two, doc = one[order], two[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        later = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(one) else new
        return one[later], doc[later]

    return _per_document(send_blocks(texts, send, kinds, buckets), turn, kinds, buckets)


def _spans(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.minimum(start, n), 1)
    np.add.at(edges, np.minimum(end, n), -1)
    return np.cumsum(edges[:-1]) > 0


def _attach(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts, each with the packed keys that belong to it, if any. Both uses shuffle the texts alike: once."""
    return texts.join(keys.withColumnRenamed("doc", "_doc").hint("shuffle_hash"), F.col("doc") == F.col("_doc"), "left")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`id`, `n_words`, `n_removed` and `kept`, the words that stay, joined by one space.

    A word goes if it is in a window of `window` consecutive words whose sequence also starts earlier: in a document with
    a smaller id, or before in the same one. Windows are judged on the input. Null texts have no words and texts shorter
    than a window lose none. Rows with equal ids don't count as earlier than each other; a null id is later than all others.
    """
    if window < PERIOD + 1:
        raise ValueError(f"a window needs {PERIOD + 1} words or more")
    texts = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(id).isNull().alias("no_id"), text_bytes(text).alias("_text"))
    words = text_size(docs, text) / BYTES_PER_WORD
    shared = _shared_anchors(texts, window, bucket_count(docs, words * len(COVER) / PERIOD))
    earlier = _earlier_windows(_attach(texts, shared), window, bucket_count(docs, words / 4))

    def strip(batches):
        hashes = WordHashes()
        for batch in small(batches):
            n, removed, kept = [], [], []
            for text, keys in zip(batch.column("_text").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                words = split_words(text)
                n.append(len(words))
                found = window_hashes(hashes.of(words), window, seed=2)
                again = np.zeros(len(found), bool)
                if len(found):
                    _, first = np.unique(found, return_index=True)
                    again[:] = len(first) < len(found)
                    again[first] = False
                    if keys:
                        again |= np.isin(found, np.frombuffer(keys, np.uint64))
                if again.any():
                    gone = covered(np.flatnonzero(again), window, len(words))
                    removed.append(int(gone.sum()))
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("no_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc", "no_id", "n_words", "n_removed", "kept"],
            )

    out = _attach(texts, earlier).mapInArrow(strip, "doc bigint, no_id boolean, n_words bigint, n_removed bigint, kept binary")
    return out.select(F.when(~F.col("no_id"), F.col("doc")).alias(id), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
