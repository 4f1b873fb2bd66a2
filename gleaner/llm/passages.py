"""Removal of passages that stand in an earlier document: of words, and of bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.llm.common import spaced, spans_of_words, text_bytes
from gleaner.llm.fm_index import FMIndex
from gleaner.llm.repeats import Kind, covered
from gleaner.llm.run_index import RunIndex

WINDOW_WORDS = 50
WINDOW_BYTES = 100
WORDS = Kind(WINDOW_WORDS, 8, words=True, within=False, index=FMIndex)
BYTES = Kind(WINDOW_BYTES, 32, words=False, within=True, index=RunIndex)


def without_repeated_words(docs: DataFrame) -> DataFrame:
    """Words covered by a window of 50 whose words also start in a document with a smaller id.

    Per row: ``doc_id, n_words, n_removed, kept`` (the kept words, joined by one space) and
    ``kept_sha256``. Words are runs of anything but ASCII white space, unchanged. A null or empty text
    has no words. Rows that share an id do not remove from each other; a row without an id takes no
    part and keeps all. No rows give no rows; other columns are ignored.
    """

    def finish(batch: pa.RecordBatch, spans: list) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        text = spaced(data, offsets)
        starts, ends = spans_of_words(text)
        bounds = np.searchsorted(starts, offsets + np.arange(len(offsets))).tolist()
        raw = text.tobytes()
        sizes, removed, kept = [], [], []
        for k, (first, last) in enumerate(spans):
            s, e = starts[bounds[k] : bounds[k + 1]], ends[bounds[k] : bounds[k + 1]]
            stay = np.ones(len(s), bool)
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                stay[a:b] = False
            words = [raw[i:j] for i, j in zip(s[stay].tolist(), e[stay].tolist(), strict=True)]
            sizes.append(len(s))
            removed.append(len(s) - len(words))
            kept.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )

    return covered(WORDS, docs, finish, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def without_repeated_bytes(docs: DataFrame) -> DataFrame:
    """Bytes covered by a string of 100 bytes that also starts earlier.

    Earlier is a smaller id, or the same document and an earlier start. Per row: ``doc_id, n_bytes,
    n_removed, n_spans, kept`` (the remaining bytes) and ``kept_sha256``. Texts are UTF-8; null is
    empty; matches do not cross documents. Different texts that share an id are ordered by a hash
    of the text; equal rows are one document, and each of them gets its result. A row without an id
    takes no part and keeps all. No rows give no rows; other columns are ignored.
    """

    def finish(batch: pa.RecordBatch, spans: list) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        raw, cuts = data.tobytes(), offsets.tolist()
        kept = []
        for k, (first, last) in enumerate(spans):
            text, at, pieces = raw[cuts[k] : cuts[k + 1]], 0, []
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                pieces.append(text[at:a])
                at = b
            kept.append(b"".join([*pieces, text[at:]]))
        sizes = np.diff(offsets)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(sizes - np.array([len(t) for t in kept], np.int64), pa.int64()),
                pa.array([len(first) for first, _ in spans], pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return covered(BYTES, docs, finish, schema)
