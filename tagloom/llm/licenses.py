"""License scans: an exact set-similarity join of text blocks with templates.

A block is a run of as many words as the template has. It matches when it holds
the threshold's share of the template's distinct words. Tokens are ordered by
their frequency over all documents: of a template's k distinct words a block
needs n, so it must hold one of the k - n + 1 rarest, its prefix. Only places
near a prefix word are looked at (position), in rows long enough to hold n words
(length), and there each block's distinct template words are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.store import text_or_empty
from tagloom.llm.wordarrays import ALNUM, Words, slices

#: Share of a template's distinct words that a block has to hold.
THRESHOLD = Fraction(4, 5)

#: Phrases whose words must stand one after the other, and labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Sentences by which the licenses are usually invoked, and labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "under the terms of the gnu lesser general public license as published": "lgpl",
    "licensed under a creative commons attribution noncommercial license": "cc-by-nc",
    "licensed under a creative commons attribution sharealike license": "cc-by-sa",
    "subject to the terms of the mozilla public license version 2 0": "mpl-2",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


@dataclass(frozen=True)
class Template:
    """Words of a template and, for each of its distinct words, an index into all
    templates' tokens, rarest first."""

    label: str
    words: tuple[int, ...]
    order: tuple[int, ...]
    need: int
    phrase: bool

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.order[: len(self.order) - self.need + 1]


def _token_table(texts: list[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Tokens of all templates; their hashes sorted, and the token of each hash."""
    tokens = sorted({w for t in texts for w in t.split()})
    column = pa.array(tokens, pa.string())
    hashes = Words(column, ALNUM, lower=True).hashes()
    by = np.argsort(hashes)
    return {t: i for i, t in enumerate(tokens)}, hashes[by], by


def _tokens_of(words: Words, hashes: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The template token that each word is, or -1."""
    own = words.hashes()
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    return np.where(hashes[at] == own, token[at], -1)


def token_counts(rows: DataFrame, hashes: np.ndarray, token: np.ndarray) -> dict[int, int]:
    """How often each template token occurs in all ``rows`` (id, text)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(token), np.int64)
        for batch in rows:
            for part in slices(batch, 0):
                ids = _tokens_of(Words(part.column(0), ALNUM, lower=True), hashes, token)
                seen += np.bincount(ids[ids >= 0], minlength=len(token))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(token))), pa.array(seen)], ["token", "n"])

    counts = rows.select("text").mapInArrow(batches, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in counts.collect()}  # a row a template token


def _matches(t: Template, ids: np.ndarray, words: Words, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks of ``t`` start, and the distinct template words in each."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    long_enough = np.diff(words.first) >= t.need  # length
    member, rare = np.zeros(m + 1, bool), np.zeros(m + 1, bool)
    member[list(t.order)] = True
    rare[list(t.prefix)] = True
    place = np.flatnonzero(rare[ids])
    place = place[long_enough[words.row[place]]]
    if not len(place):
        return none
    size = len(t.words)
    inside = np.flatnonzero(member[ids])
    near = np.searchsorted(place, inside)
    left, right = place[np.maximum(near - 1, 0)], place[np.minimum(near, len(place) - 1)]
    inside = inside[(np.abs(inside - left) < size) | (np.abs(right - inside) < size)]  # position
    by = np.lexsort((inside, ids[inside]))
    q, of = inside[by], ids[inside][by]
    before = np.full(len(q), -1)
    same = of[1:] == of[:-1]
    before[1:][same] = q[:-1][same]
    low = np.maximum(np.maximum(before + 1, q - size + 1), words.first[words.row[q]])
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, q + 1, -1)
    held = np.cumsum(change[:-1])
    start = np.flatnonzero(held >= t.need)
    if t.phrase:
        start = start[(start + size <= words.first[words.row[start] + 1])]
        for k, token in enumerate(t.words):
            start = start[ids[start + k] == token]
    return start, held[start]


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words`` and ``blocks``, an array of
    structs (label, start, end, share, phrase): each place of a phrase, and each
    run of overlapping blocks that meet the threshold with their best share, in
    words from 0, end exclusive. Null and empty texts have no words; repeated rows
    are scanned each; other columns are not read."""
    names, hashes, token = _token_table([*phrases, *templates])
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    counts = token_counts(rows, hashes, token)
    known = []
    for table, phrase in ((phrases, True), (templates, False)):
        for text, label in table.items():
            words = tuple(names[w] for w in text.split())
            order = tuple(sorted(set(words), key=lambda w: (counts.get(w, 0), w)))
            need = len(order) if phrase else ceil(threshold * len(order))
            known.append(Template(label, words, order, need, phrase))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 1):
                words = Words(part.column(1), ALNUM, lower=True)
                ids = _tokens_of(words, hashes, token)
                found: dict[int, list[dict]] = {}
                for t in known if len(words) else ():
                    _note(t, ids, words, found)
                blocks = [found.get(r, []) for r in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(words.first), pa.int64()), pa.array(blocks, kind)],
                    ["doc_id", "n_words", "blocks"],
                )

    def _note(t: Template, ids: np.ndarray, words: Words, found: dict[int, list[dict]]) -> None:
        start, held = _matches(t, ids, words, len(token))
        if not len(start):
            return
        row = words.row[start]
        new = np.ones(len(start), bool)
        if not t.phrase:
            new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + len(t.words))
        at = np.flatnonzero(new)
        best = np.maximum.reduceat(held, at) / len(t.order)
        last = start[np.append(at[1:], len(start)) - 1] + len(t.words)
        for r, a, b, share in zip(row[at].tolist(), start[at].tolist(), last.tolist(), best.tolist(), strict=True):
            base, end = int(words.first[r]), int(words.first[r + 1])
            block = {"label": t.label, "start": a - base, "end": min(b, end) - base, "share": share, "phrase": t.phrase}
            found.setdefault(r, []).append(block)

    fields = [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64()), ("phrase", pa.bool_())]
    kind = pa.list_(pa.struct(fields))
    shown = rows.schema["doc_id"].dataType.simpleString()
    struct = "array<struct<label:string,start:bigint,end:bigint,share:double,phrase:boolean>>"
    return rows.mapInArrow(batches, f"doc_id {shown}, n_words long, blocks {struct}")


def license_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``scan`` over ``documents``; ``score`` is the best
    share of a template that a block holds, 1 for a phrase."""
    base = F.filter("blocks", lambda b: b["phrase"])
    starts = F.transform(base, lambda b: b["start"])
    labels = lambda blocks: F.array_join(F.array_sort(F.array_distinct(F.transform(blocks, lambda b: b["label"]))), ",")
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("blocks")).alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["share"])), F.lit(0.0)).alias("score"),
    )
