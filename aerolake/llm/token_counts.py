"""Token counts per section, by offset-mapped attribution.

A whole document is encoded once.  The ids' byte lengths give every token's
character span, spans are joined with the document's sections as intervals, and a
token that touches several sections is allocated by a rule:

    start     the section that holds the token's first character (none: nowhere)
    majority  the section that holds most of its characters, the first of equals
    fraction  every section, by its share of the token's characters in sections

Sections are the document's lines (with their line end), or the column ``sections``
of (name, start, end) character spans, in order and without overlap.

Defined results: a null or empty text has one empty line, and no section when a
column gives none; empty sections count 0; tokens outside all sections are counted
under section -1, which is returned only for documents that have such tokens.
A token that holds part of a character has that character's span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.tokens import Encoder, shared_encoder, slices_by_bytes, token_bytes

RULES = ("start", "majority", "fraction")


def character_spans(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) in characters of consecutive tokens of ``sizes`` bytes over UTF-8 ``data``."""
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    characters = np.cumsum((data & 0xC0) != 0x80)
    ends = np.cumsum(sizes)
    return characters[ends - sizes] - 1, characters[ends - 1]


def allocate(token_start, token_end, start, end, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens per section, crossing tokens per section, places of tokens in no section).

    All spans are on one axis, tokens and sections in order; a token covers the
    consecutive sections ``first`` to ``last``.
    """
    tokens, crossing = np.zeros(len(start)), np.zeros(len(start), np.int64)
    filled = np.flatnonzero(end > start)  # empty sections hold no character
    first = np.searchsorted(end[filled], token_start, "right")
    last = np.searchsorted(start[filled], token_end, "left")
    touched = np.maximum(last - first, 0)
    if rule == "start":
        inside = (touched > 0) & (start[filled][np.minimum(first, len(filled) - 1)] <= token_start) if len(filled) else touched > 0
        lost = np.flatnonzero(~inside)
    else:
        inside, lost = touched == 1, np.flatnonzero(touched == 0)
    tokens += np.bincount(filled[first[inside]], minlength=len(start))
    several = np.flatnonzero(touched > 1)
    token = np.repeat(several, touched[several])
    offset = np.arange(len(token)) - np.repeat(np.cumsum(touched[several]) - touched[several], touched[several])
    section = filled[first[token] + offset]
    crossing += np.bincount(section, minlength=len(start))
    if rule != "start" and len(token):
        overlap = np.minimum(token_end[token], end[section]) - np.maximum(token_start[token], start[section])
        heads = np.flatnonzero(offset == 0)
        if rule == "fraction":
            share = overlap / np.repeat(np.add.reduceat(overlap, heads), touched[several])
            np.add.at(tokens, section, share)
        else:
            order = np.lexsort((offset, -overlap, token))
            np.add.at(tokens, section[order][heads], 1)
    return tokens, crossing, lost


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", sections: str | None = None,
                 rule: str = "majority", tokenizer: str | None = None) -> DataFrame:
    """One row per section: key, section (0, 1, ...), name, start_char, end_char, tokens, n_crossing."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")]
    if sections:
        columns.append(F.transform(F.coalesce(sections, F.array()), lambda x: F.struct(
            x["name"].cast("string").alias("name"), x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"))).alias("sections"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes_of = shared_encoder(tokenizer), token_bytes(tokenizer)
        for batch in batches:
            for at, n in slices_by_bytes(batch.column(1)):  # keeps a slice's spans small
                yield attribute(batch.slice(at, n), encoder, sizes_of)

    def attribute(batch: pa.RecordBatch, encoder: Encoder, sizes_of: np.ndarray) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.large_string())
        values = texts.to_pylist()
        ids, n_ids = encoder.encode(texts)
        data = np.frombuffer("".join(values).encode(), np.uint8)
        token_start, token_end = character_spans(data, sizes_of[ids])
        chars = np.array([len(v) for v in values], np.int64)
        base = np.cumsum(chars) - chars
        if sections:
            column = batch.column(2)
            per_doc = np.diff(column.offsets.to_numpy())
            spans = column.flatten()
            names = spans.field(0)
            shift = np.repeat(base, per_doc)
            start, end = spans.field(1).to_numpy() + shift, spans.field(2).to_numpy() + shift
        else:
            # Character places after each line end; a text's last line has none.
            starts = (data & 0xC0) != 0x80
            breaks = np.flatnonzero(data[starts] == 10) + 1
            # A line end that closes a text opens no further line.
            opens = np.concatenate([base, np.setdiff1d(breaks, base + chars)])
            owner = np.concatenate([np.arange(len(base)), np.searchsorted(base + chars, np.setdiff1d(breaks, base + chars), "right")])
            order = np.lexsort((opens, owner))
            start, owner = opens[order], owner[order]
            per_doc = np.bincount(owner, minlength=len(base))
            end = np.append(start[1:], chars.sum())
            last = np.cumsum(per_doc) - 1
            end[last] = base + chars
            names = pa.nulls(len(start), pa.string())
            shift = np.repeat(base, per_doc)
        tokens, crossing, lost = allocate(token_start, token_end, start, end, rule)
        doc = np.repeat(np.arange(len(values)), per_doc)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        of_token = np.repeat(np.arange(len(values)), n_ids)
        outside = np.bincount(of_token[lost], minlength=len(values))
        extra = np.flatnonzero(outside)
        keys = batch.column(0)
        rows = [
            pa.concat_arrays([keys.take(pa.array(doc)), keys.take(pa.array(extra))]),
            pa.array(np.concatenate([place, np.full(len(extra), -1)])),
            pa.concat_arrays([names.cast(pa.string()), pa.nulls(len(extra), pa.string())]),
            pa.concat_arrays([pa.array(start - shift, pa.int64()), pa.nulls(len(extra), pa.int64())]),
            pa.concat_arrays([pa.array(end - shift, pa.int64()), pa.nulls(len(extra), pa.int64())]),
            pa.array(np.concatenate([tokens, outside[extra].astype(float)])),
            pa.array(np.concatenate([crossing, np.zeros(len(extra), np.int64)])),
        ]
        return pa.RecordBatch.from_arrays(rows, ["key", "section", "name", "start_char", "end_char", "tokens", "n_crossing"])

    return docs.select(*columns).mapInArrow(
        run, "key long, section long, name string, start_char long, end_char long, tokens double, n_crossing long")
