"""Fill-in-middle transformation of documents as a pipeline of Arrow compute functions.

A unit is a word with the white space before it, or what white space ends a text;
put together, the units of a text are the text.  For a batch of texts the words
and the gaps between them are split into list arrays, flattened with the numbers
of their rows, and joined into one array of units.  A unit's ordinal against its
row's two cuts tells its role; the units of a role are filtered, rebuilt as lists
and joined to the row's prefix, middle and suffix, and these with the markers to
its output.  The draws of a row (form and cuts) are column expressions over a
digest of seed and id, so that a task that runs again draws the same.

Scale: a map over rows, no shuffle, no model, no table on the workers.  A batch
is worked off in slices of at most SLICE bytes of text (a longer text is a slice
of its own), which bounds memory by that and the longest text.

Cases: a null or empty text has no units and stays plain; a text of white space
only is one unit; a text that holds a marker stays plain, so that an output can
be taken apart again; a null id draws as an empty one; rows that repeat wholly
give the same output each; other columns are not carried, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 42, 50, 80
SLICE = 4 << 20
_GAP, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units of a column of texts, the row of each, and the number of units of each row.

    A space is put behind each text, so that splitting at gaps gives its words
    and one empty string more, and at words as many gaps.
    """
    rows = len(texts)
    words = pc.split_pattern_regex(pc.binary_join_element_wise(texts, " ", ""), _GAP)
    parent, flat = np.asarray(pc.list_parent_indices(words)), pc.list_flatten(words)
    first = np.append(True, parent[1:] != parent[:-1])[: len(parent)]
    whole = pa.array(~(first & np.asarray(pc.equal(flat, ""))))  # what stands before a gap at a text's start is no word
    flat, parent = flat.filter(whole), parent[np.asarray(whole)]
    gaps = pc.split_pattern_regex(texts, _WORD)
    units = pc.binary_join_element_wise(pc.list_flatten(gaps), flat, "")
    some = pc.not_equal(units, "")
    units, parent = units.filter(some), parent[np.asarray(some)]
    return units, parent, np.bincount(parent, minlength=rows)


def join_units(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """For each row the chosen units of it, joined."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(parent[chosen], minlength=rows))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), units.filter(pa.array(chosen))), "")


def transform(texts: pa.Array, draw: list[np.ndarray], rate: int = RATE, spm_rate: int = SPM_RATE) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of each text."""
    rows = len(texts)
    units, parent, n = split_units(texts)
    one, two = draw[0] % (n + 1), draw[1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    ordinal = np.arange(len(parent)) - (np.cumsum(n) - n)[parent]
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    prefix, middle, suffix = (join_units(units, parent, role == k, rows) for k in range(3))
    marked = np.zeros(rows, bool)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked |= np.asarray(pc.match_substring(texts, marker))
    plain = pa.array((n == 0) | marked | (draw[2] % 100 >= rate))
    spm = pa.array(draw[3] % 100 < spm_rate)
    join = pc.binary_join_element_wise
    output = pc.if_else(spm, join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""), join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n, pa.int64()),
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
        "output": pc.if_else(plain, texts, output),
    }


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of each row."""
    names = [f"h{k}" for k in range(1, 5)]
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *[h.alias(k) for k, h in zip(names, draws(F.col(doc_id), seed), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, "text", SLICE):
                made = transform(b.column("text"), [np.asarray(b.column(h)) for h in names], rate, spm_rate)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made.values()], names=["doc_id", *made])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; no marker can stand in a piece or across its ends."""

    def between(a: str, b: str) -> Column:
        return F.substring_index(F.substring_index(output, b, 1), a, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
