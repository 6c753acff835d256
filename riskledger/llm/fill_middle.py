"""Fill-in-the-middle texts: a document cut in three, with the middle moved to the end.

A text is a run of lines (each with its line end). Two numbers from a hash of the id say after
how many lines the prefix and the middle end; further ones choose whether the text is
transformed and in which order the parts are put (prefix-suffix-middle or suffix-prefix-middle).

Cuts are made in bytes and reported in characters. A block of texts is one byte array; between
the two stands a sparse exception index: the places of the characters of more than one byte and
the running sum of their excess bytes. A binary search in it turns a byte place into a character
place; where a block has no such characters the two are the same number. Lines are found by one
search for line ends; nothing is done per character.

Texts are taken apart again from the output and the form alone (``restore``): a transformed text
has none of the three markers, so each marker occurs once.

Defined cases: a null counts as an empty text; empty texts and those with a marker in them stay
plain; without a doc_id the text stays plain; long texts are handled whole; each row is handled
by itself, so repeated rows give repeated results and an empty table an empty one; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import Block, blocks
from riskledger.llm.storage import bound_batches

#: Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percentages of texts that are transformed, and of these that have the suffix first.
RATE, SUFFIX_FIRST = 100, 50

RESULT = "doc_id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output STRING"


@dataclass(frozen=True)
class Settings:
    seed: int = SEED
    rate: int = RATE
    suffix_first: int = SUFFIX_FIRST


class Characters:
    """Character places of byte places in one block."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        width = data[lead]
        excess = 1 + (width >= 0xE0).astype(np.int64) + (width >= 0xF0)
        self.places = lead
        self.excess = np.r_[0, np.cumsum(excess)]

    def before(self, places: np.ndarray) -> np.ndarray:
        """Characters before each byte place (which is at the border of a character)."""
        if not len(self.places):
            return places
        return places - self.excess[np.searchsorted(self.places, places)]


def lines(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all lines in the block, and bounds: those of text i are bounds[i]:bounds[i + 1].

    A line ends behind its line feed, or with the text.
    """
    ends = np.zeros(len(block.data) + 1, bool)
    ends[1:] = block.data == 0x0A
    filled = block.offsets[1:] > block.offsets[:-1]
    ends[block.offsets[1:][filled]] = True
    ends = np.flatnonzero(ends)
    return ends, np.searchsorted(ends, block.offsets, side="right")


def draws(doc_ids: list[int], seed: int) -> np.ndarray:
    """Four numbers for each id."""
    numbers = [hashlib.sha256(f"{seed}:{i}".encode()).digest()[:16] for i in doc_ids]
    return np.frombuffer(b"".join(numbers), ">u4").reshape(-1, 4).astype(np.int64)


def cut_block(block: Block, doc_ids: list[int | None], settings: Settings) -> dict[str, list]:
    """Forms, cuts and outputs of a block's texts."""
    ends, bounds = lines(block)
    n = np.diff(bounds)
    known = np.array([i is not None for i in doc_ids], bool)
    h = draws([i or 0 for i in doc_ids], settings.seed)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # Byte places of the cuts: the text's start, or the end of that many lines.
    stops = np.r_[ends, 0]
    first, last = block.offsets[:-1], block.offsets[1:]
    at = [
        np.where(k > 0, stops[np.clip(bounds[:-1] + k - 1, 0, len(ends))], first) for k in cuts.T
    ]
    moved = known & (n > 0) & (h[:, 2] % 100 < settings.rate)
    characters = Characters(block.data)
    begin, a, b = (characters.before(x) for x in (first, *at))
    raw = block.data.tobytes()
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    suffix_first = h[:, 3] % 100 < settings.suffix_first
    rows = zip(first.tolist(), at[0].tolist(), at[1].tolist(), last.tolist(), moved, suffix_first)
    for s, x, y, e, move, spm in rows:
        if not move or any(raw.find(m, s, e) >= 0 for m in markers):
            forms.append("plain")
            outputs.append(raw[s:e])
            continue
        head, tail = (markers[0], raw[s:x]), (markers[1], raw[y:e])
        forms.append("spm" if spm else "psm")
        parts = (*tail, *head) if spm else (*head, *tail)
        outputs.append(b"".join((*parts, markers[2], raw[x:y])))
    plain = np.array([f == "plain" for f in forms], bool)
    return {
        "n": n,
        "form": forms,
        "prefix_chars": pa.array(a - begin, pa.int64(), mask=plain),
        "middle_chars": pa.array(b - a, pa.int64(), mask=plain),
        "output": pa.array(outputs, pa.binary()).cast(pa.string()),
    }


def restore(output: str, form: str) -> str:
    """The text an output was made of."""
    if form == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = head.removeprefix(PREFIX).partition(SUFFIX)
    else:
        suffix, _, prefix = head.removeprefix(SUFFIX).partition(PREFIX)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``.

    ``n`` is the number of lines, ``form`` plain, psm or spm; the two lengths are in characters
    and null for plain texts. Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    chosen = settings or Settings()

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for block in blocks(batch.column("text")):
                own = doc_ids.slice(block.first, len(block))
                found = cut_block(block, own.to_pylist(), chosen)
                yield pa.RecordBatch.from_pydict({"doc_id": own, **found})

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInArrow(transform, RESULT)


def restored(outputs: DataFrame) -> DataFrame:
    """``outputs`` with the column ``restored``: each text rebuilt from output and form.

    The same as ``restore`` in built-in functions; an empty output is an empty text.
    """
    out, form = F.col("output"), F.col("form")

    def between(after: str, until: str | None):
        start = F.instr(out, after) + len(after)
        end = F.length(out) + 1 if until is None else F.instr(out, until)
        return F.substr(out, start, end - start)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    text = F.when(form == "psm", psm).when(form == "spm", spm).otherwise(out)
    return outputs.withColumn("restored", text)


def fill_report(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Figures and digests of the outputs and of the texts rebuilt from them."""
    return restored(fill_in_middle(docs, settings)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode("restored", "UTF-8"), 256).alias("restored_sha256"),
    )


#: The report as DuckDB SQL.
SQL = r"""
WITH source AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         regexp_extract_all(COALESCE(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || doc_id) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
  FROM source
), cut AS (
  SELECT *,
         CASE WHEN h IS NULL OR text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR c >= 100 THEN 'plain'
              WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(a, b)], '') AS prefix,
         array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
