"""Fill-in-the-middle: texts cut in units into prefix, middle and suffix, rearranged behind marks.

One ``fullmatch`` of ``(unit)*`` by the ``regex`` library keeps every repetition of its group, so
``match.ends(1)`` gives the number of units and every place a text may be cut at; the two cuts are
looked up in that list. The draw of each document comes from a hash of its id: reruns agree, and
no row depends on another. Restoring needs no match: none of the marks occurs in a rearranged
text, so a split at the marks gives the three parts back (column functions only).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.llm.arrays import CHUNK_BYTES, with_input

LINES = r"[^\n]*+\n|[^\n]++"  # possessive: a line without an end costs one pass, not a retreat
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def draws(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearrange(text: str, drawn: tuple[int, int, int, int], units: regex.Pattern, rate: int, spm: int) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    ends = units.fullmatch(text).ends(1)
    n, (one, two, third, fourth) = len(ends), drawn
    if not text or third % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, second = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if fourth % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    df: DataFrame, unit: str = LINES, seed: int = 7, rate: int = 100, spm: int = 50, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Add ``n`` (units of the whole text), ``form`` (psm, spm or plain), ``prefix_chars``,
    ``middle_chars`` (code points, null if plain) and ``output``.

    ``unit`` is a pattern that cannot match empty and whose repetitions cover any text, such as
    lines. ``rate`` of 100 documents are rearranged, ``spm`` of 100 of those with the suffix first.
    A null text counts as empty; an empty text, and one that holds a mark, stays plain. A null id
    draws like an empty one; repeated rows come out alike. The text column goes, as ``output`` has
    all of it; columns named like an added one are replaced and all others are kept. Texts are
    handled one at a time, so memory follows the longest text.
    """
    units = regex.compile(f"({unit})*")
    with_id = df.withColumn("__id", F.col(f"`{doc_id}`").cast("string"))
    source, rest, schema = with_input(with_id, text, [text, *ADDED])
    at = rest.index("__id") + 1
    names = [c for c in rest if c != "__id"]
    places = [i + 1 for i, c in enumerate(rest) if c != "__id"]
    schema = type(schema)([f for f in schema.fields if f.name != "__id"])
    for name, kind in ADDED.items():
        schema = schema.add(name, kind)
    kinds = [pa.string() if kind == "string" else pa.int64() for kind in ADDED.values()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, made = 0, 0, []
            for row in range(batch.num_rows):
                whole = batch.column(0)[row].as_py() or ""
                made.append(rearrange(whole, draws(batch.column(at)[row].as_py(), seed), units, rate, spm))
                held += len(whole)
                if held > CHUNK_BYTES or row + 1 == batch.num_rows:
                    kept = [batch.column(i).slice(begin, len(made)) for i in places]
                    added = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*kept, *added], names=[*names, *ADDED])
                    begin, held, made = row + 1, 0, []

    return source.mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text that ``output`` was made from."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(F.col(form) == "psm", F.concat(part(1), part(3), part(2)))
        .when(F.col(form) == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(F.col(output))
    )


FILL_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM lines
), cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
