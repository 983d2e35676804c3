"""Token counts of sections by character spans.

A document is encoded once and whole, so tokens are those a model would see.
Every token gets the span of characters it covers; sections are spans too.
Spans are joined by position: both are sorted, so a section's tokens come
from two binary searches. A token that crosses a section's edge is allocated
by an explicit rule:

- ``first``: to the sections that hold its first character
- ``last``: to the sections that hold its last character
- ``share``: to every section by the share of its characters that lie there
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary cuts texts before merging: a fixed value that belongs to it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "share")
SECTIONS = "array<struct<name:string,start:int,end:int>>"


def load_encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def token_spans(text: str, encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token. Tokens that split a character
    both cover it."""
    ends = np.cumsum(sizes[np.asarray(encoding.encode_ordinary(text), dtype=np.int64)])
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    char_of_byte = np.cumsum((data & 0xC0) != 0x80) - 1
    return char_of_byte[np.concatenate([[0], ends[:-1]])] if len(ends) else ends, char_of_byte[ends - 1] + 1


def allocate(first: np.ndarray, end: np.ndarray, begin: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each span [begin, stop), and how many cross one of
    its edges."""
    if rule == "share":
        # the running number of tokens rises evenly over each token's span;
        # tokens that share a split character each cover it
        widths = (end - first).astype(float)

        def upto(x: np.ndarray) -> np.ndarray:
            whole = np.searchsorted(end, x, "right")
            out = whole.astype(float)
            for back in range(4):  # at most four tokens hold one character
                i = whole + back
                ok = i < len(end)
                j = i[ok]
                out[ok] += np.clip(x[ok] - first[j], 0, None) / widths[j]
            return out

        held = upto(stop) - upto(begin)
    elif rule == "first":
        held = np.searchsorted(first, stop, "left") - np.searchsorted(first, begin, "left")
    else:
        held = np.searchsorted(end - 1, stop, "left") - np.searchsorted(end - 1, begin, "left")
    over = lambda x: np.searchsorted(first, x, "left") - np.searchsorted(end, x, "right")
    crossing = over(begin) + over(stop)
    both = np.searchsorted(end, begin, "right")  # a token over both edges counts once
    ok = both < len(end)
    wide = np.zeros(len(begin), dtype=np.int64)
    wide[ok] = (first[both[ok]] < begin[ok]) & (end[both[ok]] > stop[ok])
    return np.asarray(held, dtype=float), crossing - wide


def line_sections(text: Column) -> Column:
    """Lines of a text with their line feeds, named line0, line1, ..."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SECTIONS).alias("out"))

    def step(s: Column, line: Column) -> Column:
        stop = s["at"] + F.length(line) + 1
        name = F.concat(F.lit("line"), F.size(s["out"]).cast("string"))
        return F.struct(
            stop.alias("at"), F.concat(s["out"], F.array(F.struct(name.alias("name"), s["at"].alias("start"), stop.alias("end")))).alias("out")
        )

    return F.aggregate(lines, start, step, lambda s: s["out"])


def field_record(fields: list[str], separator: str = "\n") -> tuple[Column, Column]:
    """The record that joins string columns, and its sections: one per field,
    named after it, with its separator."""
    text = F.concat(*[x for f in fields for x in (F.coalesce(F.col(f).cast("string"), F.lit("")), F.lit(separator))])
    sections, at = [], F.lit(0)
    for f in fields:
        stop = at + F.length(F.coalesce(F.col(f).cast("string"), F.lit(""))) + len(separator)
        sections.append(F.struct(F.lit(f).alias("name"), at.cast("int").alias("start"), stop.cast("int").alias("end")))
        at = stop
    return text, F.array(*sections)


def count_section_tokens(
    docs: DataFrame,
    text: Column,
    sections: Column,
    rule: str = "first",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """One row per row of ``docs`` and section: ``id_col``, section_no (from
    0), section, start, end (characters), n_tokens (double for the rule
    ``share``, else long), n_crossing (tokens over one of its edges), and
    doc_tokens of the whole text.

    Sections may overlap, nest and leave gaps; ends beyond the text are cut to
    it. An empty section holds no token. A null text counts as empty; a row
    with null or no sections, or a null section, gives no row for it. Ids may
    be null or repeat. An empty table gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("t_id"), F.coalesce(text, F.lit("")).alias("t_text"), sections.cast(SECTIONS).alias("t_sections"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = load_encoding(vocabulary, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                columns: list[list] = [[] for _ in range(8)]
                ids = part.column(0)
                keep = []
                for i, (whole, spans) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    spans = [(k, s) for k, s in enumerate(spans or []) if s is not None and s["start"] is not None and s["end"] is not None]
                    if not spans:
                        continue
                    first, end = token_spans(whole, encoding, sizes)
                    begin = np.clip([s["start"] for _, s in spans], 0, len(whole))
                    stop = np.maximum(np.clip([s["end"] for _, s in spans], 0, len(whole)), begin)
                    held, crossing = allocate(first, end, begin, stop, rule)
                    keep.extend([i] * len(spans))
                    for c, v in zip(columns, ([k for k, _ in spans], [s["name"] for _, s in spans], begin, stop, held, crossing, [len(first)] * len(spans))):
                        c.extend(v)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(keep, pa.int64())),
                        pa.array(columns[0], pa.int32()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.int32()),
                        pa.array(np.asarray(columns[4], dtype=float)),
                        pa.array(columns[5], pa.int64()),
                        pa.array(columns[6], pa.int64()),
                    ],
                    names=["t_id", "section_no", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"],
                )

    schema = f"t_id {id_type}, section_no int, section string, start int, end int, n_tokens double, n_crossing long, doc_tokens long"
    counted = rows.mapInArrow(work, schema).withColumnRenamed("t_id", id_col)
    return counted if rule == "share" else counted.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
