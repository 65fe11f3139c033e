"""Token counts of whole texts; huge texts by overlapping chunks.

A text over ``HUGE`` characters is cut into chunks of ``CHUNK`` characters that
reach ``overlap`` characters into the next one. Each chunk is encoded with
offsets by itself, on whatever executor gets it. Neighbours are spliced at the
first character of their overlap that starts a token in both and where the cut
is proven (``pieces``: a space before a character that is certainly no white
space). Texts with an overlap that has no such place are encoded again with
overlaps four times as wide and chunks of four overlaps at least, so in the end
as one chunk.

Null text counts as empty: 0 bytes, 0 tokens. Null and repeated ``doc_id``s
keep a row each. Extra columns are not carried. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import prepare, materialize, text_column, text_slices
from tillroll.llm.pieces import encoder

HUGE = 32_768
CHUNK = 16_384
OVERLAP = 256


def stable_starts(text: str) -> np.ndarray:
    """Characters at which a cut is proven."""
    t = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(t) < 2:
        return np.zeros(0, np.int64)
    after = ((t[1:] > 0x20) & (t[1:] < 0x7F)) | ((t[1:] >= 0xC0) & (t[1:] < 0x1000))
    return np.flatnonzero((t[:-1] == 0x20) & after)


def splice(enc, text: str, begins: bool, ends: bool, core: int, overlap: int) -> tuple[int, int, int]:
    """First and last splice place (characters from the chunk's start, -1 if
    there is none) and the tokens between. ``begins``: a chunk stands before;
    ``ends``: one follows."""
    e = enc.tok.encode(text, add_special_tokens=False)
    starts = np.array([a for a, _ in e.offsets], np.int64)
    stable = np.intersect1d(starts, stable_starts(text))

    def place(low: int) -> int:
        k = np.searchsorted(stable, low)
        return int(stable[k]) if k < len(stable) and stable[k] < low + overlap else -1

    first = place(0) if begins else 0
    last = place(core) if ends else len(text)
    if first < 0 or last < 0:
        return first, last, 0
    if not ends:
        return first, last, int((starts >= first).sum())
    return first, last, int(((starts >= first) & (starts < last)).sum())


def _counts(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(enc.count(part.column("text")), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _chunks(tokenizer: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows = batch.to_pydict()
            got = [splice(enc, t, i > 0, i < n - 1, chunk, overlap)
                   for t, i, n in zip(rows["text"], rows["i"], rows["n"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("i"), *(pa.array(x, pa.int64()) for x in zip(*got))]
                if got else [pa.array([], pa.int64())] * 5,
                names=["row", "i", "first", "last", "n_tokens"])
    return run


def _huge_counts(huge: DataFrame, tokenizer: str, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(row, n_tokens) of the texts whose chunks all align, and the rows that don't."""
    chunk = max(CHUNK, 4 * overlap)
    chunks = (
        huge.withColumn("n", F.ceil(F.col("n_chars") / chunk).cast("int"))
        .select("row", "n", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: F.substring("text", i * chunk + 1, F.lit(chunk + overlap)))).alias("i", "text"))
        .withColumn("i", F.col("i").cast("long"))
        .repartition("row", "i")
        .mapInArrow(_chunks(tokenizer, chunk, overlap), "row long, i long, first long, last long, n_tokens long")
    )
    # A chunk's last place and the next one's first are the same character.
    both = chunks.withColumns({
        "end": F.when(F.col("last") >= 0, F.col("last") + F.col("i") * chunk),
        "begin": F.when(F.col("first") >= 0, F.col("first") + F.col("i") * chunk),
    })
    sums = materialize(both.groupBy("row").agg(
        F.sum("n_tokens").alias("n_tokens"),
        (F.count("begin") + F.count("end") - 2 * F.count("*")).alias("misses"),
        (F.sum("begin") - F.sum("end") + F.max("end")).alias("gaps"),
    ), "chunk-counts")
    aligned = (F.col("misses") == 0) & (F.col("gaps") == 0)
    return sums.filter(aligned).select("row", "n_tokens"), sums.filter(~F.coalesce(aligned, F.lit(False))).select("row")


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    spark = docs.sparkSession
    prepare(spark)
    text = text_column()
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.char_length(text).alias("n_chars"))
    small = (rows.filter(F.col("n_chars") <= HUGE).select("doc_id", "n_bytes", "text")
             .mapInArrow(_counts(tokenizer), "doc_id long, n_bytes long, n_tokens long"))
    # Huge texts get a row number that holds for this copy of them.
    huge = materialize(rows.filter(F.col("n_chars") > HUGE).withColumn("row", F.monotonically_increasing_id()), "huge")
    parts, left = [], huge
    while not left.isEmpty():
        done, again = _huge_counts(left, tokenizer, overlap)
        parts.append(left.join(done, "row").select("doc_id", "n_bytes", "n_tokens"))
        left = left.join(again, "row", "left_semi")
        overlap *= 4
    for part in parts:
        small = small.unionByName(part)
    return small.withColumn("over_limit", F.col("n_tokens") > limit)
