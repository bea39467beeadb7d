"""Token counts without ids (operator 2).

Pieces are counted once per distinct pre-token and joined to per-document pre-token frequencies.
The join is split by frequency: a bounded head of frequent pre-tokens is broadcast and summed where
the text is read; the rest, written with its frequencies, meets its counts in a shuffled join. The
head comes from a bounded hash sample of documents and only decides which way a pre-token takes:
every pre-token of every text is counted either way, and no hot pre-token reaches the shuffle.

Defined cases: a null text counts as empty and has no tokens; a special string inside a text is one
token and ends the pre-tokens around it; repeated rows give repeated results; a null id stays null;
other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import pre_tokens, small_batches
from storyspark.session import written

#: Pre-tokens that are broadcast at most, and documents (about) that are sampled to choose them.
HEAD = 100_000
HEAD_DOCUMENTS = 4_000


def _special(tokenizer_json: str) -> list[str]:
    found = json.loads(tokenizer_json).get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in found):
        raise ValueError("added tokens that strip or match whole words only are not supported")
    return sorted((t["content"] for t in found), key=len, reverse=True)


def count_pieces(pieces: DataFrame, tokenizer_json: str) -> DataFrame:
    """``piece``, ``n_pieces``: the number of pieces of each row's pre-token."""
    shared = pieces.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        for batch in batches:
            found = tokenizer.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            sizes = np.fromiter((len(x) for x in found), np.int64, len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes)], ["piece", "n_pieces"])

    return pieces.select("piece").mapInArrow(run, "piece string, n_pieces long")


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", head_size: int = HEAD) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    text = F.coalesce(text_col, F.lit(""))
    special = _special(tokenizer_json)
    pieces, n_special = pre_tokens(text), F.lit(0)
    if special:
        pattern = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in s) for s in special)
        parts = F.split(text, pattern)
        has = F.greatest(*[F.contains(text, F.lit(s)) for s in special], F.lit(False))
        pieces = F.when(has, F.flatten(F.transform(parts, pre_tokens))).otherwise(pieces)
        n_special = F.when(has, F.size(parts) - 1).otherwise(0)
    source = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                         n_special.cast("long").alias("n_special"), pieces.alias("pieces"))

    rows = docs.count()
    share = min(1.0, HEAD_DOCUMENTS / max(rows, 1))
    sampled = (docs.withColumn("_share", F.pmod(F.xxhash64(id_col), F.lit(1 << 20)))
               .where(F.col("_share") < int(share * (1 << 20)))
               .select(F.explode(pre_tokens(text)).alias("piece")))
    frequent = (sampled.groupBy("piece").count().orderBy(F.desc("count"), "piece").limit(head_size))
    head = count_pieces(frequent, tokenizer_json).toArrow()
    table = dict(zip(head.column("piece").to_pylist(), head.column("n_pieces").to_pylist()))
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column(3)
            coded = lists.flatten().dictionary_encode()
            sizes = np.fromiter((known.get(p, -1) for p in coded.dictionary.to_pylist()), np.int64,
                                len(coded.dictionary))
            codes = coded.indices.to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            each = sizes[codes]
            sums = np.bincount(row, np.maximum(each, 0), len(lists)).astype(np.int64)
            rest = each < 0
            width = max(len(sizes), 1)
            keys, freq = np.unique(row[rest] * width + codes[rest], return_counts=True)
            bounds = np.searchsorted(keys, np.arange(len(lists) + 1) * width)
            tail = pa.StructArray.from_arrays(
                [coded.dictionary.take(pa.array(keys % width)), pa.array(freq.astype(np.int32))],
                ["piece", "freq"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(sums + batch.column(2).to_numpy(zero_copy_only=False)),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), tail)],
                [id_col, "n_bytes", "n_head", "tail"])

    kind = docs.schema[id_col].dataType.simpleString()
    base = written(source.mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_head long, tail array<struct<piece string, freq int>>")
        .withColumn("_row", F.monotonically_increasing_id()), "token-frequencies")
    tail = base.select("_row", F.inline("tail"))
    counts = written(count_pieces(tail.select("piece").distinct(), tokenizer_json), "piece-counts")
    sums = (tail.join(counts, "piece").groupBy("_row")
            .agg(F.sum(F.col("freq") * F.col("n_pieces")).alias("n_tail")))
    n_tokens = F.col("n_head") + F.coalesce("n_tail", F.lit(0).cast("long"))
    return (base.select("_row", id_col, "n_bytes", "n_head").join(sums, "_row", "left")
            .select(id_col, "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")))
