"""Variable-capacity best-fit packing of documents into training sequences.

1. One pass counts each text's tokens (white-space words unless a counter is
   given); from then on a document is a number.
2. A document longer than the largest permitted length is cut into pieces, so
   no token is lost. Pieces are dealt by hash into shards of about
   ``shard_pieces``; a shard's waste is a fraction of one bin, so packing them
   apart costs next to nothing and any number of tasks can work.
3. In a shard, pieces go longest first into the open bin, of whatever size,
   that they leave least room in. If none fits, a bin is opened. Which size is
   the joint choice: each permitted length is tried as the least size of new
   bins (a longer piece opens the smallest size that holds it), and the try of
   least total cost wins.
4. Every bin is finally downsized to the smallest permitted length that holds
   its contents. A sequence of length c costs ``c + c * c / attention``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.llm.common import only, written

LENGTHS = (512, 1024, 2048, 4096)
ATTENTION = 65_536.0        # length at which attention costs as much as the rest


def words(text: str) -> int:
    return len(text.split())


def cost(length: int, attention: float = ATTENTION) -> float:
    return length + length * length / attention


def _smallest(lengths: tuple[int, ...], n: int) -> int:
    return next(c for c in lengths if c >= n)


def best_fit(sizes: list[int], lengths: tuple[int, ...], least: int) -> tuple[list[int], list[int]]:
    """Bin of each piece and contents of each bin; ``sizes`` fall.

    New bins have at least the length ``least``. Open bins stand by the room
    left; a bit set of the rooms in use gives the smallest that suffices. Of
    bins with equal room the one used last is taken.
    """
    at: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]
    rooms = 0
    bins: list[int] = []
    filled: list[int] = []
    for n in sizes:
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = at[room].pop()
            if not at[room]:
                rooms ^= 1 << room
        else:
            room, b = max(least, _smallest(lengths, n)), len(filled)
            filled.append(0)
        bins.append(b)
        filled[b] += n
        left = room - n
        if left:
            if not at[left]:
                rooms |= 1 << left
            at[left].append(b)
    return bins, filled


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, attention: float = ATTENTION) -> tuple[list[int], list[int]]:
    """Bin of each piece and length of each bin, the cheapest over all opening sizes."""
    best = None
    for least in lengths:
        bins, filled = best_fit(sizes, lengths, least)
        final = [_smallest(lengths, n) for n in filled]
        total = sum(cost(c, attention) for c in final)
        if best is None or total < best[0]:
            best = total, bins, final
    return best[1], best[2]


def token_counts(docs: DataFrame, id_col: str, text_col: str, count: Callable[[str], int]) -> DataFrame:
    """(``rid``, id, ``tokens``) per row; ``rid`` is the row's place in the scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [count(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["rid", "id", "tokens"])

    rows = only(docs, [id_col, text_col]).select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("tokens", T.LongType())]))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lengths: tuple[int, ...] = LENGTHS, attention: float = ATTENTION,
                   count: Callable[[str], int] = words, shard_pieces: int = 4096,
                   row_key: str = "row_key") -> DataFrame:
    """One row per piece: (``row_key``, id, ``piece``, ``first_token``, ``n_tokens``,
    ``bin_id``, ``bin_offset``, ``capacity``).

    ``bin_offset`` is the piece's first place in its bin, ``capacity`` the
    bin's permitted length after downsizing. A null or empty text is one piece
    of 0 tokens without a bin (null ``bin_id``, ``bin_offset``, ``capacity``).
    Repeated rows and null ids are packed like any other: ``row_key`` tells
    rows apart. Columns other than the two named are not looked at.
    """
    lengths = tuple(sorted(set(lengths)))
    most = lengths[-1]
    counted = written(token_counts(docs, id_col, text_col, count), "pack-counts")
    pieces = counted.where("tokens > 0").select(
        "rid", "id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("tokens") / most) - 1)).alias("piece"))
    pieces = pieces.select("rid", "id", "piece", (F.col("piece") * most).alias("first_token"),
                           F.least(F.lit(most), F.col("tokens") - F.col("piece") * most).alias("n_tokens"))
    total = counted.agg(F.sum(F.ceil(F.col("tokens") / most))).first()[0] or 0
    shards = max(1, -(-total // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("rid", "piece"), F.lit(shards)))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "rid", "piece"], ascending=[False, True, True], kind="stable")
        bins, final = pack(rows["n_tokens"].tolist(), lengths, attention)
        b = np.array(bins)
        rows["bin_id"] = (rows["shard"].to_numpy() << 32) + b
        rows["bin_offset"] = rows.groupby(b)["n_tokens"].cumsum() - rows["n_tokens"]
        rows["capacity"] = np.array(final)[b]
        return rows.drop(columns="shard")

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("id", id_type)] + [
        T.StructField(c, T.LongType()) for c in ("piece", "first_token", "n_tokens", "bin_id", "bin_offset", "capacity")])
    # ids stay out of pandas, which would turn integers with nulls into floats
    narrow = T.StructType([f for f in schema if f.name != "id"])
    packed = dealt.drop("id").groupBy("shard").applyInPandas(fill, narrow).join(counted.select("rid", "id"), "rid")
    none = F.lit(None).cast("long")
    empty = counted.where("tokens = 0").select(
        "rid", "id", *[F.lit(0).cast("long").alias(c) for c in ("piece", "first_token", "n_tokens")],
        none.alias("bin_id"), none.alias("bin_offset"), none.alias("capacity"))
    return packed.select(*schema.names).union(empty).withColumnsRenamed({"rid": row_key, "id": id_col})
