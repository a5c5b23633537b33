"""Reproducible shuffle and sharding: a Feistel permutation with cycle walking over global row numbers.

Law ``rows``: with N rows, the row of number n goes to position p = permute(n) of a pseudo-random order of 0..N-1;
its shard is ``p % shards`` and its slot ``p // shards``. Counts of shards differ by one at most, slots have no gaps,
and both are computed from n alone. DataFrame functions only.

Defined cases: a null text has no bytes (size 16, checksum 0); null or repeated ids are numbered like others (order:
id, checksum, size; wholly equal rows are interchangeable); an empty table gives an empty result; other columns of
the input are left out, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.shared import cut

ROUNDS, WALK = 4, 64


def halves(n: int) -> tuple[int, int]:
    """a and b with a * b >= n and a * b - n < a: few numbers lie outside, so walks are rare."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, -(-max(n, 1) // a)


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over 0..a*b-1: an unbalanced Feistel network whose rounds add a keyed digest of one
    half to the other, modulo a and b in turn. Four rounds."""
    left, right = F.call_function("div", x, F.lit(b)), F.pmod(x, F.lit(b))
    for i in range(ROUNDS):
        source, mod = (right, a) if i % 2 == 0 else (left, b)
        digest = F.md5(F.concat(source.cast("string"), F.lit(f":{seed}:{i}")))
        h = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(mod))
        if i % 2 == 0:
            left = F.pmod(left + h, F.lit(mod))
        else:
            right = F.pmod(right + h, F.lit(mod))
    return left * F.lit(b) + right


def permute(x: Column, n: int, seed: int) -> Column:
    """A permutation of 0..n-1. Walks on while outside; a walk over WALK steps (impossible up to 4096 rows, and of a
    chance below 2**-380 beyond) is an error, never a wrong result."""
    a, b = halves(n)
    steps = F.when(x < n, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.lit(WALK)))
    walked = F.aggregate(steps, x, lambda p, _: F.when(p < n, p).otherwise(feistel(p, a, b, seed)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> tuple[DataFrame, int]:
    """Global row numbers 0..N-1 in the given order, without a single-task window: rows are range-partitioned and
    sorted, numbered within each partition, and shifted by the counts of the partitions before (one row each)."""
    salt = "__salt"
    local = (
        df.withColumn(salt, F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*order, salt)
        .sortWithinPartitions(*order, salt)
        .drop(salt)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    local = cut(local.withColumn("__part", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND((1 << 33) - 1)))
    counts = local.groupBy("__part").agg(F.count("*").alias("__n"))  # one row a partition, however large the table
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    offsets = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__shift"))
    return local.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift"), total


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20_240_131) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_no of every document."""
    lean = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered, total = number_rows(lean, ["doc_id", "text_crc32", "size"])
    a, b = halves(total)
    at = numbered.withColumn("__p", feistel(F.col("row_no"), a, b, seed)).withColumn("__p", permute(F.col("__p"), total, seed))
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("__p", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("__p"), F.lit(shards)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )


def oracle(shards: int = 40, seed: int = 20_240_131) -> str:
    """The same result in SQL: the permutation of row numbers, walked by a recursive query, and the checksum of the
    texts' bytes by a fold over their hexadecimal digits."""
    table = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        table.append(b)
    half = lambda x, i, mod: f"(CAST('0x' || substr(md5(CAST({x} AS VARCHAR) || ':{seed}:{i}'), 1, 15) AS BIGINT) % {mod})"
    rounds, names = [], ("a", "b")
    for i in range(ROUNDS):
        own, other = ("l", "r") if i % 2 == 0 else ("r", "l")
        moved = f"({own} + {half(other, i, names[i % 2])}) % {names[i % 2]} AS {own}"
        rounds.append(f"f{i + 1} AS (SELECT * EXCLUDE ({own}), {moved} FROM f{i})")
    once = ", ".join(rounds)
    return f"""
WITH RECURSIVE bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
lean AS (SELECT doc_id, CAST(length(h) // 2 + 16 AS BIGINT) AS size,
  xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, {table}[CAST(xor(c & 255, x) AS INT) + 1])), 4294967295) AS text_crc32 FROM bytes),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id, text_crc32, size) - 1 AS row_no FROM lean),
size AS (SELECT n, CAST(greatest(1, ceil(sqrt(n))) AS BIGINT) AS a FROM (SELECT count(*) AS n FROM lean)),
dims AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM size),
walk AS (
  SELECT row_no, row_no AS p, 0 AS step FROM numbered
  UNION ALL
  SELECT row_no, p, step FROM (
    WITH f0 AS (SELECT row_no, step + 1 AS step, p // b AS l, p % b AS r, a, b FROM walk, dims WHERE step = 0 OR p >= n), {once}
    SELECT row_no, l * b + r AS p, step FROM f{ROUNDS})),
placed AS (SELECT row_no, arg_max(p, step) AS p FROM walk GROUP BY 1)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(p % {shards} AS INT) AS shard, p // {shards} AS slot, CAST(NULL AS INT) AS grown_shard, row_no FROM numbered JOIN placed USING (row_no)
"""
