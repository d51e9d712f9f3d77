"""Weighted rendezvous hashing of record keys over shards, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written

#: Parts of a shard that are numbered apart; their counts are a table of at most shards * PARTS small rows.
PARTS = 4096
#: Copies of a record that are numbered at once.
RUN = 1000


def place_sql(key: str, shards: Mapping[int, float]) -> str:
    """SQL text of the shard that wins ``key``: the least -ln(u) / weight, with u in (0, 1) from a hash of key and shard.

    A shard's number for a key depends on neither the other shards nor their weights, so a new shard takes keys only
    into itself and a shard's end moves only its own keys. Equal numbers go to the smaller shard.
    """
    draws = []
    for shard, weight in sorted(shards.items()):
        if weight <= 0:
            raise ValueError(f"shard {shard}: the weight must be above 0")
        unit = f"(conv(substr(md5(concat({key}, ':{shard}')), 1, 13), 16, 10) + 0.5d) / 4503599627370496d"
        draws.append(f"struct(-ln({unit}) / {float(weight)!r}d, {int(shard)} as shard)")
    return f"array_min(array({', '.join(draws)})).shard"


def key_sql(column: str) -> str:
    """A null key counts as the text 'null'."""
    return f"coalesce(cast({column} as string), 'null')"


def placed(table: DataFrame, key: str, shards: Mapping[int, float], name: str = "shard") -> DataFrame:
    """``table`` with the shard of each row; rows that share a key share a shard."""
    return table.withColumn(name, F.expr(f"cast({place_sql(key_sql(f'`{key}`'), shards)} as int)"))


def numbered(records: DataFrame, columns: list[str]) -> DataFrame:
    """``records`` (distinct rows with ``copies`` and ``shard``), a row for each copy, with gapless ``slot`` in each shard.

    Slots follow a hash part of the first column and then ``columns``. Distinct rows are numbered part by part; the
    copies of one row, however many, are made from its count and never gathered.
    """
    part = f"cast(conv(substr(md5({key_sql(columns[0])}), 14, 3), 16, 10) as int) % {PARTS}"
    records = written(records.withColumn("part", F.expr(part)))
    counts = records.groupBy("shard", "part").agg(F.sum("copies").alias("n"))
    before = "sum(n) over (partition by shard order by part rows between unbounded preceding and 1 preceding)"
    starts = counts.selectExpr("shard", "part", f"coalesce({before}, 0) as part_start")
    order = ", ".join(f"`{c}`" for c in columns)
    inside = f"sum(copies) over (partition by shard, part order by {order} rows between unbounded preceding and 1 preceding)"
    first = records.withColumn("inside", F.expr(f"coalesce({inside}, 0)")).join(F.broadcast(starts), ["shard", "part"])
    first = first.withColumn("first", F.expr("inside + part_start")).drop("inside", "part_start", "part")
    few = first.where(f"copies <= {RUN}")
    many = first.where(f"copies > {RUN}").withColumn("run", F.expr(f"explode(sequence(0L, (copies - 1) div {RUN}))"))
    many = many.selectExpr("* except (first, copies, run)", f"first + run * {RUN} as first", f"least({RUN}, copies - run * {RUN}) as copies")
    many = many.repartition("shard", "first")
    rows = few.select(*sorted(few.columns)).union(many.select(*sorted(few.columns)))
    return rows.withColumn("slot", F.expr("explode(sequence(first, first + copies - 1))")).drop("first", "copies")


def shard_documents(docs: DataFrame, shards: Mapping[int, float], more: Mapping[int, float]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs`` (doc_id, text).

    ``shards`` and ``more`` map shard numbers to weights; grown_shard is the place under ``more``. A null text has
    size 1 and checksum 0, a null doc_id is a key like others, repeated rows get slots of their own, and other columns are
    ignored. Texts are read once and only sizes and checksums move; equal records are counted before the shuffle.
    """
    raw = "cast(coalesce(cast(text as string), '') as binary)"
    records = docs.selectExpr("cast(doc_id as bigint) as doc_id", f"cast(octet_length({raw}) + 1 as bigint) as size", f"crc32({raw}) as text_crc32")
    records = records.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    records = placed(placed(records, "doc_id", shards), "doc_id", more, "grown_shard")
    slots = numbered(records, ["doc_id", "size", "text_crc32"])
    return slots.selectExpr("doc_id", "size", "text_crc32", "'key' as law", "shard", "slot", "grown_shard")


def shard_sql(shards: int) -> str:
    """The same rows in DuckDB SQL for equal weights and shards 0 to ``shards`` - 1."""

    def place(count: int) -> str:
        unit = "(('0x' || substr(md5(k || ':' || s::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0"
        return f"list_min(list_transform(range({count}), lambda s: {{'d': -ln({unit}), 'shard': s}})).shard::INTEGER"

    step = "xor(c >> 1, 3988292384 * (c & 1))"
    table = "i"
    for _ in range(8):
        table = step.replace("c", table) if table == "i" else f"list_transform([{table}], lambda c: {step})[1]"
    byte = "('0x' || substr(h, 2 * p + 1, 2))::BIGINT"
    crc = f"""list_reduce(list_transform(range(length(h) // 2), lambda p: {byte}),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295)"""
    return f"""
    WITH crc AS (SELECT list_transform(range(256), lambda i: {table}) AS t),
    rec AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
    placed AS (SELECT doc_id, (length(h) // 2 + 1)::BIGINT AS size, xor({crc}, 4294967295)::BIGINT AS text_crc32, {place(shards)} AS shard,
        {place(shards + 1)} AS grown_shard, ('0x' || substr(md5(k), 14, 3))::BIGINT AS part FROM rec, crc)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
        row_number() OVER (PARTITION BY shard ORDER BY part, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM placed"""
