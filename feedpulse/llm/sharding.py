"""Shards of bounded size by extendible hashing, with DataFrame functions only.

A row's hash is a string of bits. The directory maps prefixes to shards: the
bucket of all rows (the empty prefix) splits on the next bit if it holds more
bytes than allowed, and so do its halves, until every bucket fits or holds one
row. Sums over prefixes of a fixed width decide all splits up to that width at
once; only rows in buckets that are still too large go on to wider prefixes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedpulse.llm.arrow import clear_of
from feedpulse.sources.scratch import stored

#: Bits from the key's hash, and after them bits that tell rows with the same key apart.
KEY_BITS = ROW_BITS = 60
#: Bits beyond the expected depth that are summed up at once.
AHEAD = 4


def bits(value: Column) -> Column:
    """The first 60 bits of a string's MD5 as digits."""
    return F.lpad(F.conv(F.substring(F.md5(value), 1, 15), 16, 2), 60, "0")


def splits(cells: DataFrame, width: int, base: int, limit: int) -> DataFrame:
    """Of cells (cell, bytes, docs), all prefixes of ``width`` bits: the shard each belongs to.

    (cell, shard, depth, shard_bytes, shard_docs); depth is null where even the
    cell is too large. Depths from ``base`` on are tried.
    """
    tried = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(width))))
    tried = tried.withColumn("shard", F.expr("substring(cell, 1, depth)"))
    buckets = tried.groupBy("depth", "shard").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
    )
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
    chosen = (
        tried.select("cell", "depth", "shard")
        .join(buckets.where(fits), ["depth", "shard"])
        .groupBy("cell")
        .agg(F.min_by(F.struct("shard", "depth", "shard_bytes", "shard_docs"), "depth").alias("at"))
        .select("cell", "at.*")
    )
    return cells.select("cell").join(chosen, "cell", "left")


def directory(rows: DataFrame, limit: int) -> tuple[DataFrame, list[int]]:
    """(width, cell, shard, depth, shard_bytes, shard_docs), and the widths used. ``rows`` has bits and bytes."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    width = min(KEY_BITS + ROW_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + AHEAD)
    base, pending, parts, widths = 0, rows, [], []
    while True:
        cells = (
            pending.groupBy(F.substring("bits", 1, width).alias("cell"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        )
        found = stored(splits(cells, width, base, limit).withColumn("width", F.lit(width)), "directory")
        last = width == KEY_BITS + ROW_BITS
        whole = found.where("depth IS NOT NULL")
        parts.append(whole)
        widths.append(width)
        large = found.where("depth IS NULL").select("cell")
        if last or large.isEmpty():
            break
        pending = pending.join(large, F.substring("bits", 1, width) == F.col("cell"), "left_semi")
        base, width = width + 1, min(KEY_BITS + ROW_BITS, width + 2 * AHEAD)
    if last:
        # Rows whose 120 bits are equal; not to be expected.
        rest = found.where("depth IS NULL").join(cells, "cell")
        parts.append(
            rest.select(
                "cell", F.col("cell").alias("shard"), F.lit(width).alias("depth"),
                F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"), "width",
            )
        )
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined, widths


def shards(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``bytes``, ``shard``, ``depth``, ``shard_bytes`` and ``shard_docs``.

    A shard's name is its prefix; the only shard of a small table has the empty
    name. A shard holds at most ``limit`` bytes of text, or one row that is
    larger by itself. Null texts have no bytes; null keys are hashed as an empty
    string. Rows with the same key, or wholly alike, start in one bucket and are
    told apart by bits from their number in a stored copy, so that they split like
    others. An empty table gives an empty result.
    """
    new = ("bytes", "shard", "depth", "shard_bytes", "shard_docs")
    kept = [c for c in docs.columns if c.lower() not in new and c != text]
    number, own_bits = clear_of(docs, "number"), clear_of(docs, "bits")
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long")
    narrow = stored(
        docs.select(*[f"`{c}`" for c in kept], size.alias("bytes"), F.monotonically_increasing_id().alias(number)),
        "sizes",
    )
    row = F.concat(name, F.lit("#"), F.col(f"`{number}`").cast("string"))
    hashed = narrow.withColumn(own_bits, F.concat(bits(name), bits(row)))
    table, widths = directory(hashed.select(F.col(f"`{own_bits}`").alias("bits"), "bytes"), limit)
    width, cell = clear_of(docs, "width"), clear_of(docs, "cell")
    table = table.withColumnsRenamed({"width": width, "cell": cell})
    hashed = hashed.withColumn(width, F.explode(F.array(*map(F.lit, widths))))
    hashed = hashed.withColumn(cell, F.expr(f"substring(`{own_bits}`, 1, `{width}`)"))
    return hashed.join(table, [width, cell]).select(*[f"`{c}`" for c in kept], *new)


def write_shards(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the rows with their texts, a folder ``shard=…`` with one file for each shard.

    Rows are numbered in a stored copy first, so that repeated keys find their shard.
    """
    number = clear_of(docs, "row")
    whole = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    placed = shards(whole.select(number, f"`{key}`", f"`{text}`"), limit, key, text)
    folder = F.concat(F.lit("s"), F.col("shard")).alias("shard")
    rows = whole.join(placed.select(number, folder), number).drop(number)
    rows.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int) -> str:
    """The same for ``documents`` with unlike ids, in DuckDB's SQL."""
    return f"""
        WITH hashed AS (
            SELECT doc_id, lang, source, n_chars, coalesce(strlen(text), 0) AS bytes,
                lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), 60, '0') AS bits
            FROM documents),
        buckets AS (
            SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes)::BIGINT AS shard_bytes,
                count(*) AS shard_docs
            FROM hashed, range(0, 41) AS depths(depth) GROUP BY ALL),
        fitting AS (SELECT * FROM buckets WHERE shard_bytes <= {limit} OR shard_docs = 1)
        SELECT doc_id, bytes, f.shard, f.depth::INT AS depth, f.shard_bytes, f.shard_docs
        FROM hashed JOIN fitting f ON substr(bits, 1, f.depth) = f.shard
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY f.depth) = 1"""
