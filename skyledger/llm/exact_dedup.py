"""Exact de-duplication by an extendible-hash index on shared files.

Keys are 64-bit hashes of the normalised text.  A directory maps the leading bits
of a key to a bucket; it doubles until no bucket holds more keys than its capacity.
Buckets are dealt to owner tasks by key range.  An owner chains the texts of one
key, told apart by their bytes, and writes the chains to the shared folder.  Then
every document looks its key up; where a chain has several texts, its SHA-256 says
which of them it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import BLANKS, one_of_each, tasks, texts, wrapped
from skyledger.shared import written

#: Leading key bits the directory may use: at most this many cells, whatever the input.
DEEPEST = 16


def normalised() -> Column:
    return F.regexp_replace("text", BLANKS, " ")


def double_directory(loads: dict[int, int], capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """Global depth, and (bucket, load) of every directory cell, in key order.

    ``loads`` has the keys of each cell at depth ``DEEPEST``.  Starting with one
    bucket, an overfull one is split in two by its next bit; where it already has the
    directory's depth, the directory doubles first.  A bucket that is overfull at
    ``DEEPEST`` stays so: it is a longer file, no key is lost.
    """
    sums = [loads.get(cell, 0) for cell in range(1 << DEEPEST)]
    levels = [sums]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([below[i] + below[i + 1] for i in range(0, len(below), 2)])
    levels.reverse()  # levels[d][p]: keys whose leading d bits are p
    depth, settled, open_buckets = 0, [], [(0, 0)]
    while open_buckets:
        local, prefix = open_buckets.pop()
        if levels[local][prefix] > capacity and local < DEEPEST:
            depth = max(depth, local + 1)
            open_buckets += [(local + 1, 2 * prefix + 1), (local + 1, 2 * prefix)]
        else:
            settled.append((local, prefix))
    cells = []
    for bucket, (local, prefix) in enumerate(settled):
        cells += [(bucket, levels[local][prefix])] * (1 << (depth - local))
    return depth, cells


def _directory(keys: DataFrame, capacity: int, owners: int) -> tuple[int, DataFrame]:
    """Depth, and cell, bucket and owner of every directory cell (2**DEEPEST at most)."""
    fine = F.shiftrightunsigned("hash", 64 - DEEPEST).alias("cell")
    counted = keys.select("hash").distinct().groupBy(fine).count().collect()
    depth, cells = double_directory({r["cell"]: r["count"] for r in counted}, capacity)
    loads = dict(cells)
    share, before, owner = max(1, -(-sum(loads.values()) // owners)), 0, {}
    for bucket in sorted(loads):
        owner[bucket] = before // share
        before += loads[bucket]
    rows = [(cell, bucket, owner[bucket]) for cell, (bucket, _) in enumerate(cells)]
    session = keys.sparkSession
    return depth, session.createDataFrame(rows, "cell long, bucket long, owner long")


def _cell(depth: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")


def deduplicate(docs: DataFrame, capacity: int = 16384, key_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when their bytes are, after each run of blanks became one space; of
    equal texts the smallest doc_id stays.  Null and empty texts are equal to each other.
    Rows that repeat an id and text share their fate (all kept or all dropped), each
    counted in group_size.  A null doc_id loses to any other; among themselves such rows
    have keep_id null and stay.  No rows give no rows.  Other columns are not read.
    ``key_bits`` below 64 makes keys collide and exists to test the chains.
    """
    session = docs.sparkSession
    read = texts(docs).select("doc_id", normalised().alias("text"))
    hashed = F.xxhash64("text")
    if key_bits < 64:
        hashed = F.shiftleft(hashed, 64 - key_bits)
    read = read.withColumn("hash", hashed)
    keys = written(
        read.select("doc_id", "hash", F.sha2("text", 256).alias("text_sha256")), "dedup-keys"
    )
    owners = tasks(session)
    depth, directory = _directory(keys, capacity, owners)
    # Copies are merged before the shuffle and meet again by bucket, key and bytes.
    entries = (
        read.withColumn("cell", _cell(depth))
        .join(F.broadcast(directory), "cell")
        .groupBy("owner", "bucket", "hash", "text")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    sha = F.sha2("text", 256).alias("chained_sha256")
    chain = Window.partitionBy("owner", "bucket", "hash")
    index = written(
        entries.select("owner", "bucket", "hash", "keep_id", "group_size", sha)
        .repartition(owners, "owner")
        .withColumn("chain", F.row_number().over(chain.orderBy("keep_id", "chained_sha256")))
        .withColumn("texts", F.count("*").over(chain)),
        "dedup-index",
    )
    single = index.filter("texts = 1").drop("owner", "texts", "chained_sha256")
    found = keys.join(single, "hash")
    several = index.filter("texts > 1")
    if not several.isEmpty():
        chained = several.drop("owner", "texts").withColumnRenamed("chained_sha256", "text_sha256")
        found = found.unionByName(keys.join(chained, ["hash", "text_sha256"]))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "bucket", "chain"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, with all its columns, whatever their names.

    The row with the smallest doc_id stays, a null losing to any other; of rows that repeat
    it, one.  Null and empty texts are equal.  No rows give no rows.
    """
    stay = deduplicate(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, " ")
    rows = wrapped(docs, doc_id=F.col("doc_id").cast("long"), text_sha256=F.sha2(text, 256))
    return one_of_each(rows, stay, "doc_id", "text_sha256")
