"""Secrets: sure patterns, and weak parts that count only beside their complements.

Tasks find spans in whole texts.  Weak parts (a name, a key without a label, an
endpoint) are joined by intervals with the parts around them: one is reported when an
end of a part with another role lies within its scope.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import texts
from skyledger.shared import written

#: Code points before and after a weak part that belong to its scope.
REACH = 200

BASE = ("assign", "access", "hex")
WEAK = ("name", "key", "endpoint")
KINDS = BASE + WEAK
ROLE = {
    "access": "identifier", "name": "identifier", "assign": "secret", "hex": "secret",
    "key": "secret", "endpoint": "endpoint",
}

#: Kind, RE2 pattern without which a text has none, exact pattern, the group whose
#: length counts and its least length.
PATTERNS = (
    (
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        1,
        6,
    ),
    ("access", "AKIA[A-Z0-9]{16}", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24}", "[0-9a-f]{24,}", 0, 24),
    (
        "name",
        r"(?i)(user|username|login|client_id|account)[\"']?\x20*[:=]",
        r"(?ai:username|user|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)",
        1,
        3,
    ),
    ("key", "[A-Za-z0-9+/]{40}", "[A-Za-z0-9+/]{40,}", 0, 40),
    ("endpoint", "[a-z]://[A-Za-z0-9]", r"[a-z]{2,12}://[A-Za-z0-9_.:@/-]+", 0, 8),
)

SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
)


def _find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compiled = [(kind, hint, re.compile(exact), g, least) for kind, hint, exact, g, least in PATTERNS]
    for batch in batches:
        column = batch.column("text")
        spans: list[list | None] = [None] * batch.num_rows
        for kind, hint, exact, group, least in compiled:
            there = pc.indices_nonzero(pc.match_substring_regex(column, hint))
            for i in there.to_pylist():
                for m in exact.finditer(column[i].as_py()):
                    if m.end(group) - m.start(group) >= least:
                        spans[i] = spans[i] or []
                        spans[i].append({"start": m.start(), "end": m.end(), "kind": kind})
        found = pa.array([x or [] for x in spans], _ARROW_SPANS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("line"), batch.column("doc_id"), found], ["line", "doc_id", "spans"]
        )


def _ordered(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    rank = F.create_map(*(F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)))
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"])
    )
    return F.array_distinct(F.array_sort(keyed))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(_ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
        ",",
    )


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """line and spans of the weak parts with a complement in their scope."""
    role = F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair))
    part = parts.select("line", F.explode("spans").alias("s")).select(
        "line", "s.*", role[F.col("s.kind")].alias("role")
    )
    # A block is a stretch of the text as long as the reach: both sides meet by line
    # and block, so one long text is shared by many tasks.
    scope = F.sequence(
        F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach)
    )
    weak = part.filter(F.col("kind").isin(*WEAK)).withColumn("block", F.explode(scope))
    ends = part.select(
        F.col("line").alias("other"),
        F.col("role").alias("other_role"),
        F.explode(F.array("start", "end")).alias("point"),
    ).withColumn("other_block", F.floor(F.col("point") / reach))
    near = (
        (F.col("line") == F.col("other"))
        & (F.col("block") == F.col("other_block"))
        & (F.col("role") != F.col("other_role"))
        & F.col("point").between(F.col("start") - reach, F.col("end") + reach)
    )
    return (
        weak.join(ends, near, "left_semi")
        .groupBy("line")
        .agg(F.collect_set(F.struct("start", "end", "kind")).alias("linked"))
    )


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, sure spans and linked weak spans of every row.

    Spans are structs of start, end (code points, exclusive) and kind.  A null or empty
    text has none.  Repeated rows and rows with a null id are searched each for itself;
    an empty table gives an empty one; other columns are not read.
    """
    numbered = texts(docs).withColumn("line", F.monotonically_increasing_id())
    parts = written(
        numbered.mapInArrow(_find, f"line long, doc_id long, spans {SPANS}"), "secret-parts"
    )
    sure = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    linked = F.coalesce("linked", F.from_json(F.lit("[]"), SPANS))
    return parts.join(_linked(parts, reach), "line", "left").select(
        "doc_id", sure.alias("sure"), linked.alias("linked")
    )


def digest_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = find_secrets(docs)
    count = lambda kind: F.size(F.filter("sure", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(F.col("sure")), 256).alias("base_sha256"),
        _joined(F.concat("sure", "linked")).alias("spans"),
    )
