"""Secret scans over versioned texts, by an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger has
a row for each blob and rule version that was ever scanned, with the spans found
(or none). A scan looks up which pairs are new, scans only those, appends them,
and joins the findings back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of secret, in order, with pattern, the group whose length counts, and the least length.
BASE_PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)

LEDGER_SCHEMA = "blob_id binary, rule string, rule_version int, spans array<struct<start: bigint, end: bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a changed pattern needs a new version, which is scanned afresh.

    ``hints`` are lower-case words one of which every match has; texts without are skipped.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    hints: tuple[str, ...] = ()


_HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",), "hex": ()}
RULES = tuple(Rule(kind, pattern, group, least, 1, _HINTS[kind]) for kind, pattern, group, least in BASE_PATTERNS)


class Scanner:
    """A rule ready for use. Matches are leftmost and do not overlap; those too short are dropped after."""

    def __init__(self, rule: Rule) -> None:
        pattern = rule.pattern
        if rule.kind == "hex" and pattern == "[0-9a-f]+":
            # A greedy run starts where its first digit does, so the length can be asked for at once.
            pattern = "[0-9a-f]{%d,}" % rule.least
        self.rule, self.find = rule, re.compile(pattern, re.ASCII).finditer

    def spans(self, text: str, lower: str) -> list[dict[str, int]]:
        rule = self.rule
        if rule.hints and not any(hint in lower for hint in rule.hints):
            return []
        return [
            {"start": found.start(), "end": found.end()}
            for found in self.find(text)
            if found.end(rule.group) - found.start(rule.group) >= rule.least
        ]


def blob_id(text) -> Column:
    """The SHA-256 of a text's UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _scan_blobs(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = {(rule.kind, rule.version): Scanner(rule) for rule in rules}
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            blobs, names, versions, spans = [], [], [], []
            for blob, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = text or ""
                lower = text.lower()
                for pair in wanted:
                    key = (pair["rule"], pair["rule_version"])
                    blobs.append(blob)
                    names.append(key[0])
                    versions.append(key[1])
                    spans.append(scanners[key].spans(text, lower))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), pa.array(names, pa.string()), pa.array(versions, pa.int32()), pa.array(spans, kind)],
                ["blob_id", "rule", "rule_version", "spans"],
            )

    return scan


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger kept at a path; empty if nothing was written there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def unseen_pairs(versions: DataFrame, ledger: DataFrame, key: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob with anything new: one row ``(key, blob_id)`` that holds it, and the rules to scan.

    ``versions`` has ``key`` and ``blob_id``. Copies are merged before the
    shuffle, so a blob under very many paths is one row.
    """
    pairs = F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules))
    blobs = versions.groupBy("blob_id").agg(F.min(key).alias(key))
    return (
        blobs.select(key, "blob_id", F.inline(pairs))
        .join(ledger.select("blob_id", "rule", "rule_version"), ["blob_id", "rule", "rule_version"], "left_anti")
        .groupBy("blob_id", key)
        .agg(F.collect_set(F.struct("rule", "rule_version")).alias("wanted"))
    )


def update_ledger(
    spark: SparkSession,
    versions: DataFrame,
    ledger_path: str,
    rules: tuple[Rule, ...] = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` lacks, append it there, and return the ledger.

    The text of a blob is read from one of the rows that hold it; it is shuffled
    once, without sorting. Rows with a null key are scanned as well. Empty input
    appends nothing but leaves a readable ledger.
    """
    rows = versions.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = rows.withColumn("blob_id", blob_id(F.col("_text")))
    todo = unseen_pairs(rows.select("_key", "blob_id"), read_ledger(spark, ledger_path), "_key", rules)
    same = (F.col("t._key").eqNullSafe(F.col("v._key"))) & (F.col("t.blob_id") == F.col("v.blob_id"))
    blobs = rows.alias("v").join(todo.alias("t").hint("shuffle_hash"), same).select("v.blob_id", "v._text", "t.wanted")
    # A repeated row meets its blob again; the ledger keeps one row for each pair.
    found = blobs.mapInArrow(_scan_blobs(rules), LEDGER_SCHEMA).dropDuplicates(["blob_id", "rule", "rule_version"])
    found.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every row of ``versions`` with ``spans``: (kind, start, end) by start, then by the rules' order.

    Offsets are code points, the end exclusive. A null or empty text has none;
    repeated rows stay repeated. Columns named ``spans`` or ``blob_id`` in the
    input are replaced.
    """
    rows = versions.withColumn("blob_id", blob_id(F.col(text)))
    order = {rule.kind: i for i, rule in enumerate(rules)}
    current = F.concat_ws("@", "rule", "rule_version").isin(*(f"{r.kind}@{r.version}" for r in rules))
    place = F.coalesce(*(F.when(F.col("rule") == kind, F.lit(i)) for kind, i in order.items()))
    by_blob = (
        ledger.where(current)
        .where(F.size("spans") > 0)
        .groupBy("blob_id")
        .agg(
            F.array_sort(
                F.flatten(
                    F.collect_list(
                        F.transform(
                            "spans",
                            lambda s: F.struct(s["start"].alias("start"), place.alias("place"), F.col("rule").alias("kind"), s["end"].alias("end")),
                        )
                    )
                )
            ).alias("_found")
        )
    )
    joined = rows.drop("spans", "_found").join(by_blob, "blob_id", "left")
    none = F.array().cast("array<struct<start: bigint, place: int, kind: string, end: bigint>>")
    return joined.withColumn(
        "spans",
        F.transform(F.coalesce("_found", none), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))),
    ).drop("_found")


def spans_text(spans) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(found: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every span of ``spans`` replaced by ``mark``; spans that overlap become one mark."""
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        between = F.substring(F.col(text), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        apart = F.struct(span["end"].alias("at"), F.concat(done["out"], between, F.lit(mark)).alias("out"))
        joined = F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["out"].alias("out"))
        return F.when((span["start"] >= done["at"]), apart).otherwise(joined)

    def end(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col(text), (done["at"] + 1).cast("int"), F.length(text)))

    return found.withColumn(text, F.when(F.size("spans") > 0, F.aggregate("spans", begin, step, end)).otherwise(F.col(text)))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""
    base = [kind for kind, *_ in BASE_PATTERNS]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base_only = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        key, *map(count, base), F.sha2(spans_text(base_only).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans")
    )
