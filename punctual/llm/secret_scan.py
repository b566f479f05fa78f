"""Secret scans with an incremental ledger of blobs.

A blob is a text under the digest of its content. The ledger lists which blob has been
scanned by which version of which rule, and what was found. A scan looks only at pairs
of blob and rule version that the ledger does not list, at every distinct text once, and
joins the findings back to all rows that hold the text. DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.session import materialize


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, and the least length.

    Matches are leftmost and do not overlap; one whose group is too short is dropped.
    A changed pattern needs a new version, so that old blobs are scanned again.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the base kinds. A run of the letters of `access` or
# `hex` is matched whole, so the least length can stand in the pattern.
BASE_RULES = [
    Rule(
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2, least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
MORE_RULES = [
    # All words up to the last, without a way back: no recursion, however many there are.
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*+(?<= PRIVATE )KEY-----"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/:@]{3,128})@[^\s/:@]+"),
]
RULES = BASE_RULES + MORE_RULES

SCANNED = "blob string, rule string"
SPANS = "array<struct<rule:int,nth:int,gap:bigint,length:bigint,kept:boolean>>"
FINDINGS = "blob string, kind string, start long, end long"


def _span(number: int, rule: Rule):
    return lambda x, at: F.struct(
        F.lit(number).alias("rule"), at.alias("nth"),
        F.length(x["gap"]).cast("long").alias("gap"),
        F.length(x["match"]).cast("long").alias("length"),
        (F.length(x["key"]) >= rule.least).alias("kept"),
    )


def _spans(text: Column, wanted: Column, rules: list[Rule]) -> Column:
    """All matches: rule, number, length of the gap before it, length, long enough."""
    found = []
    for number, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        zipped = F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("gap"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("key"),
        )
        # The last gap has no match.
        spans = F.filter(
            F.transform(zipped, _span(number, rule)), lambda s: s["length"].isNotNull()
        )
        due = F.array_contains(wanted, rule.key) & text.rlike(rule.pattern)
        found.append(F.when(due, spans).otherwise(F.array().cast(SPANS)))
    return F.concat(*found)


def _number_of(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


class Ledger:
    """The scanned pairs and the findings, as two appended tables in a folder.

    Findings are written before the pairs are marked as scanned. A scan that breaks off
    in between is done again; equal findings count once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, layout: str) -> DataFrame:
        empty = self.spark.createDataFrame([], layout)
        empty.write.mode("append").parquet(f"{self.folder}/{name}")  # makes the folder
        return self.spark.read.schema(layout).parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED).distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", FINDINGS).distinct()

    def scan(self, texts: DataFrame, rules: list[Rule] = RULES) -> int:
        """Scans what is new in ``texts(blob, text)``; returns the number of new blobs."""
        seen = self.scanned().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        every = F.array(*[F.lit(r.key) for r in rules])
        due = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        # Copies of a text meet in their task first, so a hot text is not shuffled often.
        blobs = texts.dropDuplicates(["blob"]).join(seen, "blob", "left").withColumn("due", due)
        fresh = blobs.filter(F.size("due") > 0)
        spans = fresh.select(
            "blob", "due", F.explode_outer(_spans(F.col("text"), F.col("due"), rules)).alias("s")
        ).select("blob", "due", "s.*")
        spans = materialize(spans, "spans")
        done = Window.partitionBy("blob", "rule").orderBy("nth")
        before = done.rowsBetween(Window.unboundedPreceding, -1)
        start = F.sum("gap").over(done.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
            F.sum("length").over(before), F.lit(0)
        )
        kinds = F.array(*[F.lit(r.kind) for r in rules])
        found = spans.filter("rule is not null").withColumn("start", start).filter("kept")
        found.select(
            "blob", kinds[F.col("rule")].alias("kind"), "start",
            (F.col("start") + F.col("length")).alias("end"),
        ).write.mode("append").parquet(f"{self.folder}/findings")
        marks = spans.select("blob", "due").distinct()
        marks.select("blob", F.explode("due").alias("rule")).write.mode("append").parquet(
            f"{self.folder}/scanned")
        return marks.count()


def scan_documents(docs: DataFrame, ledger: Ledger, rules: list[Rule] = RULES) -> DataFrame:
    """Findings of every row of ``docs(doc_id, text)``, by way of the ledger.

    Columns: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` (digest
    of the base spans as ``kind:start:end``, by start, then kind as listed, joined by
    commas), ``spans`` (all spans, written alike) and ``blob``. Positions are code
    points; the end is exclusive.

    A null text is an empty one. Repeated rows, and other rows with the same text, get
    the same findings, which are made once. An empty table gives an empty result;
    further columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select("doc_id", F.sha2(text, 256).alias("blob"), text.alias("text"))
    ledger.scan(held.select("blob", "text"), rules)
    order = F.array(*[F.lit(r.kind) for r in rules])
    # Findings of earlier rules that are no longer asked for stay in the ledger.
    asked = ledger.findings().withColumn("nth", F.array_position(order, F.col("kind")))
    listed = asked.filter("nth > 0").groupBy("blob").agg(F.array_sort(F.collect_list(
        F.struct("start", "nth", "end", "kind"))).alias("found"))

    def written(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    names = [r.kind for r in BASE_RULES]
    base = F.filter("found", lambda s: s["kind"].isin(names))
    per_blob = materialize(listed.select(
        "blob",
        *[_number_of(kind) for kind in names],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
    ), "per_blob")
    joined = held.select("doc_id", "blob").join(per_blob, "blob", "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in names],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), "blob",
    )
