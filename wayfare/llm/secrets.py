"""Operator 4: secret scans with an incremental blob ledger (DataFrame functions only).

Every version of every path is content-addressed by the SHA-256 of its text. The ledger
holds one row for each (blob, rule, rule version) scanned, with its findings. A scan
looks only at pairs that the ledger lacks, so equal texts under many paths, unchanged
history and unchanged rules cost nothing; findings are then joined back to all paths.

Spans come from the text split by a rule's pattern beside the list of its matches: the
lengths of the pieces, summed in order, are the positions in code points.

Defined results: a null text is the empty text; null and repeated paths are rows like
others; no match gives empty strings and zero counts. An empty table gives no rows. Very
long texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.shared import Scratch


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts when ``group`` has ``min_chars`` characters. ``search``
    may name a pattern that finds the counting matches alone. ``tight``: the finding is
    ``group``, at the match's end, not all of the match. ``needs``: text that every match
    holds, looked for first. Raise ``version`` when the rule
    changes, so that old blobs are scanned again. A pattern must take time in proportion
    to the text, also in a long run of its own characters: let it start at a run's start."""
    name: str
    pattern: str
    group: int = 0
    min_chars: int = 0
    version: int = 1
    search: str | None = None
    tight: bool = False
    needs: str | None = None


# The three base kinds and their order.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, search=r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, search=r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, version=2,
         tight=True, needs="eyJ"),
)
LEDGER_SCHEMA = ("blob string, rule string, rule_version int, "
                 "found array<struct<start:long,end:long,rule:string>>")


def with_blob(versions: DataFrame) -> DataFrame:
    """``versions`` (path, text) with the content address of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.select("path", text.alias("text"), F.sha2(text, 256).alias("blob"))


def _pieces(rule: Rule):
    text, pattern = F.col("text"), rule.search or rule.pattern
    lengths = lambda parts: F.transform(parts, F.char_length)
    found = text.rlike(pattern) if rule.needs is None else F.contains(text, F.lit(rule.needs)) & text.rlike(pattern)
    return F.when(found, F.struct(
        lengths(F.split(text, pattern, -1)).alias("gaps"),
        lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("spans"),
        lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))).alias("values")))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...], scratch: Scratch) -> DataFrame:
    """Ledger rows of (blob, text, rules) where ``rules`` lists the names still to scan."""
    table = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"),
                               F.lit(r.min_chars).alias("least"), F.lit(r.tight).alias("tight"),
                               F.when(F.array_contains("rules", r.name), _pieces(r)).alias("m")) for r in rules])
    scanned = scratch.write(blobs.select("blob", "rules", F.explode(table).alias("s")).filter(
        F.array_contains("rules", F.col("s.rule"))).select("blob", "s.*"), "scanned")
    # One short row for each match; its start is the sum of what precedes it in the blob.
    rows = scanned.filter("m IS NOT NULL").select(
        "blob", "rule", "least", "tight",
        F.posexplode(F.arrays_zip(F.col("m.gaps").alias("gap"), F.col("m.spans").alias("span"),
                                  F.col("m.values").alias("value"))).alias("at", "x")
    ).dropDuplicates(["blob", "rule", "at"])
    before = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    length = F.coalesce(F.col("x.span"), F.lit(0))
    placed = rows.withColumn("end", F.sum(F.col("x.gap") + length).over(before)).filter(
        F.col("x.value") >= F.col("least"))
    own = F.when(F.col("tight"), F.col("x.value")).otherwise(length)
    found = placed.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("end") - own).cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        "rule"))).alias("found"))
    return (scanned.select("blob", "rule", "rule_version").join(found, ["blob", "rule"], "left")
            .select("blob", "rule", "rule_version", F.coalesce("found", F.array().cast(
                "array<struct<start:bigint,end:bigint,rule:string>>")).alias("found")))


def update_ledger(versions: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None = None,
                  scratch: Scratch | None = None) -> DataFrame:
    """The ledger with every blob of ``versions`` (path, text) scanned by every rule.

    Pairs that the ledger holds are not scanned again."""
    scratch = scratch or Scratch(versions.sparkSession, "secrets")
    addressed = with_blob(versions)
    # One path for each blob, and how many rows repeat the blob at that path.
    blobs = (addressed.groupBy("blob", "path").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("blob").agg(F.min(F.struct("path", "n")).alias("m")).select("blob", "m.path", "m.n"))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    if ledger is not None:
        current = F.array(*[F.concat_ws("@", F.lit(r.name), F.lit(r.version)) for r in rules])
        known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "rule_version")).alias("known"))
        blobs = blobs.join(known, "blob", "left")
        wanted = F.transform(F.array_except(current, F.coalesce("known", F.array().cast("array<string>"))),
                             lambda x: F.element_at(F.split(x, "@"), 1))
    todo = scratch.write(blobs.withColumn("rules", wanted).filter(F.size("rules") > 0)
                         .select("blob", "path", "n", "rules"), "unseen")
    on = todo.withColumnsRenamed({"blob": "_blob", "path": "_path"})
    # One text for each unseen blob: its smallest path. Rows that repeat that path and text
    # are merged before the scan, where there are any.
    texts = addressed.join(on, F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob")))
    texts = texts.select("blob", "text", "rules")
    if not todo.filter("n > 1").isEmpty():
        texts = texts.groupBy("blob").agg(F.min("text").alias("text"), F.min("rules").alias("rules"))
    new = scratch.write(scan_blobs(texts, rules, scratch), "ledger")
    return new if ledger is None else ledger.unionByName(new)


def path_findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(path, blob, found): the findings of the current rules for every path; the spans
    are ordered by start, then by the order of ``rules``."""
    current = F.array(*[F.concat_ws("@", F.lit(r.name), F.lit(r.version)) for r in rules])
    rank = F.array(*[F.lit(r.name) for r in rules])
    per_blob = (ledger.filter(F.array_contains(current, F.concat_ws("@", "rule", "rule_version")))
                .filter(F.size("found") > 0)
                .groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found")))
    ordered = F.transform(F.array_sort(F.transform("found", lambda x: F.struct(
        x["start"].alias("start"), F.array_position(rank, x["rule"]).alias("rank"), x["end"].alias("end"),
        x["rule"].alias("rule")))), lambda x: F.struct(x["rule"], x["start"], x["end"]))
    per_blob = per_blob.select("blob", ordered.alias("found"))
    return with_blob(versions).select("path", "blob").join(per_blob, "blob", "left")


def _count(kind: str):
    of_kind = F.filter("found", lambda x: x["rule"] == kind)
    return F.when(F.col("found").isNull(), F.lit(0)).otherwise(F.size(of_kind)).cast("long")


def _joined(found):
    text = F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])))
    return F.coalesce(text, F.lit(""))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, mask: str = "[SECRET]") -> DataFrame:
    """Every row and column of ``docs`` with each found span of ``text`` replaced by
    ``mask``; overlapping spans share one mask. A null text stays null. ``docs`` may not
    have columns ``_blob`` or ``_spans``."""
    clash = [c for c in docs.columns if c in ("_blob", "_spans")]
    if clash:
        raise ValueError(f"columns clash with working columns: {clash}")
    scratch = Scratch(docs.sparkSession, "secrets")
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    ledger = update_ledger(versions, rules, scratch=scratch).filter(F.size("found") > 0)
    spans = ledger.select("blob", F.explode("found").alias("s")).select("blob", "s.start", "s.end")
    order = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (spans.withColumn("opens", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
              .withColumn("run", F.sum("opens").over(order))
              .groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
              .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans")))
    merged = scratch.write(merged, "merged")
    scratch.keep_only(merged)
    merged = merged.withColumnRenamed("blob", "_blob")
    address = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    rows = docs.join(merged, address == F.col("_blob"), "left")
    before = F.transform("_spans", lambda x, i: F.concat(F.substring(
        "text", (F.when(i == 0, 0).otherwise(F.col("_spans")[i - 1]["end"]) + 1).cast("int"),
        (x["start"] - F.when(i == 0, 0).otherwise(F.col("_spans")[i - 1]["end"])).cast("int")), F.lit(mask)))
    tail = F.expr("substring(text, cast(element_at(_spans, -1).end + 1 as int))")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(before, ""), tail))
    return rows.withColumn("text", text).select(*docs.columns)


def secrets_query(documents: DataFrame) -> DataFrame:
    """Query ``op4_secret_scan``: counts, base digest and all spans of every document."""
    rules = BASE_RULES + MORE_RULES
    scratch = Scratch(documents.sparkSession, "secrets")
    versions = documents.select(F.col("doc_id").alias("path"), "text")
    ledger = update_ledger(versions, rules, scratch=scratch)
    found = scratch.write(ledger.filter(F.size("found") > 0), "found")
    scratch.keep_only(found)
    rows = path_findings(versions, found, rules)
    base = F.filter("found", lambda x: x["rule"].isin([r.name for r in BASE_RULES]))
    return rows.select(F.col("path").alias("doc_id"),
                       *[_count(r.name).alias(f"n_{r.name}") for r in BASE_RULES],
                       F.sha2(_joined(base), 256).alias("base_sha256"),
                       _joined(F.col("found")).alias("spans"))
