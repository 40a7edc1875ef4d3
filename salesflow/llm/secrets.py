"""Secret scan with an incremental blob ledger.

A version of a file is a blob, named by the SHA-256 of its text; a version of a rule is named by the
SHA-256 of all that it says. The ledger is a table of the pairs (blob, rule version) scanned so far, with
the findings. A scan reads only blobs for which the ledger lacks some of its rules, each once, however
many paths and versions hold it, and for those rules alone; then it joins the findings of all blobs back
to all paths. A new or changed rule scans every blob for that rule; new files with known content scan
nothing.

Positions are code points. Spark's regular expressions return matches but no positions, so a text is
split at a rule's matches, and the lengths of the pieces and matches before one add up to its start."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.staging import scratch_path, stage

FINDING = "array<struct<start:int,kind_order:int,kind:string,end:int>>"
_STORED = "array<struct<start:int,end:int,rule:string>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern whose matches count if the given group has enough characters."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0

    @property
    def version(self) -> str:
        """Another one for every other pattern, group, length or kind."""
        told = json.dumps([self.kind, self.pattern, self.group, self.min_length])
        return hashlib.sha256(told.encode()).hexdigest()[:32]


# fixed values: the patterns and lengths of the base kinds are a contract, in the order of kinds
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_length=6,
    ),
    # a run that is long enough matches alike with or without the shorter ones beside it
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i)\bbearer\x20+[A-Za-z0-9+/_.=-]{16,}"),
)
RULES = BASE_RULES + EXTRA_RULES
_AT_ONCE = 256


def _findings(text: Column, rule: Rule) -> Column:
    """Array of findings of one rule, as they are stored, in the order of their starts; empty where
    nothing matches."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
    matches = F.regexp_extract_all(text, pattern, 0)
    checked = F.regexp_extract_all(text, pattern, rule.group) if rule.group else matches
    steps = F.arrays_zip(
        F.slice(pieces, 1, F.size(matches)).alias("before"),
        F.transform(matches, lambda m: F.length(m)).alias("long"),
        F.transform(checked, lambda m: F.length(m) >= rule.min_length).alias("counts"),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["before"]
        end = (start + step["long"]).alias("end")
        found = F.struct(start.alias("start"), end, F.lit(rule.version).alias("rule"))
        more = F.when(step["counts"], F.concat(state["found"], F.array(found))).otherwise(state["found"])
        return F.struct((start + step["long"]).alias("at"), more.alias("found"))

    nothing = _nothing()
    none_yet = F.coalesce(F.lit(None).cast(f"array<{_STORED}>"), F.array().cast(f"array<{_STORED}>"))

    def gather(steps: Column) -> Column:
        # An array grows by copying it: matches are added to short arrays, and those to an array of
        # them, so that a text with very many matches takes time in proportion.
        def add_some(state: Column, part: Column) -> Column:
            some = F.slice(steps, part * _AT_ONCE + 1, _AT_ONCE)
            done = F.aggregate(some, F.struct(state["at"].alias("at"), nothing.alias("found")), add)
            return _with(
                done,
                lambda d: F.struct(d["at"].alias("at"), F.concat(state["found"], F.array(d["found"])).alias("found")),
            )

        parts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _AT_ONCE).cast("int"))
        start = F.struct(F.lit(0).alias("at"), none_yet.alias("found"))
        return F.flatten(F.aggregate(parts, start, add_some, lambda state: state["found"]))

    return F.when(text.rlike(rule.pattern), _with(steps, gather)).otherwise(nothing)


def _nothing() -> Column:
    return F.coalesce(F.lit(None).cast(_STORED), F.array().cast(_STORED))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _told(stored: Column, rules: tuple[Rule, ...]) -> Column:
    """Stored findings of these rules, by start, then in the order of the rules."""
    versions = F.array(*[F.lit(r.version) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    mine = F.filter(stored, lambda f: F.array_contains(versions, f["rule"]))

    def told(f: Column) -> Column:
        at = F.array_position(versions, f["rule"]).cast("int")
        return F.struct(
            f["start"].alias("start"), (at - 1).alias("kind_order"), F.get(kinds, at - 1).alias("kind"), f["end"].alias("end")
        )

    return F.array_sort(F.transform(mine, told)).cast(FINDING)


def scan_text(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All findings of a text, by start, then by the order of the rules."""
    return _told(F.concat(*[_findings(text, rule) for rule in rules]), rules)


def blob_id(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class BlobLedger:
    """Findings per blob and rule version, a parquet table at ``path`` that only grows: each row has a
    blob, the rule versions it was scanned for, and what they found."""

    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, spark) -> DataFrame | None:
        """``(blob, rules, findings)``, a row per blob; none if the ledger has nothing at all."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        rows = spark.read.schema(f"blob string, rules array<string>, findings {_STORED}").parquet(self.path)
        # a row per scan that had a rule to scan it for; of scans at the same time, which find the same,
        # each rule's findings are taken from one
        scans = rows.groupBy("blob").agg(F.collect_list(F.struct("rules", "findings")).alias("scans"))

        def join(state: Column, scan: Column) -> Column:
            more = F.array_except(scan["rules"], state["rules"])
            found = F.filter(scan["findings"], lambda f: F.array_contains(more, f["rule"]))
            return F.struct(
                F.concat(state["rules"], more).alias("rules"), F.concat(state["findings"], found).alias("findings")
            )

        none = F.struct(F.array().cast("array<string>").alias("rules"), _nothing().alias("findings"))
        return scans.select("blob", F.aggregate("scans", none, join).alias("all")).select("blob", "all.*")

    def add(self, scanned: DataFrame) -> None:
        scanned.select("blob", "rules", "findings").write.mode("append").parquet(self.path)


def scan(
    files: DataFrame,
    ledger: BlobLedger | None = None,
    rules: tuple[Rule, ...] = RULES,
    *,
    text_col: str = "text",
) -> DataFrame:
    """``files``, every historical version of every path a row, without the text and with ``blob``
    and ``findings`` (start, kind, end of every span, by start, then in the order of the rules).

    Blobs are scanned, each once, for those of the rules that the ledger lacks for them, and added to
    it; without a ledger a new one is made in the scratch folder. A null text is an empty one. Rows that
    are repeated or share a text share its findings; an empty table gives an empty one. Columns named
    ``blob`` or ``findings`` are replaced, all others kept."""
    if len({r.version for r in rules}) < len(rules):
        raise ValueError("a rule is given twice")
    spark = files.sparkSession
    ledger = ledger or BlobLedger(scratch_path(spark, "ledger"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # one row per blob: the partial aggregate leaves one per task before the shuffle
    blobs = files.select(blob_id(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    every = F.array(*[F.lit(r.version) for r in rules])
    known = ledger.read(spark)
    if known is None:
        unseen = blobs.withColumn("rules", every)
    else:
        done = F.coalesce("done", F.array().cast("array<string>"))
        unseen = blobs.join(known.select("blob", F.col("rules").alias("done")), "blob", "left").select(
            "blob", "text", F.array_except(every, done).alias("rules")
        )
        unseen = unseen.filter(F.size("rules") > 0)
    wanted = lambda rule: F.array_contains("rules", rule.version)
    found = [F.when(wanted(r), _findings(F.col("text"), r)).otherwise(_nothing()) for r in rules]
    ledger.add(unseen.withColumn("findings", F.concat(_nothing(), *found)))
    # read from files, so that Spark can split the join at a blob that very many paths hold
    known = ledger.read(spark).select("blob", _told(F.col("findings"), rules).alias("findings"))
    known = stage(known, "findings")
    return files.withColumn("blob", blob_id(text)).drop(text_col, "findings").join(known, "blob")


def digest(findings: Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the findings, of some kinds only if given, joined by commas."""
    chosen = findings if kinds is None else F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
