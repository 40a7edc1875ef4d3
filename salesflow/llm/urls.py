"""URL filter over a sorted digest array.

The rules (host, path, verdict) become one file: their 64-bit xxhash keys, sorted, and after them the
rules' full strings and verdicts. It is written to the scratch folder that all executors share, and
Spark hands each executor a copy once, which tasks map into memory: nothing is loaded but the pages a
search touches, so a list larger than a worker's memory still serves. A task hashes, for a batch of
urls, every suffix of the host at a dot that is as long as some rule's host with every prefix of the
path that is as long as some rule's path (so a long url costs no more than its length), finds all keys in one vectorised binary search, and compares the stored string of each hit, so
that two strings with one key are told apart."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.staging import scratch_path

_SEED = 42  # as Spark's xxhash64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_bytes(rules: Iterator[tuple[int, str, str, int]], n: int) -> Iterator[bytes]:
    """The file: n and the numbers of path lengths and of host lengths, those lengths, keys, ends of
    strings, lengths of hosts, verdicts, strings. ``rules`` are (unsigned key, host, path, verdict) sorted by key."""
    keys, ends, verdicts, hosts, strings = (np.zeros(n, "<u8"), np.zeros(n, "<u8"), bytearray(), np.zeros(n, "<u4"), [])
    lengths: set[int] = set()
    end = 0
    for i, (key, host, path, verdict) in enumerate(rules):
        text = (host + path).encode("utf-8", "surrogatepass")
        end += len(text)
        keys[i], ends[i], hosts[i] = key, end, len(host)
        verdicts.append(verdict)
        strings.append(text)
        lengths.add(len(path))
    host_lengths = np.unique(hosts)
    yield struct.pack("<QQQ", n, len(lengths), len(host_lengths))
    yield np.array(sorted(lengths), "<u8").tobytes()
    yield host_lengths.astype("<u8").tobytes()
    yield keys.tobytes()
    yield ends.tobytes()
    yield hosts.tobytes()
    yield bytes(verdicts)
    yield from strings


class DigestArray:
    """A rule file, mapped into memory."""

    def __init__(self, path: str) -> None:
        data = np.memmap(path, dtype=np.uint8, mode="r")
        self.n, n_lengths, n_hosts = struct.unpack("<QQQ", data[:24].tobytes())
        at = 24
        self.lengths = data[at : at + 8 * n_lengths].view("<u8").tolist()
        at += 8 * n_lengths
        self.host_lengths = frozenset(data[at : at + 8 * n_hosts].view("<u8").tolist())
        at += 8 * n_hosts
        self.keys = data[at : at + 8 * self.n].view("<u8")
        at += 8 * self.n
        self.ends = data[at : at + 8 * self.n].view("<u8")
        at += 8 * self.n
        self.hosts = np.frombuffer(data, dtype="<u4", count=self.n, offset=at)
        at += 4 * self.n
        self.verdicts = data[at : at + self.n]
        self.strings = data[at + self.n :]

    def rule(self, i: int) -> bytes:
        return self.strings[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def lookup(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """For each url the longest fitting rule and its verdict, or nulls. Of rules of one length
        that of the longer host wins."""
        owner, texts = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            starts = [0] + [k + 1 for k, c in enumerate(host) if c == "."] if host else []
            starts = [start for start in starts if len(host) - start in self.host_lengths]
            for start in starts:
                for length in self.lengths:
                    if length <= len(path):
                        owner.append(i)
                        texts.append((host[start:] + path[:length]).encode("utf-8", "surrogatepass"))
        keys = np.array([xxhash.xxh64_intdigest(t, _SEED) for t in texts], dtype=np.uint64)
        first = np.searchsorted(self.keys, keys)
        best: list[tuple[int, int, int]] = [(-1, -1, -1)] * len(hosts)
        inside = first < self.n
        hit = np.flatnonzero(inside)
        hit = hit[self.keys[first[hit]] == keys[hit]]
        for c in hit:
            at = int(first[c])
            while at < self.n and self.keys[at] == keys[c]:  # equal keys stand together
                if self.rule(at) == texts[c]:
                    length = len(texts[c].decode("utf-8", "surrogatepass"))
                    best[owner[c]] = max(best[owner[c]], (length, int(self.hosts[at]), at))
                at += 1
        return [
            (self.rule(at).decode("utf-8", "surrogatepass"), _VERDICTS[self.verdicts[at]]) if at >= 0 else (None, None)
            for _, _, at in best
        ]


def publish_rules(rules: DataFrame, *, max_rules: int = 50_000_000) -> str:
    """Write ``rules(host, path, verdict)`` as a rule file, give it to all executors, and return its
    name there. Hosts are lower-cased; null hosts or paths are empty, rules with an empty host or a
    null verdict are left out; of a rule given twice with different verdicts, block counts. Spark
    hashes and sorts the rules; the driver passes them on from one partition at a time."""
    spark = rules.sparkSession
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), _UPPER, _LOWER)
    ready = (
        rules.select(
            host.alias("host"),
            F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
            F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0).alias("verdict"),
        )
        .filter("host != '' and verdict is not null")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.xxhash64(F.concat("host", "path")))
    )
    n = ready.count()
    if n > max_rules:
        raise ValueError(f"{n} rules, more than max_rules={max_rules}")
    # flipping the sign bit makes the order of signed keys that of unsigned ones
    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    ordered = ready.orderBy(unsigned, "host", "path").toLocalIterator()
    rows = ((r["key"] & ((1 << 64) - 1), r["host"], r["path"], r["verdict"]) for r in ordered)
    target = scratch_path(spark, "url-rules")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath)
    try:
        for block in _blocks(_rule_bytes(rows, n)):
            out.write(block)
    finally:
        out.close()
    spark.sparkContext.addFile(target)
    return target.rsplit("/", 1)[-1]


def _blocks(parts: Iterator[bytes], size: int = 1 << 20) -> Iterator[bytes]:
    held = bytearray()
    for part in parts:
        held += part
        while len(held) >= size:
            yield bytes(held[:size])
            del held[:size]
    yield bytes(held)


def judge(
    pages: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow", max_rules: int = 50_000_000
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the longest fitting rule, or
    null) and ``verdict`` (the rule's, else ``default``). A rule fits its host and all hosts below
    it if the url's path starts with the rule's. Null urls and urls without ``://`` have an empty
    host and path and fit no rule. Urls may be of any length. Every row is judged by itself, so repeated rows stay equal;
    columns named like a new one are replaced, all others kept."""
    name = publish_rules(rules, max_rules=max_rules)
    held: dict[str, DigestArray] = {}

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def looked_up(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        if not held:
            held["rules"] = DigestArray(SparkFiles.get(name))
        found = held["rules"].lookup(hosts.tolist(), paths.tolist())
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    url = F.col(url_col).cast("string")
    found = "_found"
    while found in pages.columns:
        found = f"_{found}"
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    judged = judged.withColumn(found, looked_up("host", "path"))
    verdict = F.coalesce(F.col(found)["verdict"], F.lit(default))
    return judged.withColumns({"rule": F.col(found)["rule"], "verdict": verdict}).drop(found)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
