"""URL filtering by a sort-merge range join on reversed-host keys.

A host is written with its labels reversed and a full stop after each (``www.example.org`` becomes
``org.example.www.``), so a rule's host and all its subdomains are one interval of keys, and intervals
of different rules are nested or disjoint. URLs are sorted by (key, path) into ranges; each rule joins
the ranges that its interval touches; and one sweep over a range, rules before URLs of the same key,
keeps the stack of the rules whose intervals are open. Every URL looks only at that stack: the longest
rule whose path starts the URL's path wins.

"Longest" counts host and path together, then the longer host, and of equal rules a block wins.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the
default verdict; ports and user names count as part of the host; repeated pages are judged alike; with
no rules every page gets the default; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, partitions_for, stored

JUDGED = "page_id string, host string, path string, rule string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels of a host from the last to the first, each followed by a full stop."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def _touched(ranges: list[tuple[int, str]]):
    """The ranges that a rule's interval of keys touches; given number and first key of each range."""
    numbers = [number for number, _ in ranges]
    bounds = np.array([key.encode() for _, key in ranges], dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            touched = []
            for key in frame["key"]:
                low = key.encode()
                # keys of the host and its subdomains start with ``low``; 0xff is in no UTF-8 text
                first = max(0, int(np.searchsorted(bounds, low)) - 1)
                last = int(np.searchsorted(bounds, low + b"\xff"))
                touched.append(numbers[first:last])
            yield frame.assign(part=touched).explode("part").dropna(subset=["part"]).astype({"part": "int32"})

    return run


class RuleStack:
    """The open rules of a sweep: one entry a host key, with its path rules."""

    def __init__(self):
        self.open: list[tuple[str, dict[str, tuple[str, str, int]]]] = []

    def advance(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, path: str, rule: str, verdict: str, host_length: int) -> None:
        self.advance(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}))
        paths = self.open[-1][1]
        if path not in paths or verdict == "block":
            paths[path] = (rule, verdict, host_length)

    def best(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.advance(key)
        found = None
        for _, paths in self.open:
            lengths = {len(p) for p in paths} if len(paths) > 8 else None
            fitting = (
                (path[:n] for n in lengths if n <= len(path) and path[:n] in paths)
                if lengths is not None
                else (p for p in paths if path.startswith(p))
            )
            for start in fitting:
                rule, verdict, host_length = paths[start]
                rank = (len(rule), host_length)
                if found is None or rank > found[0]:
                    found = (rank, rule, verdict)
        return (found[1], found[2]) if found else (None, None)


def _sweep(default: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack, part = RuleStack(), None
        for frame in frames:
            kept, rules, verdicts = [], [], []
            for k, row in enumerate(
                zip(
                    frame["part"], frame["key"], frame["is_url"], frame["path"], frame["rule"],
                    frame["verdict"], frame["host"], strict=True,
                )
            ):
                at, key, is_url, path, rule, verdict, host = row
                if at != part:
                    stack, part = RuleStack(), at
                if not is_url:
                    stack.add(key, path, rule, verdict, len(host))
                    continue
                best, found = stack.best(key, path) if key else (None, None)
                kept.append(k)
                rules.append(best)
                verdicts.append(found or default)
            yield frame.iloc[kept][["page_id", "host", "path"]].assign(
                rule=pd.Series(rules, index=frame.index[kept], dtype=object),
                verdict=pd.Series(verdicts, index=frame.index[kept], dtype=object),
            )

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``pages`` has page_id and url, ``rules`` has host, path and verdict (allow or block). The driver
    sees the first key of each range, one string a partition. A host with a third of all pages is
    split over ranges by path and page number, and only its rules are repeated in each.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host")))
    parts = partitions_for(urls)
    ranged = urls.repartitionByRange(parts, "key", "path", "page_id")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "url-ranges")
    firsts = ranged.groupBy("part").agg(F.min("key").alias("key")).orderBy("part").collect()
    keyed = rules.select(
        F.col("path"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        "host",
        host_key(F.col("host")).alias("key"),
    )
    ranges = [(row["part"], row["key"]) for row in firsts]
    names = "path string, rule string, verdict string, host string, key string, part int"
    spread = keyed.mapInPandas(_touched(ranges), names)
    both = ranged.select(
        "part", "key", F.lit(True).alias("is_url"), "path",
        # as text, since pandas would make a column with gaps floating
        F.col("page_id").cast("string").alias("page_id"), "host",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    ).unionByName(
        spread.select(
            "part", "key", F.lit(False).alias("is_url"), "path",
            F.lit(None).cast("string").alias("page_id"), "host", "rule", "verdict",
        )
    )
    swept = both.repartition(parts, "part").sortWithinPartitions(
        "part", "key", "is_url", "path", "page_id", "verdict"
    )
    judged = swept.mapInPandas(_sweep(default), JUDGED)
    return judged.withColumn("page_id", F.col("page_id").cast("long"))
