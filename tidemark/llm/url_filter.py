"""URL filters: rules by host and path, then a sorted digest array of listed strings.

A rule such as ``example.org/es/`` fits its host and all subdomains where the
url's path starts with the rule's path; the longest rule wins (then the one
that sorts first). Urls that no rule fits are looked up in a list of full
strings ``host + path``. The list may be of any size: list and probes are dealt
out by the leading bits of the strings' 64-bit xxhash. A task streams the list
of a shard, sorted by key, into a file of keys and one of strings, maps both into
memory, probes the keys by vectorised binary search, and compares the stored
string with the url's wherever a key is equal, so a collision of digests
never counts. Probes are made distinct before they are dealt out, so a url that many
pages share is probed once. The files have no name and vanish with the task.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; null ids are carried, and of a url that only pages
without an id share all are kept; repeated rows each get a row; an empty table or list gives no match; other columns are ignored.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower

#: Leading bits of a key that make its shard.
SHARD_BITS = 12
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (lower-cased) and ``path``."""
    part = lambda k: F.coalesce(F.regexp_extract(F.col(url), PARTS, k), F.lit(""))
    return pages.withColumns({"host": ascii_lower(part(1)), "path": part(2)})


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest fitting (rule, verdict).

    Rules are configuration and become one expression; long lists belong into
    the digest array."""
    rule = verdict = None
    for text, then in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, slash, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith(f".{host}"))
                & F.col("path").startswith(slash + path))
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(then)) if verdict is None else verdict.when(fits, F.lit(then))
    none = F.lit(None).cast("string")
    return pages.withColumns({"rule": none if rule is None else rule,
                              "rule_verdict": none if verdict is None else verdict})


class DigestArray:
    """Sorted keys and their full strings, in unnamed files mapped into memory."""

    def __init__(self) -> None:
        self.files = [tempfile.TemporaryFile() for _ in range(5)]
        self.clear()

    def clear(self) -> None:
        self.mapped = None
        self.size = self.end = 0
        for f in self.files:
            f.seek(0)
            f.truncate()

    def append(self, keys: np.ndarray, strings: list[bytes], values: list[int | None]) -> None:
        """The next entries in order of their keys."""
        ends = self.end + np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
        known = np.array([v is not None for v in values], np.int64)
        values = np.array([v or 0 for v in values], np.int64)
        for f, data in zip(self.files, (keys.astype(np.int64).tobytes(), ends.tobytes(),
                                        values.tobytes(), known.tobytes(), b"".join(strings))):
            f.write(data)
        self.size, self.end = self.size + len(keys), int(ends[-1])

    def probe(self, keys: np.ndarray, strings: list[bytes]) -> tuple[list[int], list[int | None]]:
        """Numbers of the probes that are listed, and the entries' values."""
        if not self.size:
            return [], []
        if self.mapped is None:
            for f in self.files:
                f.flush()
            self.mapped = [np.memmap(f, np.int64, "r") for f in self.files[:4]]
            self.text = (mmap.mmap(self.files[4].fileno(), 0, access=mmap.ACCESS_READ)
                         if self.end else b"")
        stored, ends, values, known = self.mapped
        first = np.searchsorted(stored, keys, side="left")
        last = np.searchsorted(stored, keys, side="right")
        hits, found = [], []
        for k in np.flatnonzero(first < last).tolist():
            for at in range(first[k], last[k]):      # entries of equal digest
                start = int(ends[at - 1]) if at else 0
                if self.text[start:int(ends[at])] == strings[k]:
                    hits.append(k)
                    found.append(int(values[at]) if known[at] else None)
                    break
        return hits, found


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, is_probe, key, entry, value), sorted in this order."""
    array, shard = DigestArray(), None
    for batch in batches:
        shards, probe, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        entries = batch.column(3).cast(pa.binary())
        cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(probe.astype(np.int8)) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
            if a == b:
                continue
            if shards[a] != shard:
                array.clear()
                shard = shards[a]
            strings = entries.slice(a, b - a).to_pylist()
            if not probe[a]:
                array.append(keys[a:b], strings, batch.column(4).slice(a, b - a).to_pylist())
                continue
            hits, found = array.probe(keys[a:b], strings)
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(3).slice(a, b - a).take(pa.array(hits)),
                     pa.array(found, pa.int64())], ["entry", "value"])


def listed_among(entries: DataFrame, listed: DataFrame) -> DataFrame:
    """(entry, value) for each distinct ``entry`` that ``listed`` (entry, value) holds;
    an entry that is listed more than once has its smallest value (null if all are null)."""
    own = listed.where(F.col("entry").isNotNull()).groupBy("entry").agg(
        F.min("value").cast("long").alias("value"))
    probes = entries.where(F.col("entry").isNotNull()).select("entry").distinct()
    rows = own.withColumn("is_probe", F.lit(False)).unionByName(
        probes.withColumns({"is_probe": F.lit(True), "value": F.lit(0).cast("long")}))
    key = F.xxhash64("entry")
    rows = rows.select(F.shiftrightunsigned(key, 64 - SHARD_BITS).cast("int").alias("shard"),
                       "is_probe", key.alias("key"), "entry", "value")
    # in a shard all keys have the same leading bits: signed order is unsigned order
    return (rows.repartition("shard").sortWithinPartitions("shard", "is_probe", "key", "entry")
            .mapInArrow(_probe, "entry string, value long"))


#: Rules of the crawl, longest fitting rule first.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))


def judge(pages: DataFrame, listed: DataFrame | None = None,
          rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``listed`` has (entry, value): strings ``host + path`` and the one page_id
    that may keep the url (null: pages without an id, so none where all have one). Without it the list is made of the
    pages themselves: urls that were fetched more than once, each kept by its
    smallest page_id."""
    rows = with_rule(with_parts(pages.select("page_id", "url")), rules).withColumn(
        "entry", F.when(F.col("host") != "", F.concat("host", "path")))
    if listed is None:
        listed = (rows.where("entry IS NOT NULL").groupBy("entry")
                  .agg(F.min("page_id").alias("value"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("entry", "value"))
    to_probe = F.col("rule").isNull() & F.col("entry").isNotNull()
    found = listed_among(rows.where(to_probe), listed).select(
        "entry", F.col("value").alias("_kept"), F.lit(True).alias("_listed"))
    blocked = F.col("_listed") & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    verdict = F.coalesce("rule_verdict", F.when(blocked, "block").otherwise("allow"))
    # rows that need no look-up (by rule, or without a host) take no part in the join
    rest = rows.where(~to_probe).withColumn("verdict", F.coalesce("rule_verdict", F.lit("allow")))
    columns = ["page_id", "host", "path", "rule", "verdict"]
    return (rows.where(to_probe).join(found, "entry", "left").withColumn("verdict", verdict)
            .select(*columns).unionByName(rest.select(*columns)))
