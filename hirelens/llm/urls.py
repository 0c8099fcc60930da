"""URL filters as a sort-merge range join over canonical keys.

A host's key is its labels in reverse, each followed by a dot: the rules and
pages of a domain and of all its subdomains are then one interval of keys, and
the intervals of two rules are nested or apart. Pages and rules are dealt to
ranges of keys (a rule to every range that its interval meets, a host that
fills several ranges to all of these), sorted, and read once per range with a
stack of the rules whose interval is still open. A rule's path is looked up in
its frame of the stack, since a path under any subdomain is not one interval.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hirelens.llm.common import shuffle_width

#: sampled keys per range for the ranges' bounds (they only balance the work)
SAMPLED = 60
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow",
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules``: host, path, verdict (allow or block), of any number. A rule
    fits its host and all subdomains if the path starts with the rule's; the
    rule longest as written (host and path together) wins, of equal rules the
    block. Without a rule: rule null, verdict ``otherwise``. Null urls and urls
    without ``://`` have empty host and path, which no rule fits. Repeated
    rows are judged each; an empty table gives no rows; other columns are
    ignored.
    """
    spark = pages.sparkSession
    parts = max(1, shuffle_width(spark))
    url = pages[url_col]
    rows = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")) \
        .withColumn("key", host_key(F.col("host")))
    bounds = _bounds(rows.select("key"), parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = []
            for k, p, path in zip(batch["key"].to_pylist(), batch["page_id"].to_pylist(), batch["path"].to_pylist()):
                lo, hi = bisect_left(bounds, k), bisect_right(bounds, k)
                to.append(lo + zlib.crc32(f"{p} {path}".encode()) % max(1, hi - lo))
            n = batch.num_rows
            none = pa.nulls(n, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), batch["key"], pa.array([1] * n, pa.int32()), none, batch["page_id"],
                 batch["host"], batch["path"], none],
                names=["part", "key", "kind", "until", "page_id", "host", "path", "verdict"])

    id_type = rows.schema["page_id"].dataType.simpleString()
    schema = (f"part int, key string, kind int, until string, page_id {id_type}, host string, path string, "
              "verdict string")
    name = F.translate(F.coalesce("host", F.lit("")), UPPER, UPPER.lower())
    opened = (rules.select(name.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
              .withColumn("key", host_key(F.col("host")))
              .withColumn("until", F.regexp_replace("key", r"\.$", "/"))
              .where("host <> ''"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for part in range(bisect_left(bounds, r["key"]), bisect_left(bounds, r["until"]) + 1):
                    out.append({"part": part, "key": r["key"], "kind": 0, "until": r["until"], "page_id": None,
                                "host": r["host"], "path": r["path"], "verdict": r["verdict"]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=wire)

    wire = to_arrow_schema(StructType.fromDDL(schema))
    both = rows.mapInArrow(deal, schema).unionByName(
        opened.select("host", "path", "verdict", "key", "until").mapInArrow(spread, schema))
    sorted_ = both.repartition(parts, "part").sortWithinPartitions("part", "key", "kind")
    result = f"page_id {id_type}, host string, path string, rule string, verdict string"
    return sorted_.mapInArrow(_sweep(otherwise, to_arrow_schema(StructType.fromDDL(result))), result)


def _bounds(keys: DataFrame, parts: int) -> list[str]:
    """Up to parts - 1 keys that cut a sample evenly, repeats kept: a host that
    fills several ranges appears as often. Bounded by the number of ranges."""
    total = keys.count()
    want = SAMPLED * parts
    if parts == 1 or not total:
        return []
    some = keys if total <= want else keys.sample(fraction=want / total, seed=7)
    got = sorted(r[0] for r in some.collect())
    return [got[len(got) * i // parts] for i in range(1, parts)] if got else []


def _sweep(otherwise: str, wire: pa.Schema):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # frames: (until, host, {path: verdict}, lengths of the paths)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                key = r["key"]
                if r["part"] != part:
                    part, stack = r["part"], []
                while stack and stack[-1][0] <= key:
                    stack.pop()
                if r["kind"] == 0:
                    if not stack or stack[-1][1] != r["host"]:
                        stack.append((r["until"], r["host"], {}, set()))
                    held = stack[-1][2]
                    if held.get(r["path"]) != "block":
                        held[r["path"]] = r["verdict"]
                    stack[-1][3].add(len(r["path"]))
                    continue
                best, path = None, r["path"]
                for _, host, held, lengths in stack:
                    for n in lengths:
                        if n <= len(path) and (verdict := held.get(path[:n])) is not None:
                            found = (len(host) + n, len(host), verdict == "block", host + path[:n], verdict)
                            best = max(best, found) if best else found
                out.append({"page_id": r["page_id"], "host": r["host"], "path": path,
                            "rule": best[3] if best else None, "verdict": best[4] if best else otherwise})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=wire)
    return sweep
