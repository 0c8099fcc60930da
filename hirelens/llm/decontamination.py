"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items, dealt to blocks of bounded size, are
built into one automaton a block: its states are the classes of word runs that
occur at the same places of the items. The training texts are streamed through
it; after each word the state and the length of the longest run that ends there
and occurs in an item are known, so a window of ``words`` words occurs exactly
where that length is ``words`` or more, and the state (climbed to the class of
the last ``words`` words by a table) names the items that hold it. Items
shorter than a window are windows of their own, found on the suffix links.

* An automaton is built by a Spark task (a block holds some BLOCK_WORDS words;
  an item longer than that is cut into parts that overlap by a window less
  one) and broadcast, one block at a time, so a broadcast is bounded at any
  size of the benchmark. Each block is one scan of the texts.
* Words that no item holds send the automaton back to its root, and a window
  needs all its word pairs to be pairs of some item, so a text is streamed only
  where a bitmap of the items' word pairs leaves room for a window.
* No text is shuffled. The items that a text meets are a set with a number of
  its own; each set is listed once, and equal combinations are digested once.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.bytewords import FOLD, each_text, folded_words
from hirelens.llm.common import drop, written
from hirelens.session import checked_broadcast

#: words of one block's automaton, which has at most twice as many states and
#: three times as many edges (some 60 bytes each in a worker)
BLOCK_WORDS = 250_000
#: words of an item that one part of it holds
PART_WORDS = 20_000

_FOUND = "doc_id long, h long, n_words long, longest long, spans array<struct<lo:int,hi:int>>, met string, items array<string>"


class Automaton:
    """The generalised suffix automaton of (item, words) pairs for windows of
    ``window`` words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        edges: list[dict[int, int]] = [{}]
        link, length = [-1], [0]

        def state(n: int, after: dict[int, int], up: int) -> int:
            edges.append(after)
            length.append(n)
            link.append(up)
            return len(link) - 1

        def split(p: int, t: int) -> int:
            """The state of p's run and t alone, apart from longer runs."""
            q = edges[p][t]
            if length[q] == length[p] + 1:
                return q
            own = state(length[p] + 1, dict(edges[q]), link[q])
            link[q] = own
            while p >= 0 and edges[p].get(t) == q:
                edges[p][t] = own
                p = link[p]
            return own

        numbered = []
        for item, words in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words]
            numbered.append((item, ids))
            at = 0
            for t in ids:
                if t in edges[at]:
                    at = split(at, t)
                    continue
                new = state(length[at] + 1, {}, 0)
                p = at
                while p >= 0 and t not in edges[p]:
                    edges[p][t] = new
                    p = link[p]
                if p >= 0:
                    link[new] = split(p, t)
                at = new

        order = sorted(range(1, len(link)), key=length.__getitem__)
        #: per state the class of the last ``window`` words of its runs, or 0
        self.whole = [0] * len(link)
        for v in order:
            if length[v] >= window:
                self.whole[v] = self.whole[link[v]] or v
        #: items by class, and short items with their lengths by state
        self.items: dict[int, list] = {}
        self.short: dict[int, list] = {}
        pairs, self.least = set(), window
        for item, ids in numbered:
            at = 0
            for j, t in enumerate(ids):
                at = edges[at][t]
                if j + 1 >= window:
                    have = self.items.setdefault(self.whole[at], [])
                    if not have or have[-1] != item:
                        have.append(item)
            if 0 < len(ids) < window:
                self.short.setdefault(at, []).append((len(ids), item))
                self.least = min(self.least, len(ids))
            pairs.update(zip(ids, ids[1:]))
        #: nearest state, from each up the links, with short items; or 0
        self.shorter = [0] * len(link)
        if self.short:
            for v in order:
                self.shorter[v] = v if v in self.short else self.shorter[link[v]]
        self.link, self.length, self.width = link, length, len(self.words) + 1
        self.step = {s * self.width + t: n for s, after in enumerate(edges) for t, n in after.items()}
        size = max(16, (16 * len(pairs)).bit_length())
        self.pair_bits, self.pairs = size, np.zeros(1 << size, bool)
        if pairs:
            a, b = np.array(sorted(pairs), np.int64).T
            self.pairs[self._pair(a, b)] = True

    def packed(self) -> bytes:
        return pickle.dumps(vars(self), 5)

    @classmethod
    def unpacked(cls, blob: bytes) -> Automaton:
        made = cls.__new__(cls)
        vars(made).update(pickle.loads(blob))
        return made

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.uint64) * np.uint64(self.width) + b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (key >> np.uint64(64 - self.pair_bits)).astype(np.int64)

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of the words outside of which no window can be."""
        known = ids > 0
        joined = known[1:] & known[:-1]
        if len(joined):
            joined &= self.pairs[self._pair(ids[:-1], ids[1:])]
        # a stretch breaks before each word that is not joined to the one before
        first = np.flatnonzero(np.concatenate([[True], ~joined]))
        last = np.append(first[1:], len(ids))
        keep = (last - first >= self.least) & known[first]
        return list(zip(first[keep].tolist(), last[keep].tolist()))

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """(spans [lo, hi) of hit words, ascending and apart; the keys of the
        items met; length of the longest run found, from the shortest window)."""
        spans: list[tuple[int, int]] = []
        met: set = set()
        longest = 0
        if not words or not self.words:
            return spans, met, 0
        get = self.words.get
        ids = np.array([get(w, 0) for w in words], np.int64)
        window, step, link, length = self.window, self.step, self.link, self.length
        whole, shorter, short, width = self.whole, self.shorter, self.short, self.width

        def hit(lo: int, hi: int) -> None:
            while spans and spans[-1][1] >= lo:
                lo = min(lo, spans.pop()[0])
            spans.append((lo, hi))

        for a, b in self.stretches(ids):
            at = n = 0
            for j, t in enumerate(ids[a:b].tolist(), a + 1):
                to = step.get(at * width + t)
                if to is None:
                    while at and to is None:
                        at = link[at]
                        to = step.get(at * width + t)
                    n = length[at]
                    if to is None:
                        continue
                at = to
                n += 1
                if n > longest:
                    longest = n
                if n >= window:
                    met.add(whole[at])
                    hit(j - window, j)
                up = shorter[at]
                while up:
                    for size, item in short[up]:
                        if size <= n:
                            met.add((up, size))
                            hit(j - size, j)
                    up = shorter[link[up]]
        return spans, met, longest if longest >= self.least else 0

    def names(self, met: set) -> list[str]:
        """The sorted ids of the items behind the keys of ``stream``."""
        out = set()
        for key in met:
            if isinstance(key, tuple):
                out.update(item for size, item in self.short[key[0]] if size <= key[1])
            else:
                out.update(self.items[key])
        return sorted(item for item in out if item is not None)


def _parts(items: DataFrame, words: int, part_words: int) -> DataFrame:
    """(item, part: space-joined words, n) rows; a part has ``words - 1`` words
    of the next one."""
    def cut(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), each_text(batch.column("text"))):
                every = folded_words(text)
                for lo in range(0, max(1, len(every) - words + 1), part_words):
                    part = every[lo:lo + part_words + words - 1]
                    if part:
                        out.append((item, b" ".join(part), len(part)))
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(cols[0]), pa.string()), pa.array(list(cols[1]), pa.binary()),
                                              pa.array(list(cols[2]), pa.int64())], names=["item", "part", "n"])
    return items.mapInArrow(cut, "item string, part binary, n long")


def _blocks(items: DataFrame, words: int, block_words: int) -> DataFrame:
    """(block, automaton: pickled) rows, each block of about ``block_words``
    distinct parts' words."""
    parts = written(_parts(items, words, min(PART_WORDS, block_words)).distinct(), "test-items")
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("item", "ascending")])
        number = table.column("block")[0].as_py()
        made = Automaton(list(zip(table.column("item").to_pylist(), (p.split() for p in table.column("part").to_pylist()))), words)
        return pa.table([pa.array([number], pa.int64()), pa.array([made.packed()], pa.binary())], names=["block", "automaton"])

    dealt = parts.withColumn("block", F.pmod(F.xxhash64("part", "item"), F.lit(max(1, blocks))))
    out = written(dealt.groupBy("block").applyInArrow(build, "block long, automaton binary"), "automata")
    drop(parts)
    return out


def _stream(texts: DataFrame, automaton, all_rows: bool) -> DataFrame:
    """What one block's automaton finds in the (doc_id, h, text) rows."""
    def found(batches):
        made = Automaton.unpacked(automaton.value)
        listed: dict[str, bool] = {}   # sets that this task has listed
        known: dict[frozenset, tuple[str, list]] = {}
        for batch in batches:
            rows = []
            ids, hashes = batch.column("doc_id"), batch.column("h")
            for i, text in enumerate(each_text(batch.column("text"))):
                words = folded_words(text)
                spans, met, longest = made.stream(words)
                if not spans and not all_rows:
                    continue
                key = names = None
                if met:
                    seen = frozenset(met)
                    if seen not in known:
                        if len(known) >= 10_000:
                            known.clear()
                        every = made.names(met)
                        known[seen] = (hashlib.md5(",".join(every).encode()).hexdigest(), every)
                    key, every = known[seen]
                    if key not in listed:
                        listed[key] = True
                        names = every
                rows.append((ids[i].as_py(), hashes[i].as_py(), len(words), longest,
                             [{"lo": lo, "hi": hi} for lo, hi in spans], key, names))
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])),
                     pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "h", "n_words", "longest", "spans", "met", "items"])
    return texts.mapInArrow(found, _FOUND)


def _united(spans: str) -> str:
    """SQL: the union of ascending spans as spans that are apart."""
    return f"""aggregate(array_sort({spans}), cast(array() as array<struct<lo:int,hi:int>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND element_at(acc, -1).hi >= x.lo
             THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('lo', element_at(acc, -1).lo, 'hi', greatest(element_at(acc, -1).hi, x.hi))))
             ELSE concat(acc, array(x)) END)"""


def find_leaks(docs: DataFrame, items: DataFrame, words: int = 10, block_words: int = BLOCK_WORDS, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, h (hash of the text), n_words, n_hit, spans
    (of hit words, numbered from 0, hi excluded), longest (words of the longest
    run that an item's part holds, 0 below the shortest window), n_items,
    items_sha256 (of the ids of the items met, sorted as strings and joined by
    commas), contaminated.

    A window is ``words`` consecutive words of an item, or all words of a
    shorter one. Null and empty texts have no words and meet nothing; items
    without words have no windows; an item without an id marks words but is
    neither counted nor listed, and rows with one item id are one item. Repeated
    rows, or rows with one id (or none) and different texts, are judged row by
    row. An empty table of documents gives no rows; without items nothing is
    hit. Other columns are ignored; a very long text is one row.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("text"))
    tests = items.select(items[item_col].cast("string").alias("item"), items[item_text_col].alias("text"))
    blocks = _blocks(tests, words, block_words)
    numbers = [r["block"] for r in blocks.select("block").orderBy("block").collect()]
    found = []
    for i, b in enumerate(numbers or [None]):
        row = blocks.where(F.col("block") == F.lit(b)).first() if b is not None else None
        shared = spark.sparkContext.broadcast(bytes(row["automaton"]) if row else Automaton([], words).packed())
        found.append(written(_stream(texts, shared, all_rows=i == 0), "leaks"))
        shared.destroy()
    drop(blocks)

    rows = found[0].select("doc_id", "h", "n_words", "longest", "spans", F.when(F.col("met").isNotNull(), F.array("met")).alias("met"))
    if len(found) > 1:
        # the other blocks' hits, by id and text: equal rows have equal hits
        later = found[1]
        for f in found[2:]:
            later = later.unionByName(f)
        hits = written(later.groupBy("doc_id", "h", "met").agg(F.max("longest").alias("longest"), F.first("spans").alias("spans"))
                       .groupBy("doc_id", "h").agg(F.max("longest").alias("more_longest"), F.flatten(F.collect_list("spans")).alias("more"),
                                                   F.array_sort(F.collect_set("met")).alias("more_met"))
                       .withColumnsRenamed({"doc_id": "hit_id", "h": "hit_h"}), "leaks-more")
        rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("h") == F.col("hit_h")), "left").select(
            "doc_id", "h", "n_words", F.greatest("longest", F.coalesce("more_longest", F.lit(0).cast("long"))).alias("longest"),
            F.expr(f"CASE WHEN more IS NULL THEN spans ELSE {_united('concat(spans, more)')} END").alias("spans"),
            F.expr("CASE WHEN more_met IS NULL THEN met WHEN met IS NULL THEN more_met ELSE array_sort(array_union(met, more_met)) END").alias("met"))

    rows = rows.withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.hi - s.lo)")) \
        .withColumn("combination", F.array_join("met", ","))
    if len(found) > 1:
        every = written(rows, "leaks-rows")
        drop(hits)
    else:
        every = rows
    # each set of items is listed by each task that met it, each combination digested once
    lists = found[0].select("met", "items")
    for f in found[1:]:
        lists = lists.unionByName(f.select("met", "items"))
    lists = lists.where("items IS NOT NULL").groupBy("met").agg(F.first("items").alias("items"))
    digests = written(
        every.where("met IS NOT NULL").select("combination", F.explode("met").alias("met")).distinct()
        .join(lists, "met").groupBy("combination").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select("combination", F.size("items").cast("long").alias("n_items"),
                F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")), "leaks-items")
    out = ["doc_id", "h", "n_words", "n_hit", "spans", "longest"]
    clean = every.where("met IS NULL").select(
        *out, F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256"))
    hit = every.where("met IS NOT NULL").join(checked_broadcast(digests), "combination").select(*out, "n_items", "items_sha256")
    return clean.unionByName(hit).withColumn("contaminated", F.col("n_hit") > 0)


def remove_leaks(docs: DataFrame, found: DataFrame, most_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns kept in order, with the hit words of ``found`` (see
    :func:`find_leaks`) taken from the texts.

    From a text goes all from the first to the last byte of each span. A row of
    whose words more than ``most_share`` are hit goes whole. Rows without hits,
    null and empty texts among them, stay as they are.
    """
    hits = found.where("n_hit > 0").select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"), "spans",
                                           (F.col("n_hit") > F.lit(most_share) * F.col("n_words")).alias("whole")) \
        .dropDuplicates(["hit_id", "hit_h"])
    at = docs.columns.index(text_col)
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = F.col(f"c{docs.columns.index(id_col)}").cast("long")
    joined = named.join(hits, key.eqNullSafe(F.col("hit_id")) & (F.xxhash64(f"c{at}") == F.col("hit_h")), "left") \
        .where("NOT coalesce(whole, false)").drop("hit_id", "hit_h", "whole")

    def cut(batches):
        import re
        for batch in batches:
            texts, spans = batch.column(at), batch.column("spans")
            if spans.null_count < len(spans):
                out = texts.to_pylist()
                for i, s in enumerate(spans):
                    if s.is_valid:
                        raw = out[i].encode()
                        word = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
                        lo = 0
                        parts = []
                        for span in s.as_py():
                            parts.append(raw[lo:word[span["lo"]][0]])
                            lo = word[span["hi"] - 1][1]
                        out[i] = b"".join([*parts, raw[lo:]]).decode()
                texts = pa.array(out, texts.type)
            cols = [texts if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    plain = ", ".join(f"`{c}` {t}" for c, t in named.dtypes)
    return joined.mapInArrow(cut, plain).toDF(*docs.columns)
