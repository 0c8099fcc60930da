"""Quality rules as a learned decision list.

Statistics of whole texts are computed in one pass. Sequential covering then
learns, from labelled documents' statistics, an ordered list of rules that
reject: each rule is a conjunction of thresholds, grown on two thirds of the
sample by information gain and pruned on the rest; what it covers is taken
out, and the next rule is learned, until no rule keeps its precision on the
held-out part. The list becomes one Spark CASE expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hirelens.llm.common import range_hashes, run_hashes, start_task, steps, text_bytes, word_spans, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_stops", "n_capital_words", "n_long_words")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray, row: np.ndarray, count_first: bool) -> np.ndarray:
    """Whether (row, key) occurs more than once: every time, or all but the
    first time in order."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    out = np.zeros(len(k), bool)
    if count_first:
        again = same.copy()
        again[:-1] |= same[1:]
        out[order] = again
    else:
        out[order] = same
    return out


def stats_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS per row, over whole texts.

    word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``;
    n_dup_lines: lines with a word that equal an earlier line; n_repeat_words:
    words inside three-word windows that the text has twice or more, the
    first included.
    """
    rows = len(offsets) - 1
    out = {}
    start, end, row = word_spans(data, offsets)
    out["n_words"] = np.bincount(row, minlength=rows)
    lead = (data & 0xC0) != 0x80
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    length = chars[end] - chars[start]
    out["word_chars"] = np.bincount(row, length, minlength=rows).astype(np.int64)
    out["n_symbols"] = _per_row(_SYMBOL[data], offsets)
    upper = (data >= 65) & (data <= 90)
    out["n_upper"] = _per_row(upper, offsets)
    out["n_digits"] = _per_row((data >= 48) & (data <= 57), offsets)
    out["n_stops"] = _per_row(_STOP[data], offsets)
    out["n_capital_words"] = np.bincount(row[upper[start]], minlength=rows) if len(start) else np.zeros(rows, np.int64)
    out["n_long_words"] = np.bincount(row[length > 20], minlength=rows)

    # lines: cut at \n and at the ends of texts
    breaks = np.flatnonzero(data == 10)
    texts = offsets[:-1][np.diff(offsets) > 0]
    begin = np.unique(np.concatenate([texts, breaks + 1]))
    begin = begin[begin < len(data)]
    stop = np.append(begin[1:], len(data))
    stop = stop - ((stop > begin) & (data[stop - 1] == 10)) if len(begin) else stop
    has = np.zeros(len(data) + 1, np.int64)
    inside = np.zeros(len(data) + 1, np.int64)
    inside[start] += 1
    np.cumsum(inside[:-1], out=has[1:])
    # a word that began before the line cannot reach into it, so words start in their line
    worded = has[stop] > has[begin]
    begin, stop = begin[worded], stop[worded]
    line_row = np.searchsorted(offsets, begin, side="right") - 1
    out["n_lines"] = np.bincount(line_row, minlength=rows)
    again = _repeated(range_hashes(data, begin, stop), line_row, count_first=False) if len(begin) else np.zeros(0, bool)
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=rows)

    if len(start) >= 3:
        trio = run_hashes(range_hashes(data, start, end), 3)
        whole = row[2:] == row[:-2]
        hit = np.zeros(len(trio), bool)
        at = np.flatnonzero(whole)
        hit[at] = _repeated(trio[at], row[at], count_first=True)
        covered = np.zeros(len(start), bool)
        for k in range(3):
            covered[k:len(hit) + k] |= hit
        out["n_repeat_words"] = np.bincount(row[covered], minlength=rows)
    else:
        out["n_repeat_words"] = np.zeros(rows, np.int64)
    return out


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` as c0, c1, ... and COUNTS, in one pass without a
    shuffle; a null or empty text has zeros."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_task("hash")
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            parts = [stats_of(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                     for lo, hi in steps(offsets)]
            cols = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64))
                    for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols],
                                             names=[*(f"c{i}" for i in range(batch.num_columns)), *COUNTS])

    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = StructType([*named.schema.fields, *(StructField(c, LongType()) for c in COUNTS)])
    return named.mapInArrow(run, schema)


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, COUNTS) per row."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return with_stats(rows).withColumnRenamed("c0", "id").drop("c1")


# --------------------------------------------------------------- features

#: name -> (numerator, denominator or None); a ratio to nothing is 0
FEATURES = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeat_words_per_word": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "stops_per_word": ("n_stops", "n_words"),
    "capital_words_per_word": ("n_capital_words", "n_words"),
    "long_words_per_word": ("n_long_words", "n_words"),
}


def feature(name: str) -> Column:
    top, below = FEATURES[name]
    value = F.col(top).cast("double")
    return value if below is None else F.when(F.col(below) > 0, value / F.col(below)).otherwise(F.lit(0.0))


@dataclass
class Rule:
    """Rejects where every condition (feature, '<=' or '>', threshold) holds."""
    conditions: list[tuple[str, str, float]] = field(default_factory=list)
    covered: int = 0
    wrong: int = 0

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.conditions:
            out = out & ((feature(name) <= at) if op == "<=" else (feature(name) > at))
        return out

    def __str__(self) -> str:
        said = " and ".join(f"{n} {op} {at:.6g}" for n, op, at in self.conditions)
        return f"if {said}: reject ({self.covered} covered, {self.wrong} wrongly)"


def verdict(rules: list[Rule]) -> Column:
    """True (keep) unless a rule of the ordered list rejects."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def rule_number(rules: list[Rule]) -> Column:
    """The place of the rule that rejects, null if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule.column(), F.lit(i)) if out is None else out.when(rule.column(), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


# ---------------------------------------------------------------- learning

def _gain(p0: float, n0: float, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FOIL's information gain of narrowing (p0, n0) to (p, n)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], most: int, barred=frozenset()) -> list[tuple[str, str, float]]:
    """Conditions of most gain one after another; the first is none of
    ``barred`` (feature, side)."""
    conditions, inside = [], np.ones(len(y), bool)
    while len(conditions) < most and (~y[inside]).any() and y[inside].any():
        p0, n0 = y[inside].sum(), (~y[inside]).sum()
        best = (1e-9, None)
        for j, name in enumerate(names):
            v = x[inside, j]
            order = np.argsort(v, kind="stable")
            s, t = v[order], y[inside][order]
            p, n = np.cumsum(t), np.cumsum(~t)
            cut = np.flatnonzero(s[1:] > s[:-1])
            if not len(cut):
                continue
            low, high = _gain(p0, n0, p[cut], n[cut]), _gain(p0, n0, p0 - p[cut], n0 - n[cut])
            for gains, op in ((low, "<="), (high, ">")):
                if not conditions and (name, op) in barred:
                    continue
                k = int(np.argmax(gains))
                if gains[k] > best[0]:
                    at = (s[cut[k]] + s[cut[k] + 1]) / 2
                    best = (gains[k], (name, op, float(at if s[cut[k]] < at < s[cut[k] + 1] else s[cut[k]])))
        if best[1] is None:
            break
        conditions.append(best[1])
        inside &= _holds(x, names, [best[1]])
    return conditions


def _holds(x: np.ndarray, names: list[str], conditions) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, at in conditions:
        v = x[:, names.index(name)]
        out &= (v <= at) if op == "<=" else (v > at)
    return out


def _prune(x: np.ndarray, y: np.ndarray, names: list[str], conditions):
    """The conditions without those, one after another, whose removal does not
    lower (p - n) / (p + n) on held-out rows."""
    def worth(cs):
        hit = _holds(x, names, cs)
        p, n = y[hit].sum(), (~y[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best, now = worth(conditions), list(conditions)
    while len(now) > 1:
        score, drop = max((worth(now[:i] + now[i + 1:]), i) for i in range(len(now)))
        if score < best:
            break
        best, now = score, now[:drop] + now[drop + 1:]
    return now


def _attempts(x: np.ndarray, y: np.ndarray, g: np.ndarray, h: np.ndarray, names: list[str], most: int):
    """Condition sets to try in turn: the rule as grown and pruned, as grown;
    then the same without the first test of the ones before, so that another
    feature or side leads; then with one more condition."""
    barred: set[tuple[str, str]] = set()
    for longer in (0, 2):
        barred.clear()
        for _ in range(2 * len(names)):
            grown = _grow(x[g], y[g], names, most + longer, barred)
            if not grown:
                break
            pruned = _prune(x[h], y[h], names, grown)
            yield pruned
            if len(pruned) < len(grown):
                yield grown
            barred.add(grown[0][:2])


def learn_rules(x: np.ndarray, y: np.ndarray, names: list[str], precision: float = 0.98, most_rules: int = 12,
                most_conditions: int = 4, least_covered: int = 10) -> list[Rule]:
    """Sequential covering. ``y``: True where the row should be rejected. Rows
    are dealt in turn, two to growing and one to pruning. A rule counts only
    if its precision on all rows still uncovered, and on the held-out ones, is
    at least ``precision`` and it covers ``least_covered`` rows (an eightieth
    of a sample of less than 800, five at least). Where the first rule grown
    misses that, others are tried (see ``_attempts``); the list ends when none
    is good enough."""
    rules: list[Rule] = []
    least = min(least_covered, max(5, len(y) // 80))
    held = np.arange(len(y)) % 3 == 2
    left = np.ones(len(y), bool)
    while len(rules) < most_rules and y[left].sum() >= least:
        g, h = left & ~held, left & held
        for conditions in _attempts(x, y, g, h, names, most_conditions):
            hit = _holds(x, names, conditions)
            p, n = int((hit & left & y).sum()), int((hit & left & ~y).sum())
            ph, nh = int((hit & h & y).sum()), int((hit & h & ~y).sum())
            if p >= least and p >= precision * (p + n) and ph >= precision * (ph + nh) and (ph or least_covered > least):
                rules.append(Rule(conditions, p + n, n))
                left &= ~hit
                break
        else:
            break
    return rules


def labelled_sample(labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, quality) of at most ``sample`` labelled documents, those with
    the smallest hash of their id, so that every run on the same data learns
    the same list. Null ids and labels are left out; an id labelled in two
    ways counts as labelled by the smaller."""
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return written(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-labels")


def fit(stats: DataFrame, marks: DataFrame, **options) -> list[Rule]:
    """Rules from a bounded sample of labelled documents (``marks``: doc_id,
    quality; 0: reject) and their ``stats`` (id, COUNTS). Without labels of
    both kinds there are no rules."""
    rows = stats.join(F.broadcast(marks), stats["id"] == marks["doc_id"])  # a bounded sample of two numbers a row
    names = list(FEATURES)
    got = rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", *[feature(f).alias(f) for f in names]) \
        .dropDuplicates(["doc_id"]).toPandas().sort_values(["h", "doc_id"])
    y = got["quality"].to_numpy() == 0
    if not len(y) or y.all() or not y.any():
        return []
    return learn_rules(got[names].to_numpy(float), y, names, **options)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """Per row: id, COUNTS, base_failed, rule (number of the rejecting rule or
    null), kept. Nulls and empty texts have zeros and fail the base. An empty
    table gives no rows; repeated rows are judged alike; other columns are
    ignored."""
    stats = written(text_stats(docs, id_col, text_col), "quality-stats")
    rules = fit(stats, labelled_sample(labels, sample), **options)
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(~F.col("base_failed"), rule_number(rules)))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that the base or the learned list rejects;
    columns and their order stay. One pass over the texts besides that over
    the labelled ones, and no shuffle of texts."""
    marks = labelled_sample(labels, sample)
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    learned = own.join(F.broadcast(marks.select(F.col("doc_id").alias("id"))), "id", "left_semi")
    rules = fit(written(text_stats(learned, "id"), "quality-sample"), marks, **options)
    judged = with_stats(docs, text_col).where(~base_failed() & verdict(rules))
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
