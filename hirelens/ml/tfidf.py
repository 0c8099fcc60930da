"""TF-IDF over skill text (ML-8) and the Gram matrix of small vocabularies
(ML-9; see ``svd`` for the decomposition).

A document is one row with its terms in an array; term counts, weights and
norm are computed inside the row, and only document frequencies are shuffled.
The Gram matrix is accumulated per partition into a dense block (numpy inside
``mapInArrow``) and the blocks are summed by a grouped aggregate; no (term,
term) pairs are emitted per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.operators.crawl import global_sequence

#: terms up to which the vocabulary travels to the tasks (about 60 bytes each),
#: and columns of a dense Gram block (k x k doubles per task)
VOCABULARY_IN_TASKS = 20_000
GRAM_COLUMNS = 2_000
#: pairs of terms that a task looks at together
GRAM_PAIRS = 1 << 20
TOKEN = r"[\p{L}\p{N}_]{2,}"


def skill_text(df: DataFrame) -> DataFrame:
    """Tags as space-separated text; no tags -> 无."""
    from hirelens.functions.text import split_tags
    tags = F.when(F.col("skill_tags").isNull() | (F.col("skill_tags") == "nan"), F.array().cast("array<string>")) \
            .otherwise(split_tags("skill_tags"))
    return df.select("seq", F.when(F.size(tags) > 0, F.array_join(tags, " ")).otherwise(F.lit("无")).alias("text"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(seq, tf): lower-cased tokens of >= 2 word characters, 1- and 2-grams,
    as an array of (term, n) in the row, in order of first appearance. Tokens
    are cut by Spark; whole batches of them are paired and counted at once."""
    def count(batches):
        for batch in batches:
            t = batch.column("t")
            size = pc.list_value_length(t).fill_null(0).to_numpy()
            coded = t.flatten().dictionary_encode()
            words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            pair = row[1:] == row[:-1]
            two, which = np.unique(code[:-1][pair] * len(words) + code[1:][pair], return_inverse=True)
            one = max(len(words), 1)
            joined = pc.binary_join_element_wise(words.take(pa.array(two // one)), words.take(pa.array(two % one)), " ")
            terms = pa.concat_arrays([words, joined])
            row, gram = np.concatenate([row, row[:-1][pair]]), np.concatenate([code, len(words) + which])
            order = np.argsort(row, kind="stable")  # a row's words, then its pairs
            key, first, n = np.unique((row * max(len(terms), 1) + gram)[order], return_index=True, return_counts=True)
            seen = np.argsort(first)
            at = order[first[seen]]
            ends = np.append(0, np.cumsum(np.bincount(row[at], minlength=len(size)))).astype(np.int32)
            each = pa.StructArray.from_arrays([terms.take(pa.array(gram[at])), pa.array(n[seen].astype(np.int32))], names=["term", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq"), pa.ListArray.from_arrays(pa.array(ends), each, mask=t.is_null() if t.null_count else None)], names=["seq", "tf"])

    toks = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), 0)
    return docs.select("seq", toks.alias("t")).mapInArrow(
        count, f"seq {docs.schema['seq'].dataType.simpleString()}, tf array<struct<term: string, n: int>>")


def vocabulary(tf: DataFrame, n_docs, max_features: int | None = None) -> DataFrame:
    """(term, df, idx): terms with min_df 2 and max_df 0.8 (share of docs), in
    order of corpus count (ties by term); all of them, or the first
    ``max_features``."""
    each = tf.select(F.explode("tf").alias("t")).select("t.term", "t.n")
    by_term = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("cf"))
    kept = by_term.where((F.col("df") >= dims.TFIDF_MIN_DF) & (F.col("df") <= F.lit(dims.TFIDF_MAX_DF) * n_docs))
    if max_features is not None:
        kept = kept.orderBy(F.desc("cf"), "term").limit(max_features)
    # numbered by ranges: the terms are never in one task
    numbered = global_sequence(kept.withColumn("_less", -F.col("cf")), ["_less", "term"], "idx")
    return numbered.withColumn("idx", F.col("idx") - 1).drop("_less")


def tfidf(docs: DataFrame, max_features: int | None = None) -> DataFrame:
    """(seq, ii, ww): indices and weights of each document's known terms;
    sublinear tf x smooth idf, L2-normalized. A document is one row all along;
    only document frequencies are shuffled. The vocabulary reaches the rows as
    an array in the tasks if it is small, else by a join per term."""
    from hirelens.session import materialize
    tf = materialize(term_counts(docs), "term-counts")
    n = tf.count()
    vocab = materialize(vocabulary(tf, n, max_features).select(
        "term", "idx", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf")), "vocabulary")
    if vocab.limit(VOCABULARY_IN_TASKS + 1).count() <= VOCABULARY_IN_TASKS:
        return _weighed(tf, vocab)
    rows = (tf.select("seq", F.explode("tf").alias("t")).join(vocab, F.col("t.term") == F.col("term"))
            .groupBy("seq").agg(F.collect_list(F.struct(F.col("t.n").alias("n"), F.struct("idx", "idf").alias("v"))).alias("k")))
    raw = F.transform("k", lambda t: (1 + F.log(t["n"])) * t["v"]["idf"])
    rows = rows.where(F.size("k") > 0).select("seq", F.transform("k", lambda t: t["v"]["idx"]).alias("ii"), raw.alias("w"))
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("norm", norm).select("seq", "ii", F.transform("w", lambda x: x / F.col("norm")).alias("ww"))


def _weighed(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """(seq, ii, ww) by a vocabulary that travels to the tasks, where the terms
    of a batch are looked up at once (a map's keys are walked through for each
    term)."""
    known = vocab.toArrow().combine_chunks()
    words, idx, idf = known["term"].combine_chunks(), known["idx"].to_numpy(), known["idf"].to_numpy()

    def weigh(batches):
        for batch in batches:
            t = batch.column("tf")
            size = pc.list_value_length(t).fill_null(0).to_numpy()
            term, n = t.flatten().flatten()
            at = pc.index_in(term, value_set=words)
            ok = at.is_valid().to_numpy(zero_copy_only=False)
            row, at = np.repeat(np.arange(len(size)), size)[ok], at.drop_null().to_numpy()
            w = (1 + np.log(n.to_numpy()[ok])) * idf[at]
            w /= np.sqrt(np.bincount(row, w * w, minlength=len(size)))[row]
            count = np.bincount(row, minlength=len(size))
            ends = pa.array(np.append(0, np.cumsum(count[count > 0])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq").filter(pa.array(count > 0)), pa.ListArray.from_arrays(ends, pa.array(idx[at])),
                 pa.ListArray.from_arrays(ends, pa.array(w))], names=["seq", "ii", "ww"])

    kinds = {c: d.dataType.simpleString() for c, d in (("seq", tf.schema["seq"]), ("idx", vocab.schema["idx"]))}
    return tf.mapInArrow(weigh, f"seq {kinds['seq']}, ii array<{kinds['idx']}>, ww array<double>")


def weight_rows(weights: DataFrame) -> DataFrame:
    """(seq, idx, weight) of each document's terms."""
    return weights.select("seq", F.explode(F.arrays_zip("ii", "ww")).alias("z")).select("seq", F.col("z.ii").alias("idx"), F.col("z.ww").alias("weight"))


def gram(weights: DataFrame, k: int) -> DataFrame:
    """XᵀX of the doc x term weight matrix as (i, j, g) for i <= j.

    Each document's pairs of terms are added up into a block of ``k`` columns
    per task, documents of equal length together; the tasks' blocks are summed
    by a grouped aggregate. A dense k x k block has a bound, so a larger
    vocabulary needs ``max_features`` and is an error here."""
    if k > GRAM_COLUMNS:
        raise ValueError(f"{k} terms: give max_features of at most {GRAM_COLUMNS}")

    def block(batches):
        g = np.zeros(k * k)
        for batch in batches:
            ii, ww = batch.column("ii"), batch.column("ww")
            size = pc.list_value_length(ii).fill_null(0).to_numpy()
            terms, vals = ii.flatten().to_numpy().astype(np.int64), ww.flatten().to_numpy()
            start = np.cumsum(size) - size
            for m in np.unique(size[size > 0]):
                same = start[size == m]
                step = max(1, GRAM_PAIRS // int(m * m))
                for lo in range(0, len(same), step):
                    at = same[lo:lo + step, None] + np.arange(m)
                    i, w = terms[at], vals[at]
                    pair = (i[:, :, None] * k + i[:, None, :]).ravel()
                    times = (w[:, :, None] * w[:, None, :]).ravel()
                    if len(pair) * 8 > len(g):
                        g += np.bincount(pair, times, minlength=len(g))
                    else:  # fewer pairs than the block has numbers
                        np.add.at(g, pair, times)
        g = np.triu(g.reshape(k, k))
        i, j = np.nonzero(g)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(g[i, j])], names=["i", "j", "g"])

    parts = weights.select("ii", "ww").mapInArrow(block, "i long, j long, g double")
    return parts.groupBy("i", "j").agg(F.sum("g").alias("g"))


def svd_components(g_rows, k: int, dim: int = dims.SVD_DIM):
    """(components, squared singular values, share of the total they explain)
    of X from its (small) Gram matrix."""
    g = np.zeros((k, k))
    for r in g_rows:
        g[r["i"], r["j"]] = r["g"]
        g[r["j"], r["i"]] = r["g"]
    vals, vecs = np.linalg.eigh(g)
    order = np.argsort(vals)[::-1][:dim]
    return vecs[:, order], vals[order], vals[order] / max(vals.sum(), 1e-300)
