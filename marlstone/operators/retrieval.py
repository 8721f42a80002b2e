"""Document retrieval: search, hybrid scores, reranking, context, evaluation.

Scoring against the whole corpus goes through ``blocks.top_k``; everything after it works
on at most (questions x candidates) rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.embed import spaced_words, word_embedding, word_hash
from marlstone.functions.slices import listed as listed_udf
from marlstone.functions.text import found_patterns, overlap, share, word_set, words
from marlstone.operators import postings
from marlstone.operators.blocks import Scorer, top_k
from marlstone.operators.chunks import word_chunks
from marlstone.operators.vectors import vector_scorer
from marlstone.workspace import written

DIM = 64
#: Of a mixed score: one more than what halving a rounded score needs, so no value lies on a rounding edge.
MIX_DIGITS = 10


def ranked(df: DataFrame, score: str, ids: Sequence[str], k: int | None = None) -> DataFrame:
    """Rank within each question by score, ties by id; at most ``k`` rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), *ids)
    out = df.withColumn("rank", F.row_number().over(order))
    return out if k is None else out.where(F.col("rank") <= k)


# --- search ---------------------------------------------------------------------------


def ingest(documents: DataFrame, size: int, lap: int, dim: int = DIM, carry: Sequence[str] = ()) -> DataFrame:
    """Chunks with their embedding (doc_id, carry..., chunk_no, text, embedding, ...), to be stored once and searched many times."""
    cut = word_chunks(documents, "doc_id", "text", size, lap, carry=carry)
    return cut.withColumn("embedding", word_embedding(F.col("text"), dim))


def retrieve(chunks: DataFrame, questions: DataFrame, k: int, dim: int = DIM) -> DataFrame:
    """(query_id, doc_id, chunk_no, score, rank) by cosine with the stored embeddings; texts of chunks are not read."""
    corpus = chunks.select("doc_id", "chunk_no", "embedding")
    asked = questions.select("query_id", word_embedding(F.col("question"), dim).alias("query"))
    return top_k(corpus, ["doc_id", "chunk_no"], asked, "query_id", vector_scorer("cosine"), k)


def with_texts(results: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """Results with the text of their chunk and the question."""
    return results.join(chunks.select("doc_id", "chunk_no", "text"), ["doc_id", "chunk_no"]).join(questions, "query_id")


def source_lookup(results: DataFrame, documents: DataFrame, title: str, length: int = 100) -> DataFrame:
    """Results with ``title`` and a preview of their document, '' for a document that is not there."""
    preview = F.concat(F.substring("text", 1, length), F.lit("..."))
    sources = documents.select("doc_id", F.col(title).alias("title"), preview.alias("preview"))
    return results.join(sources, "doc_id", "left").na.fill("", ["title", "preview"])


class _Terms:
    """Words that questions ask for, and the questions of each as flat arrays."""

    def __init__(self, lists: Sequence[Sequence[str]], weights: Sequence[Sequence[float]]):
        asked: dict[str, list[tuple[int, float]]] = {}
        for i, (terms, values) in enumerate(zip(lists, weights, strict=True)):
            for t, w in zip(terms, values, strict=True):
                asked.setdefault(t, []).append((i, w))
        self.n_questions = len(lists)
        self.numbers = {t: n for n, t in enumerate(asked)}
        self.sizes = np.array([len(p) for p in asked.values()], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.questions = np.array([i for p in asked.values() for i, _ in p], dtype=np.int64)
        self.weights = np.array([w for p in asked.values() for _, w in p], dtype=float)

    def counts(self, texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, and (text, term, occurrences) of the asked words."""
        lists = [t.split() if t else [] for t in texts]
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        look = self.numbers.get
        found = np.array([look(w, -1) for x in lists for w in x], dtype=np.int64)
        rows = np.repeat(np.arange(len(lists)), lengths)
        pairs, n = np.unique(rows[found >= 0] * max(len(self.numbers), 1) + found[found >= 0], return_counts=True)
        return lengths, pairs // max(len(self.numbers), 1), pairs % max(len(self.numbers), 1), n

    def spread(self, n_texts: int, rows: np.ndarray, terms: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Matrix (texts x questions): for every (text, term) its part times the term's weight in each question that asks for it."""
        sizes = self.sizes[terms]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[terms], sizes)
        cells = np.repeat(rows, sizes) * self.n_questions + self.questions[at]
        return np.bincount(cells, weights=self.weights[at] * np.repeat(parts, sizes), minlength=n_texts * self.n_questions).reshape(n_texts, -1)


def hybrid_scorer(alpha: float, text: str = "text", vector: str = "embedding", words: str = "words", query: str = "query") -> Scorer:
    """alpha * cosine + (1 - alpha) * share of the distinct question words that occur in the text."""

    def prepare(asked: pd.DataFrame):
        by_vector = vector_scorer("cosine", vector, query)(asked)
        lists = [list(w) for w in asked[words]]
        terms = _Terms(lists, [[1 / max(len(w), 1)] * len(w) for w in lists])

        def score(rows: pd.DataFrame) -> np.ndarray:
            _, at, term, _ = terms.counts(rows[text])
            return alpha * by_vector(rows) + (1 - alpha) * terms.spread(len(rows), at, term, np.ones(len(at)))

        return score

    return prepare


def hybrid_search(corpus: DataFrame, ids: list[str], questions: DataFrame, alpha: float, k: int, dim: int = DIM) -> DataFrame:
    """Best k rows of ``corpus`` (ids, text, embedding) by the mix of cosine and word share."""
    texts = corpus.select(*ids, spaced_words(F.col("text")).alias("text"), "embedding")
    asked = questions.select("query_id", word_embedding(F.col("question"), dim).alias("query"), word_set(F.col("question")).alias("words"))
    return top_k(texts, ids, asked, "query_id", hybrid_scorer(alpha), k)


# --- BM25 -----------------------------------------------------------------------------


def bm25_scorer(k1: float, b: float) -> Scorer:
    def prepare(asked: pd.DataFrame):
        terms = _Terms([list(t) for t in asked["terms"]], [list(w) for w in asked["weights"]])
        mean_length = float(asked["mean_length"].iloc[0])

        def score(rows: pd.DataFrame) -> np.ndarray:
            lengths, at, term, n = terms.counts(rows["text"])
            flat = k1 * (1 - b + b * lengths / mean_length)
            return terms.spread(len(rows), at, term, n * (k1 + 1) / (n + flat[at]))

        return score

    return prepare


def bm25_search(corpus: DataFrame, ids: list[str], questions: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """Best k rows by BM25 over distinct question words, idf = ln(1 + (N - n + 0.5) / (n + 0.5)).

    One pass gives document frequencies, the number of texts and their mean length: words are counted before they
    meet the asked ones, so a frequent word is one row per task. A second pass scores; no word is joined to documents.
    """
    texts = corpus.select(*ids, spaced_words(F.col("text")).alias("text"))
    listed = F.when(F.coalesce("text", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("text", " "))
    # the term null stands for the text itself; length and terms are one value that the explode takes apart, or the text would be split for every term
    sized = F.transform(F.array(listed), lambda listed: F.struct(F.size(listed).alias("length"), F.concat(F.array_distinct(listed), F.array(F.lit(None).cast("string"))).alias("terms")))
    spread = texts.select(F.inline(sized)).select("length", F.explode("terms").alias("term"))
    counted = written(spread.groupBy("term").agg(F.count("*").alias("n"), F.sum("length").alias("length")), "terms")
    size = counted.where("term IS NULL").select(F.struct("n", (F.col("length") / F.col("n")).alias("mean"))).scalar()
    asked = questions.select("query_id", F.explode(word_set(F.col("question"))).alias("term"))
    n = F.coalesce(F.col("n"), F.lit(0))
    weighted = (
        asked.join(counted.where("term IS NOT NULL").select("term", "n"), "term", "left")
        .withColumn("weight", F.log(1 + (size["n"] - n + 0.5) / (n + 0.5)))
        .groupBy("query_id")
        .agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
        .withColumn("mean_length", size["mean"])
    )
    return top_k(texts, ids, weighted, "query_id", bm25_scorer(k1, b), k).where("score > 0")


def fuse_ranks(lists: Sequence[DataFrame], ids: Sequence[str], k: int, offset: int = 60) -> DataFrame:
    """Reciprocal rank fusion: sum of 1 / (offset + rank) over the lists."""
    every = lists[0].select("query_id", *ids, "rank")
    for other in lists[1:]:
        every = every.unionByName(other.select("query_id", *ids, "rank"))
    fused = every.groupBy("query_id", *ids).agg(F.round(F.sum(1 / (F.lit(offset) + F.col("rank"))), 10).alias("score"))
    return ranked(fused, "score", ids, k)


def hybrid_indexed(results: DataFrame, questions: DataFrame, index: postings.Index, alpha: float, k: int) -> DataFrame:
    """alpha * vector score + (1 - alpha) * occurrences of question words per question word, counted by the stored index; texts are not read."""
    ids = list(index.ids)
    asked = questions.select("query_id", words(F.col("question")).alias("_asked"))
    counted = asked.select("query_id", F.explode("_asked").alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    wanted = results.select("query_id", *ids).join(counted, "query_id")
    hits = postings.occurrences(index, wanted).groupBy("query_id", *ids).agg(F.sum(F.col("times") * F.col("n")).alias("_hits"))
    joined = results.join(hits, ["query_id", *ids], "left").join(asked.select("query_id", F.size("_asked").alias("_n")), "query_id")
    keyword = share(F.coalesce("_hits", F.lit(0)), F.col("_n"))
    return ranked(joined.withColumn("score", F.round(alpha * F.col("score") + (1 - alpha) * keyword, MIX_DIGITS)), "score", ids, k).drop("_hits", "_n")


# --- candidates rescored --------------------------------------------------------------
# These take results with ``text`` and ``question`` columns.


def hybrid_postings(results: DataFrame, alpha: float, ids: Sequence[str], k: int) -> DataFrame:
    """alpha * vector score + (1 - alpha) * occurrences of question words per question word.

    Keyword scores belong to the chunk they were counted in.
    """
    asked, held = words(F.col("question")), words(F.col("text"))
    hits = F.aggregate(asked, F.lit(0), lambda acc, w: acc + F.size(F.filter(held, lambda x: x == w)))
    keyword = share(hits, F.size(asked))
    return ranked(results.withColumn("score", F.round(alpha * F.col("score") + (1 - alpha) * keyword, MIX_DIGITS)), "score", ids, k)


def hybrid_substring(results: DataFrame, keyword_weight: float, ids: Sequence[str], k: int) -> DataFrame:
    """Mix with the share of question words found anywhere in the text; the weight is kept within [0, 1]."""
    weight = min(max(keyword_weight, 0.0), 1.0)
    asked, text = words(F.col("question")), F.lower("text")
    hits = F.size(F.filter(asked, lambda w: F.contains(text, w)))
    mixed = (1 - weight) * F.col("score") + weight * share(hits, F.size(asked))
    return ranked(results.withColumn("score", F.round(mixed, MIX_DIGITS)), "score", ids, k)


def rerank_boosted(results: DataFrame, keywords: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Score x 1.5 for the whole question as a phrase, x 1.2 per keyword, x (1 + 0.1 x common words)."""
    phrase = F.when(F.contains(F.lower("text"), F.lower("question")), 1.5).otherwise(1.0)
    named = F.size(found_patterns(F.col("text"), keywords)) if keywords else F.lit(0)
    common = overlap(word_set(F.col("question")), word_set(F.col("text")))
    boosted = F.col("score") * phrase * F.power(F.lit(1.2), named) * (1 + common * 0.1)
    return ranked(results.withColumn("score", F.round(boosted, MIX_DIGITS)), "score", ids)


def rerank_overlap(results: DataFrame, ids: Sequence[str], k: int) -> DataFrame:
    """Half the vector score, half the share of question words in the text."""
    asked = word_set(F.col("question"))
    common = share(overlap(asked, word_set(F.col("text"))), F.size(asked))
    return ranked(results.withColumn("score", F.round(F.col("score") * 0.5 + common * 0.5, MIX_DIGITS)), "score", ids, k)


# --- context --------------------------------------------------------------------------


def assemble(results: DataFrame, min_score: float, separator: str = "\n\n", bullet: str = "") -> DataFrame:
    """(query_id, context, n_sources): texts of results with at least ``min_score``, in rank order."""
    kept = results.where(F.col("score") >= min_score)
    listed = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return kept.groupBy("query_id").agg(
        F.array_join(F.transform(listed, lambda r: F.concat(F.lit(bullet), r["text"])), separator).alias("context"),
        F.count("*").alias("n_sources"),
    )


def within_budget(results: DataFrame, tokens: Column, budget: int) -> DataFrame:
    """Results in rank order while the running number of tokens stays within the budget."""
    upto = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    spent = results.withColumn("tokens", tokens).withColumn("tokens_so_far", F.sum("tokens").over(upto))
    return spent.where(F.col("tokens_so_far") <= budget)


def answer_questions(
    chunks: DataFrame, questions: DataFrame, blocked: Sequence[str], max_length: int, k: int, titles: DataFrame
) -> DataFrame:
    """One row per question: blocked or not and why, context, sources (doc_id, title, preview, score).

    Guard, search of the stored chunks, rerank of 2k candidates, context from the best k, source titles joined by document.
    ``titles`` is (doc_id, title).
    """
    hits = found_patterns(F.col("question"), blocked)
    reason = F.when(F.length("question") > max_length, F.concat(F.lit("Input too long: "), F.length("question").cast("string"))).when(
        F.size(hits) > 0, F.concat(F.lit("Blocked pattern: "), F.get(hits, F.lit(0)))
    )
    guarded = questions.withColumn("reason", reason)
    passed = guarded.where("reason IS NULL").select("query_id", "question")
    found = written(retrieve(chunks, passed, 2 * k), "candidates")
    best = written(rerank_overlap(with_texts(found, chunks, passed), ["doc_id", "chunk_no"], k), "best")
    context = assemble(best, 0.0)
    preview = F.concat(F.substring("text", 1, 100), F.lit("..."))
    source = F.struct("rank", "doc_id", F.coalesce("title", F.lit("")).alias("title"), preview.alias("preview"), "score")
    sources = best.join(titles, "doc_id", "left").groupBy("query_id").agg(F.array_sort(F.collect_list(source)).alias("sources"))
    return (
        guarded.join(context, "query_id", "left")
        .join(sources, "query_id", "left")
        .withColumn("blocked", F.col("reason").isNotNull())
    )


# --- evaluation -----------------------------------------------------------------------


def precision_recall(results: DataFrame, relevant: DataFrame, item: str) -> DataFrame:
    """(query_id, precision, recall, f1) from (query_id, item) pairs on both sides, 0 on empty denominators.

    Works on pairs, not on id lists: a relevant set may be of any size.
    """
    hits = results.select("query_id", item).join(relevant.select("query_id", item), ["query_id", item], "left_semi")
    counted = (
        results.groupBy("query_id")
        .agg(F.count("*").alias("_found"))
        .join(relevant.groupBy("query_id").agg(F.count("*").alias("_wanted")), "query_id", "left")
        .join(hits.groupBy("query_id").agg(F.count("*").alias("_hits")), "query_id", "left")
        .na.fill(0, ["_wanted", "_hits"])
    )
    precision = share(F.col("_hits"), F.col("_found"))
    recall = share(F.col("_hits"), F.col("_wanted"))
    f1 = F.when(F.col("_hits") > 0, 2 * precision * recall / F.nullif(precision + recall, F.lit(0.0))).otherwise(F.lit(0.0))
    return counted.select("query_id", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def rank_quality(results: DataFrame, relevant: DataFrame, item: str, cutoff: int = 10) -> DataFrame:
    """One row: MRR and mean recall at the cutoff over all questions that have results."""
    top = results.where(F.col("rank") <= cutoff)
    hits = top.join(relevant.select("query_id", item), ["query_id", item], "left_semi")
    per_query = (
        top.select("query_id")
        .distinct()
        .join(hits.groupBy("query_id").agg(F.min("rank").alias("_first"), F.count("*").alias("_hits")), "query_id", "left")
        .join(relevant.groupBy("query_id").agg(F.count("*").alias("_wanted")), "query_id", "left")
    )
    return per_query.agg(
        F.avg(F.coalesce(1 / F.col("_first"), F.lit(0.0))).alias("mrr"),
        F.avg(F.coalesce(F.col("_hits") / F.col("_wanted"), F.lit(0.0))).alias("recall"),
    )


def word_share(asked: Column, held: Column) -> Column:
    """Share of the distinct words of ``asked`` that occur in ``held``."""
    return share(overlap(word_set(asked), word_set(held)), F.size(word_set(asked)))


def keyword_coverage(text: Column, keywords: Sequence[str]) -> Column:
    return F.size(found_patterns(text, keywords)) / len(keywords)


# fixed values: parts of the response quality score
NO_SOURCE_RELEVANCE = 0.5
GROUNDED = 0.85
UNGROUNDED = 0.6
COHERENCE = 0.9


def response_quality(results: DataFrame, questions: DataFrame, threshold: float) -> DataFrame:
    """Relevance, groundedness, coherence, their mean and a status per question."""
    sources = results.groupBy("query_id").agg(F.avg("score").alias("_mean"), F.count("*").alias("_n"))
    scored = questions.select("query_id").join(sources, "query_id", "left")
    relevance = F.coalesce("_mean", F.lit(NO_SOURCE_RELEVANCE))
    grounded = F.when(F.coalesce("_n", F.lit(0)) >= 2, GROUNDED).otherwise(UNGROUNDED)
    return (
        scored.withColumns({"relevance": relevance, "groundedness": grounded, "coherence": F.lit(COHERENCE)})
        .withColumn("overall", (F.col("relevance") + F.col("groundedness") + F.col("coherence")) / 3)
        .withColumn("status", F.when(F.col("overall") >= threshold, "Success").otherwise("LowQuality"))
        .drop("_mean", "_n")
    )


# --- semantic chunks ------------------------------------------------------------------


def _joined(sentences: list[str], threshold: float, dim: int) -> list[str]:
    if len(sentences) == 0:
        return []
    vectors = word_hash([" ".join(s.lower().split()) for s in sentences], dim)
    near = np.round((vectors[1:] * vectors[:-1]).sum(axis=1), 8)
    chunks, held = [], [sentences[0]]
    for s, c in zip(sentences[1:], near, strict=True):
        if c < threshold or math.isnan(c):
            chunks.append(" ".join(held))
            held = []
        held.append(s)
    return [*chunks, " ".join(held)]


def semantic_breaks(lists: pd.Series, threshold: float, dim: int) -> pd.Series:
    """Sentences of each text joined while neighbours have a cosine of at least ``threshold``."""

    return pd.Series([_joined(list(s), threshold, dim) for s in lists], dtype=object)


def semantic_chunks(df: DataFrame, doc_id: str, listed: Column, threshold: float, dim: int = DIM) -> DataFrame:
    """(doc_id, chunk_no, text): a new chunk starts where neighbouring sentences differ."""

    def cut(sentences: list[str] | None) -> list[str]:
        return _joined(sentences or [], threshold, dim)

    return df.select(doc_id, F.posexplode(listed_udf(cut, T.ArrayType(T.StringType()))(listed)).alias("chunk_no", "text"))
