"""Chunking, retrieval, context assembly and retrieval metrics.

Corpus: all documents in full. Questions: all benchmark texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.functions.embed import word_embedding
from marlstone.operators import blocks, chunks, postings, vectors
from marlstone.operators import retrieval as re
from marlstone.plans.registry import query, table
from marlstone.plans.relational import CENTROIDS_SQL
from marlstone.plans.vectors import word_hash_sql
from marlstone.sources.logs import CHAT_PAIRS_SQL, chat_pairs
from marlstone.workspace import scratch, state_of, stored, written

SIZE, LAP = 200, 50
IDS = ["doc_id", "chunk_no"]
WORDS_SQL = r"list_filter(string_split_regex({0}, '\s+'), lambda w: w <> '')"


def _words(column: str) -> str:
    return WORDS_SQL.format(column)


def _set(column: str) -> str:
    return f"list_distinct({_words(f'lower({column})')})"


def chunk_sql(size: int = SIZE, lap: int = LAP, source: str = "documents") -> str:
    step = size - lap
    return f"""cw AS (SELECT doc_id, {_words("text")} AS ws FROM {source}),
  chunks AS (SELECT doc_id, CAST(k AS INTEGER) AS chunk_no, CAST(k * {step} AS INTEGER) AS first_word,
    ws[k * {step} + 1 : k * {step} + {size}] AS cws, array_to_string(ws[k * {step} + 1 : k * {step} + {size}], ' ') AS text
    FROM (SELECT doc_id, ws, unnest(range(0, CAST(greatest(ceil((len(ws) - {size}) / {step}), 0) AS BIGINT) + 1)) AS k FROM cw WHERE len(ws) > 0))"""


QUESTIONS_SQL = "questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)"


def retrieve_sql(k: int) -> str:
    """CTE found (query_id, doc_id, chunk_no, score, rank, text, question)."""
    return f"""{QUESTIONS_SQL}, {chunk_sql()}, {word_hash_sql("ce", "chunks", "doc_id, chunk_no")}, {word_hash_sql("qe", "questions", "query_id", "question")},
  dots AS (SELECT query_id, doc_id, chunk_no, round(sum(ce.weight * qe.weight), 8) AS score FROM ce JOIN qe USING (slot) GROUP BY ALL),
  best AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_no) AS INTEGER) AS rank FROM dots QUALIFY rank <= {k}),
  found AS (SELECT best.*, chunks.text, questions.question FROM best JOIN chunks USING (doc_id, chunk_no) JOIN questions USING (query_id))"""


def _rerank_sql(score: str, k: int | None) -> str:
    """Select (query_id, doc_id, chunk_no, score, rank) of found under a new score."""
    cut = "" if k is None else f"QUALIFY rank <= {k}"
    return f"""SELECT query_id, doc_id, chunk_no, s AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id, chunk_no) AS INTEGER) AS rank
    FROM (SELECT query_id, doc_id, chunk_no, round({score}, 10) AS s FROM found) {cut}"""


def documents_of(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def questions_of(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _stored(spark, folder, kind, make):
    """The path of what is built once from the documents as they are now; it is built again when their files change."""
    path = f"{folder}/documents.parquet"
    return stored(spark, (kind, path, state_of(spark, path)), kind, make)


def chunk_store(spark, folder):
    """Chunks of all documents with their embeddings."""
    return spark.read.parquet(_stored(spark, folder, "chunks", lambda path: re.ingest(documents_of(spark, folder), SIZE, LAP).write.parquet(path)))


def document_store(spark, folder):
    """Whole documents with their embeddings."""
    return spark.read.parquet(
        _stored(spark, folder, "vectors", lambda path: documents_of(spark, folder).withColumn("embedding", word_embedding(F.col("text"), re.DIM)).write.parquet(path))
    )


def document_index(spark, folder):
    """Inverted index of whole documents."""
    return postings.Index.read(spark, _stored(spark, folder, "index", lambda path: postings.build(documents_of(spark, folder), ["doc_id"], "text", path)))


def chunk_index(spark, folder):
    """Inverted index of the stored chunks."""
    return postings.Index.read(spark, _stored(spark, folder, "chunk_index", lambda path: postings.build(chunk_store(spark, folder), IDS, "text", path)))


def _found(spark, folder, k):
    chunks, questions = chunk_store(spark, folder), questions_of(spark, folder)
    # read back once scored: later steps use the few result rows several times
    return re.with_texts(written(re.retrieve(chunks, questions, k), "results"), chunks, questions)


def _result(df):
    return df.select("query_id", "doc_id", "chunk_no", "score", "rank")


@query(
    "join_09_source_lookup",
    f"""WITH {retrieve_sql(3)} SELECT query_id, found.rank, doc_id, chunk_no, coalesce(d.source, '') AS title,
    coalesce(substring(d.text, 1, 100) || '...', '') AS preview FROM found LEFT JOIN documents d USING (doc_id)""",
)
def source_lookup(spark, folder):
    """Title and preview of the documents that retrieved chunks come from."""
    found = written(re.retrieve(chunk_store(spark, folder), questions_of(spark, folder), 3), "results")
    return re.source_lookup(found.drop("score"), table(spark, folder, "documents"), "source")


@query(
    "ret_01_word_chunks",
    f"""WITH {chunk_sql()} SELECT doc_id, chunk_no, doc_id || '-chunk-' || chunk_no AS chunk_id, first_word,
    CAST(len(cws) AS INTEGER) AS n_words, text FROM chunks""",
)
def word_chunks(spark, folder):
    return chunks.word_chunks(documents_of(spark, folder), "doc_id", "text", SIZE, LAP)


@query(
    "ret_02_char_chunks",
    """SELECT doc_id, CAST(k AS INTEGER) AS chunk_no, k * 400 AS start_char, least(k * 400 + 500, n) AS end_char, substring(text, k * 400 + 1, 500) AS text
    FROM (SELECT doc_id, text, length(text) AS n, unnest(range(0, CAST(greatest(ceil((length(text) - 500) / 400), 0) AS BIGINT) + 1)) AS k
          FROM documents WHERE length(text) > 0)""",
)
def char_chunks(spark, folder):
    return chunks.char_chunks(documents_of(spark, folder), "doc_id", "text", 500, 100)


_PACKED_SQL = r"""WITH RECURSIVE p AS (SELECT doc_id, string_split(text, chr(10)) AS ps FROM documents),
  f AS (SELECT doc_id, 0 AS i, '' AS held, NULL::VARCHAR AS done FROM p
    UNION ALL SELECT doc_id, i + 1, CASE WHEN full_up OR held = '' THEN next ELSE held || chr(10) || next END, CASE WHEN full_up THEN held END
    FROM (SELECT doc_id, i, held, ps[i + 1] AS next, held <> '' AND length(held) + length(ps[i + 1]) > 500 AS full_up FROM f JOIN p USING (doc_id) WHERE i < len(ps))),
  c AS (SELECT doc_id, i, done AS text FROM f WHERE done IS NOT NULL
    UNION ALL SELECT doc_id, i + 1, held FROM f JOIN p USING (doc_id) WHERE i = len(ps) AND held <> '')
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_no, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS text FROM c"""


@query("ret_03_packed_paragraphs", _PACKED_SQL)
def packed_paragraphs(spark, folder):
    return chunks.packed_chunks(documents_of(spark, folder), "doc_id", "text", 500)


@query("ret_04_recursive_split")
def recursive_split(spark, folder):
    return chunks.recursive_chunks(documents_of(spark, folder), "doc_id", "text", 200, 50)


@query("ret_05_chunk_offsets", f"WITH {chunk_sql()} SELECT doc_id, chunk_no, text FROM chunks")
def chunk_offsets(spark, folder):
    """The words between the offsets, read from the source text."""
    offsets = chunks.word_chunk_offsets(documents_of(spark, folder), "doc_id", "text", SIZE, LAP, source=True)
    return offsets.select("doc_id", "chunk_no", F.array_join(tx.words(F.col("source"), lower=False), " ").alias("text"))


@query(
    "ret_06_ingest",
    f"""WITH {chunk_sql()} SELECT source, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_documents, CAST(sum(len(cws)) AS BIGINT) AS n_words,
    CAST(64 * count(*) AS BIGINT) AS n_slots FROM chunks JOIN documents USING (doc_id) GROUP BY 1""",
)
def ingest(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    path = scratch(spark, "ingest")
    cut = re.ingest(documents, SIZE, LAP, carry=["source"])
    cut.write.partitionBy("source").parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path)
    return stored.groupBy("source").agg(
        F.count("*").alias("n_chunks"),
        F.countDistinct("doc_id").alias("n_documents"),
        F.sum(F.col("n_words").cast("bigint")).alias("n_words"),
        F.sum(F.size("embedding").cast("bigint")).alias("n_slots"),
    )


@query(
    "ret_07_hybrid_scan",
    f"""WITH {QUESTIONS_SQL}, {word_hash_sql("de", "documents", "doc_id")}, {word_hash_sql("qe", "questions", "query_id", "question")},
    dots AS (SELECT query_id, doc_id, sum(de.weight * qe.weight) AS cosine FROM de JOIN qe USING (slot) GROUP BY ALL),
    ds AS (SELECT doc_id, {_set("text")} AS words FROM documents), qs AS (SELECT query_id, {_set("question")} AS words FROM questions),
    mixed AS (SELECT query_id, doc_id, round(0.5 * cosine + 0.5 * len(list_intersect(qs.words, ds.words)) / greatest(len(qs.words), 1), 8) AS score
              FROM dots JOIN ds USING (doc_id) JOIN qs USING (query_id))
    SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM mixed QUALIFY rank <= 3""",
)
def hybrid_scan(spark, folder):
    return re.hybrid_search(document_store(spark, folder), ["doc_id"], questions_of(spark, folder), 0.5, 3)


@query(
    "ret_08_hybrid_postings",
    f"""WITH {retrieve_sql(10)} """
    + _rerank_sql(
        f"""0.7::DOUBLE * score + 0.3::DOUBLE * list_sum(list_transform({_words("lower(question)")},
        lambda q: len(list_filter({_words("lower(text)")}, lambda x: x = q)))) / greatest(len({_words("question")}), 1)""",
        5,
    ),
)
def hybrid_postings(spark, folder):
    found = written(re.retrieve(chunk_store(spark, folder), questions_of(spark, folder), 10), "results")
    return _result(re.hybrid_indexed(found, questions_of(spark, folder), chunk_index(spark, folder), 0.7, 5))


@query(
    "ret_09_hybrid_substring",
    f"""WITH {retrieve_sql(10)} """
    + _rerank_sql(
        f"""0.7::DOUBLE * score + 0.3::DOUBLE * len(list_filter({_words("lower(question)")}, lambda q: contains(lower(text), q)))
        / greatest(len({_words("question")}), 1)""",
        5,
    ),
)
def hybrid_substring(spark, folder):
    return _result(re.hybrid_substring(_found(spark, folder, 10), 0.3, IDS, 5))


_BOOSTED = ["the", "license", "und"]


@query(
    "ret_10_rerank_boosted",
    f"""WITH {retrieve_sql(5)} """
    + _rerank_sql(
        f"""score * CASE WHEN contains(lower(text), lower(question)) THEN 1.5 ELSE 1.0 END
        * power(1.2, {" + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in _BOOSTED)})
        * (1 + 0.1 * len(list_intersect({_set("question")}, {_set("text")})))""",
        None,
    ),
)
def rerank_boosted(spark, folder):
    return _result(re.rerank_boosted(_found(spark, folder, 5), _BOOSTED, IDS))


_OVERLAP = f"""score * 0.5 + 0.5 * len(list_intersect({_set("question")}, {_set("text")})) / greatest(len({_set("question")}), 1)"""


@query("ret_11_rerank_overlap", f"WITH {retrieve_sql(10)} " + _rerank_sql(_OVERLAP, 5))
def rerank_overlap(spark, folder):
    return _result(re.rerank_overlap(_found(spark, folder, 10), IDS, 5))


@query(
    "ret_12_context",
    f"""WITH {retrieve_sql(5)} SELECT query_id, string_agg('- ' || text, chr(10) ORDER BY rank) AS context, count(*) AS n_sources
    FROM found WHERE score >= 0.8 GROUP BY 1""",
)
def context(spark, folder):
    return re.assemble(_found(spark, folder, 5), 0.8, "\n", "- ")


# fixed values: words that block a question
_BLOCKED = ["password", "secret", "confidential", "ssn"]


@query(
    "ret_13_answer_questions",
    f"""WITH {retrieve_sql(6)}, r AS ({_rerank_sql(_OVERLAP, 3)}),
    guard AS (SELECT query_id, CASE WHEN length(question) > 4096 THEN 'Input too long: ' || length(question)
      {" ".join(f"WHEN contains(lower(question), '{p}') THEN 'Blocked pattern: {p}'" for p in _BLOCKED)} END AS reason FROM questions),
    c AS (SELECT query_id, string_agg(found.text, chr(10) || chr(10) ORDER BY r.rank) AS context, count(*) AS n,
      string_agg(found.doc_id || ':' || d.source || ':' || substring(found.text, 1, 100) || '...', '|' ORDER BY r.rank) AS sources
      FROM r JOIN found USING (query_id, doc_id, chunk_no) JOIN documents d USING (doc_id) GROUP BY 1)
    SELECT guard.query_id, reason IS NOT NULL AS blocked, reason, CASE WHEN reason IS NULL THEN context END AS context,
    CASE WHEN reason IS NULL THEN sources END AS sources FROM guard LEFT JOIN c USING (query_id)""",
)
def answer_questions(spark, folder):
    documents = table(spark, folder, "documents")
    titles = documents.select("doc_id", F.col("source").alias("title"))
    found = re.answer_questions(
        chunk_store(spark, folder), questions_of(spark, folder), _BLOCKED, 4096, 3, titles
    )
    printed = F.transform("sources", lambda s: F.concat_ws(":", s["doc_id"].cast("string"), s["title"], s["preview"]))
    return found.select("query_id", "blocked", "reason", "context", F.array_join(printed, "|").alias("sources"))


_LABEL_SEARCH_SQL = f"""{CENTROIDS_SQL}, top AS (SELECT query_id, vec_id, label,
  row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 8) DESC, vec_id) AS rank
  FROM centroids CROSS JOIN embeddings QUALIFY rank <= 10)"""


def _label_search(spark, folder):
    embeddings = table(spark, folder, "embeddings")
    asked = vectors.centroids(embeddings, "label", "embedding")
    corpus = embeddings.select("vec_id", "embedding")
    results = blocks.top_k(corpus, ["vec_id"], asked, "query_id", vectors.vector_scorer("cosine"), 10)
    return written(results, "results"), embeddings.select(F.col("label").alias("query_id"), "vec_id")


@query(
    "ret_14_precision_recall",
    f"""WITH {_LABEL_SEARCH_SQL}, c AS (SELECT query_id, count(*) AS n, count(*) FILTER (label = query_id) AS hits,
      (SELECT count(*) FROM embeddings e WHERE e.label = top.query_id) AS wanted FROM top GROUP BY 1)
    SELECT query_id, round(hits / n, 6) AS precision, round(hits / wanted, 6) AS recall,
    round(CASE WHEN hits = 0 THEN 0 ELSE 2 * (hits / n) * (hits / wanted) / (hits / n + hits / wanted) END, 6) AS f1 FROM c""",
)
def precision_recall(spark, folder):
    found = re.precision_recall(*_label_search(spark, folder), "vec_id")
    return found.select("query_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "ret_15_answer_overlap",
    f"""WITH {CHAT_PAIRS_SQL} SELECT conv_id, turn, round(len(list_intersect({_set("instruction")}, {_set("output")}))
    / greatest(len({_set("instruction")}), 1), 6) AS word_overlap, len({_words("output")}) AS answer_length FROM pairs""",
)
def answer_overlap(spark, folder):
    return chat_pairs(table(spark, folder, "conversations")).select(
        "conv_id",
        "turn",
        F.round(re.word_share(F.col("instruction"), F.col("output")), 6).alias("word_overlap"),
        tx.word_count(F.col("output")).alias("answer_length"),
    )


@query(
    "ret_16_context_relevance",
    f"""WITH {retrieve_sql(5)}, c AS (SELECT query_id, question, string_agg(text, ' ' ORDER BY rank) AS context FROM found GROUP BY ALL)
    SELECT query_id, round(len(list_intersect({_set("question")}, {_set("context")})) / greatest(len({_set("question")}), 1), 6) AS relevance FROM c""",
)
def context_relevance(spark, folder):
    held = re.assemble(_found(spark, folder, 5), -1.0).join(questions_of(spark, folder), "query_id")
    return held.select("query_id", F.round(re.word_share(F.col("question"), F.col("context")), 6).alias("relevance"))


_KEYWORDS = ["the", "and", "license", "mit", "der"]


@query(
    "ret_17_keyword_coverage",
    "SELECT doc_id, round(("
    + " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in _KEYWORDS)
    + ") / 5, 6) AS coverage FROM documents",
)
def keyword_coverage(spark, folder):
    coverage = re.keyword_coverage(F.col("text"), _KEYWORDS)
    return documents_of(spark, folder).select("doc_id", F.round(coverage, 6).alias("coverage"))


@query(
    "ret_18_response_quality",
    f"""WITH {retrieve_sql(3)}, s AS (SELECT query_id, avg(score) AS m, count(*) AS n FROM found WHERE score >= 0.9 GROUP BY 1),
    q AS (SELECT query_id, coalesce(m, 0.5) AS relevance, CASE WHEN coalesce(n, 0) >= 2 THEN 0.85 ELSE 0.6 END::DOUBLE AS groundedness
          FROM questions LEFT JOIN s USING (query_id))
    SELECT query_id, round(relevance, 6) AS relevance, groundedness, 0.9::DOUBLE AS coherence, round((relevance + groundedness + 0.9) / 3, 6) AS overall,
    CASE WHEN (relevance + groundedness + 0.9) / 3 >= 0.8 THEN 'Success' ELSE 'LowQuality' END AS status FROM q""",
)
def response_quality(spark, folder):
    questions = questions_of(spark, folder)
    found = re.retrieve(chunk_store(spark, folder), questions, 3).where("score >= 0.9")
    return re.response_quality(found, questions, 0.8).withColumns({c: F.round(c, 6) for c in ("relevance", "overall")})


# --- named in the course text only ----------------------------------------------------

_BM25_SQL = f"""{QUESTIONS_SQL}, dw AS (SELECT doc_id, {_words("lower(text)")} AS ws FROM documents),
  size AS (SELECT count(*) AS n, avg(len(ws)) AS mean FROM dw),
  terms AS (SELECT query_id, unnest({_set("question")}) AS term FROM questions),
  tf AS (SELECT doc_id, len(ws) AS l, unnest(ws) AS term FROM dw),
  tfs AS (SELECT doc_id, l, term, count(*) AS tf FROM tf GROUP BY ALL),
  idf AS (SELECT term, ln(1 + ((SELECT n FROM size) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tfs GROUP BY 1),
  bm AS (SELECT query_id, doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / mean))), 8) AS score
         FROM terms JOIN tfs USING (term) JOIN idf USING (term), size GROUP BY ALL)"""


@query(
    "doc_01_bm25",
    f"""WITH {_BM25_SQL} SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM bm QUALIFY rank <= 10""",
)
def bm25(spark, folder):
    return postings.search(document_index(spark, folder), questions_of(spark, folder), 10)


@query(
    "doc_01_postings",
    f"""WITH w AS (SELECT doc_id, unnest({_words("lower(text)")}) AS term FROM documents)
    SELECT term, count(DISTINCT doc_id) AS n, count(*) AS occurrences FROM w GROUP BY 1""",
)
def build_postings(spark, folder):
    """The terms of an index that is built anew, with the texts that hold them and how often."""
    index = postings.build(documents_of(spark, folder), ["doc_id"], "text", scratch(spark, "postings"))
    return index.terms.select("term", "n", "occurrences")


@query(
    "doc_02_rank_fusion",
    f"""WITH {_BM25_SQL}, {word_hash_sql("de", "documents", "doc_id")}, {word_hash_sql("qe", "questions", "query_id", "question")},
    dots AS (SELECT query_id, doc_id, round(sum(de.weight * qe.weight), 8) AS score FROM de JOIN qe USING (slot) GROUP BY ALL),
    lists AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM bm QUALIFY rank <= 20
      UNION ALL SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM dots QUALIFY rank <= 20),
    fused AS (SELECT query_id, doc_id, round(sum(1 / (60 + rank)), 10) AS score FROM lists GROUP BY ALL)
    SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM fused QUALIFY rank <= 5""",
)
def rank_fusion(spark, folder):
    questions = questions_of(spark, folder)
    by_words = postings.search(document_index(spark, folder), questions, 20)
    by_vector = re.hybrid_search(document_store(spark, folder), ["doc_id"], questions, 1.0, 20)
    return re.fuse_ranks([by_words, by_vector], ["doc_id"], 5)


_SENTENCES_SQL = r"""s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(regexp_replace(text, '\s+', ' ', 'g'), '([^.!?]+[.!?]*|[.!?]+)'),
    lambda x: trim(x)), lambda x: x <> '') AS ps FROM documents)"""


@query(
    "doc_03_sentence_chunks",
    f"""WITH RECURSIVE {_SENTENCES_SQL},
  f AS (SELECT doc_id, 0 AS i, '' AS held, NULL::VARCHAR AS done FROM s
    UNION ALL SELECT doc_id, i + 1, CASE WHEN full_up OR held = '' THEN next ELSE held || ' ' || next END, CASE WHEN full_up THEN held END
    FROM (SELECT doc_id, i, held, ps[i + 1] AS next, held <> '' AND length(held) + length(ps[i + 1]) > 500 AS full_up FROM f JOIN s USING (doc_id) WHERE i < len(ps))),
  c AS (SELECT doc_id, i, done AS text FROM f WHERE done IS NOT NULL
    UNION ALL SELECT doc_id, i + 1, held FROM f JOIN s USING (doc_id) WHERE i = len(ps) AND held <> '')
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_no, text FROM c""",
)
def sentence_chunks(spark, folder):
    return chunks.sentence_chunks(documents_of(spark, folder), "doc_id", "text", 500)


@query(
    "doc_03_semantic_chunks",
    f"""WITH {_SENTENCES_SQL}, l AS (SELECT doc_id, unnest(ps) AS text, generate_subscripts(ps, 1) AS no FROM s), {word_hash_sql("se", "l", "doc_id, no")},
    near AS (SELECT a.doc_id, a.no + 1 AS no, round(sum(a.weight * b.weight), 8) AS c FROM se a JOIN se b ON a.doc_id = b.doc_id AND b.no = a.no + 1 AND a.slot = b.slot GROUP BY ALL),
    marked AS (SELECT doc_id, no, l.text, CAST(sum(CASE WHEN no > 1 AND coalesce(c, 0) < 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY no) AS INTEGER) AS chunk_no
      FROM l LEFT JOIN near USING (doc_id, no))
    SELECT doc_id, chunk_no, string_agg(text, ' ' ORDER BY no) AS text FROM marked GROUP BY 1, 2""",
)
def semantic_chunks(spark, folder):
    return re.semantic_chunks(documents_of(spark, folder), "doc_id", chunks.sentences(F.col("text")), 0.5)


@query(
    "doc_04_rank_quality",
    f"""WITH {_LABEL_SEARCH_SQL}, h AS (SELECT query_id, min(rank) FILTER (label = query_id) AS first, count(*) FILTER (label = query_id) AS hits,
      (SELECT count(*) FROM embeddings e WHERE e.label = top.query_id) AS wanted FROM top GROUP BY 1)
    SELECT round(avg(coalesce(1 / first, 0)), 6) AS mrr, round(avg(hits / wanted), 6) AS recall FROM h""",
)
def rank_quality(spark, folder):
    found = re.rank_quality(*_label_search(spark, folder), "vec_id")
    return found.select(F.round("mrr", 6).alias("mrr"), F.round("recall", 6).alias("recall"))


@query(
    "doc_05_context_budget",
    f"""WITH {retrieve_sql(10)}, t AS (SELECT *, sum(greatest(1, length(text) // 4)) OVER (PARTITION BY query_id ORDER BY rank) AS total FROM found)
    SELECT query_id, count(*) AS n_sources, CAST(max(total) AS BIGINT) AS tokens FROM t WHERE total <= 800 GROUP BY 1""",
)
def context_budget(spark, folder):
    kept = re.within_budget(_found(spark, folder, 10), tx.estimated_tokens(F.col("text")), 800)
    return kept.groupBy("query_id").agg(F.count("*").alias("n_sources"), F.max("tokens_so_far").alias("tokens"))


@query(
    "doc_06_null_rates",
    """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT 'lang' AS column_name, round(avg((lang IS NULL)::INT), 6) AS null_rate FROM j
    UNION ALL SELECT 'quality', round(avg((quality IS NULL)::INT), 6) FROM j UNION ALL SELECT 'toxic', round(avg((toxic IS NULL)::INT), 6) FROM j""",
)
def null_rates(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels"), "doc_id", "left")
    rates = [
        F.struct(F.lit(c).alias("column_name"), F.round(F.avg(F.col(c).isNull().cast("int")), 6).alias("null_rate"))
        for c in ("lang", "quality", "toxic")
    ]
    return joined.agg(F.array(*rates).alias("r")).select(F.inline("r"))
