"""Embedding and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.embed import char_embedding, char_hash, embed_with, spaced_words, word_embedding
from marlstone.operators import blocks, vectors
from marlstone.plans.registry import query, table
from marlstone.plans.relational import CENTROIDS_SQL

DIM = 64


def word_hash_sql(name: str, source: str, key: str, text: str = "text", lower: bool = True, dim: int = DIM) -> str:
    """CTE ``name`` (key, slot, weight): the word-position hash embedding, slots that are not zero."""
    folded = f"lower({text})" if lower else text
    return rf"""{name}_w AS (SELECT {key}, list_filter(string_split_regex({folded}, '\s+'), lambda w: w <> '') AS ws FROM {source}),
  {name}_i AS (SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM {name}_w),
  {name}_c AS (SELECT {key}, i, unnest(string_split(w, '')) AS c, unnest(range(length(w))) AS j FROM {name}_i),
  {name}_n AS (SELECT {key}, (unicode(c) * i + j) % {dim} AS slot, count(*) AS n FROM {name}_c GROUP BY ALL),
  {name} AS (SELECT {key}, slot, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS weight FROM {name}_n)"""


def dense_sql(name: str, sparse: str, key: str, dim: int = DIM) -> str:
    """CTE ``name`` (key, e): the embedding as a list."""
    return f"""{name} AS (SELECT {key}, list_transform(range({dim}), lambda s: coalesce(m[s], 0.0)) AS e
  FROM (SELECT {key}, map_from_entries(list((slot, weight))) AS m FROM {sparse} GROUP BY 1))"""


def _slots(df, key, embedding):
    """Long form of an embedding: the slots that are not zero."""
    long = df.select(key, F.posexplode(embedding).alias("slot", "weight")).where("weight <> 0")
    return long.select(key, "slot", F.round("weight", 8).alias("weight"))


@query(
    "vec_01_word_hash_embedding",
    f"WITH {word_hash_sql('emb', 'documents', 'doc_id')} SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(weight, 8) AS weight FROM emb",
)
def word_hash_embedding(spark, folder):
    return _slots(table(spark, folder, "documents"), "doc_id", word_embedding(F.col("text"), DIM))


@query(
    "vec_01_word_hash_cased",
    f"""WITH {word_hash_sql('emb', 'benchmark', 'item_id', lower=False, dim=128)}
    SELECT item_id, CAST(slot AS INTEGER) AS slot, round(weight, 8) AS weight FROM emb""",
)
def word_hash_cased(spark, folder):
    return _slots(table(spark, folder, "benchmark"), "item_id", word_embedding(F.col("text"), 128, lower=False))


_CHAR_SQL = """c AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(length(text))) AS i FROM documents),
  n AS (SELECT doc_id, (unicode(c) + i) % 64 AS slot, count(*) AS n FROM c GROUP BY ALL),
  emb AS (SELECT doc_id, slot, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS weight FROM n)"""


@query(
    "vec_02_char_hash_embedding",
    f"WITH {_CHAR_SQL} SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(weight, 8) AS weight FROM emb",
)
def char_hash_embedding(spark, folder):
    return _slots(table(spark, folder, "documents"), "doc_id", char_embedding(F.col("text"), DIM))


@query(
    "vec_03_batch_embedding",
    f"""WITH {_CHAR_SQL} SELECT doc_id, CAST(64 AS INTEGER) AS dim, count(*) AS n_slots, round(max(weight), 8) AS top_weight,
    round(sum(weight), 6) AS total_weight FROM emb GROUP BY 1""",
)
def batch_embedding(spark, folder):
    embedded = table(spark, folder, "documents").select("doc_id", embed_with(char_hash, DIM)("text").alias("e"))
    return embedded.select(
        "doc_id",
        F.size("e").alias("dim"),
        F.size(F.filter("e", lambda x: x != 0)).cast("bigint").alias("n_slots"),
        F.round(F.array_max("e"), 8).alias("top_weight"),
        F.round(F.aggregate("e", F.lit(0.0), lambda a, x: a + x), 6).alias("total_weight"),
    )


_METRIC_SQL = {
    "cosine": "list_cosine_similarity(q, e)",
    "dot": "list_dot_product(q, e)",
    "euclidean": "-list_distance(q, e)",
}
_VECTORS_SQL = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _search_sql(where: str, metric: str, k: int, tag: str) -> str:
    return f"""SELECT '{tag}' AS search, query_id, vec_id, round({_METRIC_SQL[metric]}, 8) AS score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY round({_METRIC_SQL[metric]}, 8) DESC, vec_id) AS INTEGER) AS rank
    FROM centroids CROSS JOIN v {where} QUALIFY rank <= {k}"""


def _search(spark, folder, corpus, metric, k, tag):
    asked = vectors.centroids(table(spark, folder, "embeddings"), "label", "embedding")
    found = blocks.top_k(corpus.select("vec_id", "embedding"), ["vec_id"], asked, "query_id", vectors.vector_scorer(metric), k)
    return found.select(F.lit(tag).alias("search"), "query_id", "vec_id", "score", "rank")


@query(
    "vec_04_exact_search",
    f"WITH {CENTROIDS_SQL}, {_VECTORS_SQL} " + " UNION ALL ".join(_search_sql("", m, 5, m) for m in _METRIC_SQL),
)
def exact_search(spark, folder):
    corpus = table(spark, folder, "embeddings")
    by_cosine, by_dot, by_distance = (_search(spark, folder, corpus, m, 5, m) for m in _METRIC_SQL)
    return by_cosine.unionByName(by_dot).unionByName(by_distance)


@query(
    "vec_05_filtered_search",
    f"WITH {CENTROIDS_SQL}, {_VECTORS_SQL} "
    + " UNION ALL ".join(
        _search_sql(where, "cosine", 5, tag)
        for tag, where in {
            "equals": "WHERE label = 3",
            "not_equals": "WHERE NOT (label < 5 AND vec_id % 2 = 0)",
            "one_of": "WHERE label IN (1, 2)",
        }.items()
    ),
)
def filtered_search(spark, folder):
    # 'half' is set for labels below 5 only
    half = F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd")
    only_label = F.create_map(F.lit("label"), F.col("label").cast("string"))
    both = F.map_concat(only_label, F.create_map(F.lit("half"), half))
    corpus = table(spark, folder, "embeddings").withColumn("metadata", F.when(F.col("label") < 5, both).otherwise(only_label))
    m = F.col("metadata")
    return (
        _search(spark, folder, corpus.where(vectors.equals(m, "label", "3")), "cosine", 5, "equals")
        .unionByName(_search(spark, folder, corpus.where(vectors.not_equals(m, "half", "even")), "cosine", 5, "not_equals"))
        .unionByName(_search(spark, folder, corpus.where(vectors.one_of(m, "label", ["1", "2"])), "cosine", 5, "one_of"))
    )


@query(
    "vec_06_batch_search",
    f"""WITH {word_hash_sql('de', 'documents', 'doc_id')}, {word_hash_sql('be', 'benchmark', 'item_id')},
    dots AS (SELECT item_id, doc_id, round(sum(de.weight * be.weight), 8) AS score FROM de JOIN be USING (slot) GROUP BY 1, 2)
    SELECT item_id AS query_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM dots QUALIFY rank <= 5""",
)
def batch_search(spark, folder):
    corpus = table(spark, folder, "documents").select("doc_id", spaced_words(F.col("text")).alias("text"))
    asked = table(spark, folder, "benchmark").select("item_id", spaced_words(F.col("text")).alias("query"))
    return blocks.top_k(corpus, ["doc_id"], asked, "item_id", vectors.text_scorer(DIM), 5)


@query(
    "vec_07_nearest_others",
    f"""WITH {CENTROIDS_SQL}
    SELECT a.query_id, b.query_id AS other_id, round(list_cosine_similarity(a.q, b.q), 8) AS score,
    CAST(row_number() OVER (PARTITION BY a.query_id ORDER BY round(list_cosine_similarity(a.q, b.q), 8) DESC, b.query_id) AS INTEGER) AS rank
    FROM centroids a JOIN centroids b ON a.query_id <> b.query_id QUALIFY rank <= 3""",
)
def nearest_others(spark, folder):
    return vectors.nearest_others(vectors.centroids(table(spark, folder, "embeddings"), "label", "embedding"), 3)


@query("vec_08_substring_search", "SELECT doc_id, lang, n_chars FROM documents WHERE contains(lower(text), lower('License'))")
def substring_search(spark, folder):
    return (
        table(spark, folder, "documents")
        .where(F.contains(F.lower("text"), F.lower(F.lit("License"))))
        .select("doc_id", "lang", "n_chars")
    )
