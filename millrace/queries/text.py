"""Tokens, term statistics and text features, over whole texts."""

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import text as ops
from millrace.plans import text_classes
from millrace.plans.text_classes import with_length
from millrace.queries.scalars import _TOKENS
from millrace.registry import query

STOP = ["and", "the", "of", "in", "with", "that", "is", "le", "la", "un", "der", "und"]
_STOP = ", ".join(f"'{w}'" for w in STOP)


@query(
    "tokenize",
    f"""SELECT doc_id, CAST(len(tokens) AS INTEGER) AS tokens, tokens[1] AS first_token FROM
          (SELECT doc_id, {_TOKENS} AS tokens FROM documents)""",
)
def tokenize(t):
    tokens = t.documents.select("doc_id", "text").select("doc_id", ops.tokenize(F.col("text")).alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("tokens"), F.get("tokens", F.lit(0)).alias("first_token"))


@query(
    "tokenize_regex",
    r"""SELECT doc_id, CAST(len(tokens) AS INTEGER) AS tokens, tokens[1] AS first_token FROM
          (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]'), lambda x: length(x) >= 1) AS tokens
           FROM documents)""",
)
def tokenize_regex(t):
    tokens = t.documents.select("doc_id", "text").select("doc_id", ops.tokenize_regex(F.col("text"), r"\W").alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("tokens"), F.get("tokens", F.lit(0)).alias("first_token"))


@query(
    "stopword_removal",
    f"""SELECT doc_id, CAST(len(tokens) AS INTEGER) AS tokens, CAST(len(kept) AS INTEGER) AS kept FROM
          (SELECT doc_id, tokens, list_filter(tokens, lambda x: x NOT IN ({_STOP})) AS kept FROM
            (SELECT doc_id, {_TOKENS} AS tokens FROM documents))""",
)
def stopword_removal(t):
    tokens = t.documents.select("doc_id", "text").select("doc_id", ops.tokenize(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").alias("tokens"), F.size(ops.remove_stopwords(F.col("tokens"), STOP)).alias("kept")
    )


@query(
    "bigrams",
    f"""SELECT tokens[i] || ' ' || tokens[i + 1] AS bigram, count(*) AS count FROM
          (SELECT tokens, unnest(range(1, len(tokens))) AS i FROM (SELECT {_TOKENS} AS tokens FROM documents))
        GROUP BY bigram""",
)
def bigrams(t):
    tokens = t.documents.select("text").select(ops.tokenize(F.col("text")).alias("tokens"))
    return ops.term_counts(tokens, ops.ngrams(F.col("tokens"), 2), "bigram")


@query("hashing_tf")
def hashing_tf(t):
    """Term frequencies hashed into 20 buckets."""
    tokens = t.documents.select("doc_id", "text").select("doc_id", ops.tokenize(F.col("text")).alias("tokens"))
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=20).transform(tokens)
    return hashed.select("doc_id", vector_to_array("tf").alias("tf"))


# The bucket of each word among 20, by the hash of MLlib's HashingTF.
BUCKETS = {"the": 17, "of": 15, "de": 5, "and": 11, "to": 8, "in": 3, "la": 18, "der": 1, "is": 9, "that": 0, "en": 13, "for": 4}


@query(
    "hashing_tf_terms",
    f"""SELECT doc_id, bucket, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents)
        JOIN (VALUES {", ".join(f"('{w}', {b})" for w, b in BUCKETS.items())}) v(term, bucket) USING (term) GROUP BY doc_id, bucket""",
)
def hashing_tf_terms(t):
    """Hashed frequencies of a dozen words: (doc_id, bucket, tf) of the buckets in use."""
    tokens = ops.tokenize(F.col("text"))
    kept = t.documents.select("doc_id", "text").select("doc_id", F.filter(tokens, lambda w: w.isin(*BUCKETS)).alias("tokens"))
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=20).transform(kept)
    return hashed.select("doc_id", F.posexplode(vector_to_array("tf")).alias("bucket", "tf")).filter("tf > 0")


@query(
    "vocabulary_counts",
    f"""SELECT term, count, docs, CAST(row_number() OVER (ORDER BY count DESC, term) - 1 AS INTEGER) AS index FROM
          (SELECT term, count(*) AS count, count(DISTINCT doc_id) AS docs FROM
            (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents) GROUP BY term HAVING count(DISTINCT doc_id) >= 2
           ORDER BY count DESC, term LIMIT 1000)""",
)
def vocabulary_counts(t):
    """The 1,000 most frequent terms of two documents or more, numbered."""
    terms = ops.vocabulary(t.documents.select("text"), ops.tokenize(F.col("text")), size=1000, min_docs=2)
    position = F.row_number().over(Window.orderBy(F.col("count").desc(), "term")) - 1
    return terms.withColumn("index", position)


@query(
    "tf_idf",
    f"""WITH tokens AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents),
             tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
             df AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term)
        SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tf_idf FROM tf JOIN df USING (term)""",
)
def tf_idf(t):
    table = ops.tf_idf(t.documents.select("doc_id", "text"), "doc_id", ops.tokenize(F.col("text")))
    return table.withColumns({"idf": F.round("idf", 6), "tf_idf": F.round("tf_idf", 6)})


def labelled_texts(t):
    """Documents with a quality label, as messages with a class and a length."""
    labels = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("class"))
    return with_length(t.documents.select("doc_id", "text").join(labels, "doc_id"))


@query(
    "text_features",
    f"""WITH msg AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS class, text, length(text) AS length
                     FROM documents JOIN labels USING (doc_id)),
             tokens AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM msg),
             tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens WHERE term NOT IN ({_STOP}) GROUP BY doc_id, term),
             df AS (SELECT term, ln(((SELECT count(*) FROM msg) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term),
             sums AS (SELECT doc_id, count(*) AS terms, sum(tf * idf) AS weight FROM tf JOIN df USING (term) GROUP BY doc_id),
             classes AS (SELECT class, row_number() OVER (ORDER BY count(*) DESC, class) - 1 AS label FROM msg GROUP BY class)
        SELECT doc_id, class, CAST(label AS DOUBLE) AS label, CAST(length AS INTEGER) AS length,
               CAST(coalesce(terms, 0) AS INTEGER) AS terms, round(coalesce(weight, 0), 4) AS weight
        FROM msg JOIN classes USING (class) LEFT JOIN sums USING (doc_id)""",
)
def text_features(t):
    """Feature table of the labelled texts: label index, and terms and weight of the tf-idf of the whole vocabulary."""
    table = text_classes.text_features(labelled_texts(t), "doc_id", stop=STOP)
    weight = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda s, x: s + x)
    return table.select("doc_id", "class", "label", "length", F.size("weights").alias("terms"), F.round(weight, 4).alias("weight"))


@query(
    "hashing_tf_totals",
    f"SELECT doc_id, CAST(len({_TOKENS}) AS DOUBLE) AS tokens FROM documents",
)
def hashing_tf_totals(t):
    """The hashed frequencies of a text add up to its tokens."""
    return hashing_tf(t).select("doc_id", F.aggregate("tf", F.lit(0.0), lambda s, x: s + x).alias("tokens"))
