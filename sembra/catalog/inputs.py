"""What the queries read: the given tables in the shapes the operators expect.

Every frame has a twin in SQL; ``with_`` joins common table expressions into one statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sembra.operators.encode import TOKEN_BREAK, HashingEncoder, embed_documents
from sembra.operators.mixture import Mixture, diagonal_mixture
from sembra.session import lookup_join, spread

DIM = 64


def text_encoder() -> HashingEncoder:
    return HashingEncoder(DIM)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c) + "\n" + select.strip()


# --- vectors -------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", F.col("label").cast("int").alias("cluster")
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the text and category of their document, where there is one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("category"))
    return vectors(spark, sf_dir).join(docs, "doc_id", "left").withColumn(
        "category", F.coalesce("category", F.lit("unknown"))
    )


def reversed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query per vector: the same numbers in reverse order, so no query equals a document."""
    return vectors(spark, sf_dir).select(
        F.col("doc_id").alias("qid"), F.reverse("embedding").alias("embedding")
    )


LABELLED = """
labelled AS (
  SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v, label::INT AS cluster, d.text,
         coalesce(d.source, 'unknown') AS category
  FROM embeddings LEFT JOIN documents d ON d.doc_id = vec_id)
"""

REVERSED = """
reversed AS (SELECT vec_id AS qid, list_reverse(embedding)::DOUBLE[] AS v FROM embeddings)
"""


def vector_mixture(spark: SparkSession, sf_dir: str) -> Mixture:
    return diagonal_mixture(vectors(spark, sf_dir), "cluster")


def parameters_sql(source: str, name: str = "par") -> str:
    """Weight, mean and variance per cluster and dimension of ``source(id, v, cluster)``."""
    return f"""
{name}_cells AS (
  SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM {source}),
{name} AS (
  SELECT cluster, d, avg(x) AS mu, var_samp(x) + 1e-6 AS var,
         count(*) / (SELECT count(*) FROM {source}) AS w
  FROM {name}_cells GROUP BY ALL)
"""


def posteriors_sql(source: str, name: str = "post", params: str = "par") -> str:
    """``{name}(id, c, p, ld)``: membership of every row of ``source(id, v)``."""
    return f"""
{name}_cells AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM {source}),
{name}_joint AS (
  SELECT id, cluster AS c,
         ln(any_value(w)) - 0.5 * sum(ln(2 * pi()) + ln(var) + (x - mu) * (x - mu) / var) AS lj
  FROM {name}_cells JOIN {params} USING (d) GROUP BY id, cluster),
{name}_top AS (SELECT *, max(lj) OVER (PARTITION BY id) AS m FROM {name}_joint),
{name} AS (
  SELECT id, c, exp(lj - m) / sum(exp(lj - m)) OVER (PARTITION BY id) AS p,
         m + ln(sum(exp(lj - m)) OVER (PARTITION BY id)) AS ld
  FROM {name}_top)
"""


def probes_sql(post: str = "post", name: str = "probes", depth: int = 2) -> str:
    """``{name}(id, probe, cluster)``, and ``{name}_dominant(id, dominant)``."""
    return f"""
{name}_dominant AS (
  SELECT id, c AS dominant FROM {post}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY p DESC, c) = 1),
{name}_kept AS (
  SELECT id, c, round(p, 4) AS p, count(*) OVER (PARTITION BY id) AS n,
         row_number() OVER (PARTITION BY id ORDER BY round(p, 4) DESC, c) - 1 AS probe
  FROM {post} WHERE p > 0.01),
{name} AS (
  SELECT id, probe, c AS cluster FROM {name}_kept WHERE n > 1 AND probe < {depth}
  UNION ALL
  SELECT id, 0 AS probe, dominant AS cluster FROM {name}_dominant
  WHERE id NOT IN (SELECT id FROM {name}_kept WHERE n > 1))
"""


LABEL_ROWS = "label_rows AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label::INT AS cluster FROM embeddings)"
VECTOR_POSTERIORS = ",\n".join([LABEL_ROWS, parameters_sql("label_rows"), posteriors_sql("label_rows")])
QUERY_ROWS = "query_rows AS (SELECT vec_id AS id, list_reverse(embedding)::DOUBLE[] AS v FROM embeddings)"
QUERY_POSTERIORS = ",\n".join(
    [LABEL_ROWS, parameters_sql("label_rows"), QUERY_ROWS, posteriors_sql("query_rows"), probes_sql()]
)


# --- texts ---------------------------------------------------------------------------------

# Deterministic noise around each document, by id: a message header, quotes, links, paths,
# keys, rules and runs of blanks, which the documents themselves do not contain.
NOISE_BEFORE = {
    0: "From: u@x.org\nSubject: t\n\n",
    1: "> quoted line\n|also quoted\n",
    2: "",
    3: "Organization: none\nLines: 3\nSubject:\n",
    4: "   \n12345\n----\n",
    5: "",
    6: "In article <1@x.org> someone wrote:\n",
    7: "",
}
NOISE_AFTER = {
    0: "\n-- \nsignature u@x.org",
    1: " https://example.org/a/b?c=d and www.example.org",
    2: " /usr/local/bin/tool C:\\dir\\sub\\file.txt /tmp",
    3: "\n-----BEGIN PGP SIGNATURE-----\nabc\n-----END PGP SIGNATURE-----\n",
    4: "\n\n\n\nmore   spaced\t\ttext",
    5: "\n1234\n****\n\nend",
    6: "\n> tail quote",
    7: "",
}


def noisy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 8
    def pick(noise: dict[int, str]):
        out = F.lit("")
        for k, value in noise.items():
            out = F.when(kind == k, F.lit(value)).otherwise(out)
        return out
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", F.concat(pick(NOISE_BEFORE), "text", pick(NOISE_AFTER)).alias("text"), "lang", "source")


def _sql_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t")
    return f"E'{escaped}'"


def _sql_pick(noise: dict[int, str]) -> str:
    return "CASE doc_id % 8 " + " ".join(f"WHEN {k} THEN {_sql_text(v)}" for k, v in noise.items()) + " END"


NOISY = f"""
noisy AS (
  SELECT doc_id, {_sql_pick(NOISE_BEFORE)} || text || {_sql_pick(NOISE_AFTER)} AS text, lang, source
  FROM documents)
"""


def embedding_sql(source: str, name: str) -> str:
    """``{name}(id, v)``: the hashed unit vector of every row of ``source(id, text)``."""
    return f"""
{name}_tokens AS (
  SELECT id, unnest(regexp_split_to_array(lower(text), '{TOKEN_BREAK}')) AS t FROM {source}),
{name}_hashed AS (
  SELECT id, (('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM})::INT AS d,
         sum(1 - 2 * (('0x' || substr(md5(t), 9, 1))::BIGINT % 2))::DOUBLE AS x
  FROM {name}_tokens WHERE t <> '' GROUP BY 1, 2),
{name}_norm AS (SELECT id, sqrt(sum(x * x)) AS n FROM {name}_hashed GROUP BY id),
{name} AS (
  SELECT s.id, list(coalesce(CASE WHEN n > 0 THEN x / n ELSE x END, 0)::FLOAT::DOUBLE ORDER BY g.d) AS v
  FROM {source} s CROSS JOIN (SELECT unnest(range({DIM}))::INT AS d) g
  LEFT JOIN {name}_hashed h ON h.id = s.id AND h.d = g.d
  LEFT JOIN {name}_norm m ON m.id = s.id GROUP BY s.id)
"""


def languages(df: DataFrame) -> DataFrame:
    """``cluster`` = position of the language in alphabetical order; rows stay where they are."""
    place = F.dense_rank().over(Window.orderBy("lang")) - 1
    names = df.select("lang").where("lang is not null").distinct().withColumn("cluster", place.cast("int"))
    return lookup_join(df, names, ["lang"], spread_by="doc_id", how="left").select(*df.columns, "cluster")


def text_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with hashed vectors; cluster = language."""
    docs = languages(documents(spark, sf_dir))
    rows = docs.select("doc_id", F.col("text").alias("document"), F.col("source").alias("category"), "cluster")
    return embed_documents(rows, "document", text_encoder)


def text_mixture(store: DataFrame) -> Mixture:
    return diagonal_mixture(store, "cluster")


TEXT_STORE = ",\n".join(
    [
        "doc_src AS (SELECT doc_id AS id, text FROM documents)",
        embedding_sql("doc_src", "doc_vec"),
        """doc_rows AS (
  SELECT v.id, v.v, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS cluster
  FROM doc_vec v JOIN documents d ON d.doc_id = v.id)""",
        parameters_sql("doc_rows", "par"),
    ]
)

FIRST_QUERY = 1_000_000_000


def benchmark_queries(spark: SparkSession, sf_dir: str, offset: int = 0) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + offset).alias("qid"), F.col("text").alias("query")
    )


def conversation_queries(spark: SparkSession, sf_dir: str, offset: int = FIRST_QUERY) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1_000 + F.col("turn") + offset).alias("qid"), F.col("text").alias("query")
    )


BENCHMARK_SRC = "bench_src AS (SELECT item_id AS id, text FROM benchmark)"
CONVERSATION_SRC = (
    f"conv_src AS (SELECT conv_id * 1000 + turn + {FIRST_QUERY} AS id, text FROM conversations)"
)
