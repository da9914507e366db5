"""Corpus, cleaning and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sembra.catalog.inputs import (
    BENCHMARK_SRC,
    NOISY,
    TEXT_STORE,
    documents,
    embedding_sql,
    noisy_documents,
    table,
    text_encoder,
    with_,
)
from sembra.catalog.registry import query
from sembra.functions import text as tx
from sembra.operators.encode import embed_documents, embed_queries
from sembra.session import scratch_path
from sembra.sources.artifacts import read_artifacts, write_artifacts
from sembra.sources.corpus import clean_corpus, clean_report, label_names, read_corpus
from sembra.sources.store import (
    append_documents,
    count_documents,
    ingest_missing,
    read_embeddings,
    read_store,
    update_metadata,
)

# The SQL twins of the cleaning steps, as templates over one text expression.
SQL_STEPS = {
    "strip_pgp": r"regexp_replace({0}, '(?s)-----BEGIN PGP.*?-----END PGP.*?-----', '', 'g')",
    "strip_quote_lines": r"regexp_replace({0}, '(?m)^[>|]+.*$', '', 'g')",
    "strip_emails": r"regexp_replace({0}, '\S+@\S+\.\S+', '', 'g')",
    "strip_urls": r"regexp_replace({0}, 'https?://\S+|www\.\S+', '', 'g')",
    "strip_paths": r"regexp_replace({0}, '(?:[A-Za-z]:\\|/)(?:[\w.\-]+[/\\])+[\w.\-]*', '', 'g')",
    "drop_header_zone": r"""list_aggregate(list_slice(string_split({0}, chr(10)),
      coalesce(nullif(list_position(list_transform(list_slice(string_split({0}, chr(10)), 1, 8),
        lambda l: regexp_matches(l, '^\s*[A-Za-z\-]+:\s+\S.*$')), false), 0),
        least(8, len(string_split({0}, chr(10)))) + 1),
      len(string_split({0}, chr(10)))), 'string_agg', chr(10))""",
    "blank_nonalpha_lines": r"regexp_replace({0}, '(?m)^[^a-zA-Z]*$', '', 'g')",
    "collapse_newlines": r"regexp_replace({0}, '\n{{3,}}', E'\n\n', 'g')",
    "collapse_spaces": r"regexp_replace({0}, '[ \t]{{2,}}', ' ', 'g')",
    "strip_ends": r"regexp_replace({0}, '^\s+|\s+$', '', 'g')",
}


def chain_sql(source: str, name: str, keep: str) -> str:
    """``{name}({keep}, text)``: ``source`` cleaned, one table expression per step."""
    ctes, previous = [], source
    for i, (step, template) in enumerate(SQL_STEPS.items()):
        current = f"{name}_{step}"
        value = template.format("text")
        if step == "drop_header_zone":
            value = f"coalesce({value}, '')"
        ctes.append(f"{current} AS (SELECT {keep}, {value} AS text FROM {previous})")
        previous = current
    ctes.append(f"{name} AS (SELECT * FROM {previous})")
    return ",\n".join(ctes)


def _register_step(name: str) -> None:
    value = SQL_STEPS[name].format("text")
    if name == "drop_header_zone":
        value = f"coalesce({value}, '')"
    step = getattr(tx, name)

    @query(name, with_(NOISY, select=f"SELECT doc_id, {value} AS text FROM noisy"))
    def run(spark, sf_dir):
        return noisy_documents(spark, sf_dir).select("doc_id", step(F.col("text")).alias("text"))


for _name in SQL_STEPS:
    _register_step(_name)


@query(
    "blank_to_empty",
    r"""
SELECT doc_id, CASE WHEN t IS NULL OR NOT regexp_matches(t, '\S') THEN '' ELSE t END AS text
FROM (SELECT doc_id, CASE lang WHEN 'de' THEN regexp_replace(text, '\S', ' ', 'g')
                               WHEN 'es' THEN NULL ELSE text END AS t FROM documents)
""",
)
def blank_to_empty(spark, sf_dir):
    text = (
        F.when(F.col("lang") == "de", F.regexp_replace("text", r"\S", " "))
        .when(F.col("lang") == "es", None)
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", tx.blank_to_empty(text).alias("text"))


@query("clean_document", with_(NOISY, chain_sql("noisy", "c", "doc_id"), select="SELECT doc_id, text FROM c"))
def clean_document(spark, sf_dir):
    return noisy_documents(spark, sf_dir).select("doc_id", tx.clean_document(F.col("text")).alias("text"))


@query(
    "clean_pages",
    with_(
        "raw AS (SELECT page_id, html AS text FROM pages)",
        chain_sql("raw", "c", "page_id"),
        select="SELECT page_id, text, length(text) >= 30 AS kept FROM c",
    ),
)
def clean_pages(spark, sf_dir):
    text = tx.clean_document(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", text.alias("text"), (F.length(text) >= 30).alias("kept"))


@query(
    "clean_corpus",
    with_(
        NOISY,
        chain_sql("noisy", "c", "doc_id, source"),
        select="SELECT doc_id, source AS category, text AS clean_text FROM c WHERE length(text) >= 30",
    ),
)
def clean_corpus_query(spark, sf_dir):
    return clean_corpus(noisy_documents(spark, sf_dir)).select(
        "doc_id", F.col("source").alias("category"), "clean_text"
    )


@query(
    "clean_report",
    with_(
        NOISY,
        chain_sql("noisy", "c", "doc_id"),
        select="""SELECT count(*) FILTER (length(text) >= 30) AS kept,
       count(*) FILTER (length(text) < 30) AS discarded FROM c""",
    ),
)
def clean_report_query(spark, sf_dir):
    return clean_report(noisy_documents(spark, sf_dir))


@query(
    "strip_sections",
    with_(
        NOISY,
        r"""
body AS (SELECT doc_id, CASE WHEN instr(text, E'\n\n') > 0 THEN substr(text, instr(text, E'\n\n') + 2) ELSE '' END
         AS text FROM noisy)""",
        r"""
cut AS (SELECT doc_id, text, string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10)) AS l FROM body)""",
        r"""
foot AS (SELECT doc_id, text, l, list_max(list_filter(range(1, len(l) + 1),
                lambda i: regexp_matches(l[i], '^\s*-*\s*$'))) AS cut_at FROM cut)""",
        """
bare AS (SELECT doc_id, CASE WHEN cut_at > 1 THEN list_aggregate(l[1:cut_at - 1], 'string_agg', chr(10)) ELSE text END AS text
         FROM foot)""",
        select=r"""
SELECT doc_id, coalesce(list_aggregate(list_filter(string_split(text, chr(10)), lambda j: NOT regexp_matches(j,
  'writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>')), 'string_agg', chr(10)), '') AS text
FROM bare""",
    ),
)
def strip_sections(spark, sf_dir):
    return noisy_documents(spark, sf_dir).select("doc_id", tx.strip_sections(F.col("text")).alias("text"))


@query("preview", "SELECT doc_id, substr(text, 1, 500) AS result_text, substr(text, 1, 200) AS report_text FROM documents")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.preview(F.col("text"), 500).alias("result_text"),
        tx.preview(F.col("text"), 200).alias("report_text"),
    )


@query(
    "short_category",
    """SELECT doc_id, string_split(source || '.' || lang, '.')[-1] AS short_dotted,
       string_split(source, '.')[-1] AS short_plain FROM documents""",
)
def short_category(spark, sf_dir):
    dotted = F.concat("source", F.lit("."), "lang")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.short_category(dotted).alias("short_dotted"),
        tx.short_category(F.col("source")).alias("short_plain"),
    )


@query(
    "read_corpus",
    """SELECT doc_id, text, source AS category, substr(source, 4)::INT AS category_id FROM documents""",
)
def read_corpus_query(spark, sf_dir):
    return _corpus(spark, sf_dir)


def _corpus(spark, sf_dir):
    number = F.substring("source", 4, 10)
    return read_corpus(spark, f"{sf_dir}/documents.parquet", category="source", category_id=number)


@query(
    "label_names",
    """
SELECT doc_id, quality AS category_id, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS category FROM labels""",
)
def label_names_query(spark, sf_dir):
    names = spark.createDataFrame([(0, "low"), (1, "high")], "category_id int, category string")
    labels = table(spark, sf_dir, "labels")
    quality = labels.schema["quality"].dataType
    names = names.withColumn("category_id", F.col("category_id").cast(quality))
    return label_names(labels.select("doc_id", F.col("quality").alias("category_id")), names)


def _rows(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    corpus = _corpus(spark, sf_dir).withColumnRenamed("text", "document")
    return vectors.join(corpus, "doc_id", "left")


STORED = """
stored AS (
  SELECT vec_id AS doc_id, 'doc_' || vec_id AS id, text AS document, embedding, source AS category,
         substr(source, 4)::INT AS category_id, vec_id AS original_index
  FROM embeddings LEFT JOIN documents ON doc_id = vec_id)
"""


@query(
    "append_documents",
    with_(STORED, select="""
SELECT doc_id, id, document, category, category_id, original_index, round(list_sum(embedding::DOUBLE[]), 4) AS total
FROM stored"""),
)
def append_documents_query(spark, sf_dir):
    path = scratch_path(spark, "store")
    append_documents(_rows(spark, sf_dir), path)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return read_store(spark, path).select(
        "doc_id", "id", "document", "category", "category_id", "original_index", F.round(total, 4).alias("total")
    )


@query("ingest_missing", with_(STORED, select="SELECT id, document FROM stored"))
def ingest_missing_query(spark, sf_dir):
    """Documents with a category first, then everything: each is stored once."""
    path = scratch_path(spark, "store")
    rows = _rows(spark, sf_dir)
    ingest_missing(rows.where(F.col("category").isin("src0", "src1", "src2")), path)
    ingest_missing(rows, path)
    return read_store(spark, path).select("id", "document")


@query("count_documents", "SELECT count(*) AS documents FROM embeddings")
def count_documents_query(spark, sf_dir):
    path = scratch_path(spark, "store")
    append_documents(_rows(spark, sf_dir), path)
    return count_documents(read_store(spark, path))


@query(
    "read_embeddings",
    with_(STORED, select="""
SELECT id, category, category_id, round(x, 4) + 0.0 AS x, d::INT AS d
FROM (SELECT id, category, category_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d
      FROM stored)"""),
)
def read_embeddings_query(spark, sf_dir):
    path = scratch_path(spark, "store")
    append_documents(_rows(spark, sf_dir), path)
    return (
        read_embeddings(read_store(spark, path))
        .select("id", "category", "category_id", F.posexplode_outer("embedding").alias("d", "x"))
        .withColumn("x", F.round(F.col("x").cast("double"), 4) + F.lit(0.0))
    )


@query(
    "update_metadata",
    with_(STORED, select="""
SELECT id, coalesce(CASE WHEN l.quality = 1 THEN 'good' END, category) AS category, original_index,
       l.quality::INT AS dominant_cluster
FROM stored LEFT JOIN labels l USING (doc_id)"""),
)
def update_metadata_query(spark, sf_dir):
    path = scratch_path(spark, "store")
    append_documents(_rows(spark, sf_dir), path)
    updates = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").alias("category"),
        F.col("quality").cast("int").alias("dominant_cluster"),
    )
    update_metadata(spark, path, updates.select("doc_id", "category"))
    update_metadata(spark, path, updates.select("doc_id", "dominant_cluster"))
    return read_store(spark, path).select("id", "category", "original_index", "dominant_cluster")


@query("write_artifacts", "SELECT source, count(*) AS documents, max(n_chars) AS longest FROM documents GROUP BY source")
def write_artifacts_query(spark, sf_dir):
    report = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.max("n_chars").alias("longest")
    )
    path = scratch_path(spark, "report")
    write_artifacts(report, path)
    return read_artifacts(spark, path, "source string, documents long, longest long")


@query(
    "embed_documents",
    with_(TEXT_STORE, select="""
SELECT id AS doc_id, (d - 1)::INT AS d, round(x, 4) + 0.0 AS x
FROM (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM doc_vec)"""),
)
def embed_documents_query(spark, sf_dir):
    embedded = embed_documents(documents(spark, sf_dir), encoder=text_encoder)
    return embedded.select("doc_id", F.posexplode_outer("embedding").alias("d", "x")).withColumn(
        "x", F.round(F.col("x").cast("double"), 4) + F.lit(0.0)
    )


@query(
    "embed_queries",
    with_(BENCHMARK_SRC, embedding_sql("bench_src", "bench_vec"), select="""
SELECT id AS qid, (d - 1)::INT AS d, round(x, 4) + 0.0 AS x
FROM (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM bench_vec)"""),
)
def embed_queries_query(spark, sf_dir):
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return (
        embed_queries(queries, encoder=text_encoder)
        .select("qid", F.posexplode_outer("embedding").alias("d", "x"))
        .withColumn("x", F.round(F.col("x").cast("double"), 4) + F.lit(0.0))
    )
