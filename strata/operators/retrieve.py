"""Vector top-k and evidence / prompt assembly.

Cosine similarity is built from higher-order array functions (``zip_with``,
``aggregate``) so it stays inside codegen -- no Python UDF.  The query vector
is a scalar (literal or scalar subquery), not a joined table: scoring is a
map-only projection and top-k is Spark's TakeOrderedAndProject (a bounded
per-task heap, then one merge of k rows per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sinks.upsert import latest_per_key, upsert

# Match band threshold and labels; document id length limit.
MATCH_THRESHOLD = 0.5
MATCH, PARTIAL = "Match", "Partial"
MAX_ID_LENGTH = 50
# The analyst prompt template (question, context).
PROMPT_TEMPLATE = ("You are a route analyst.\n\nUsing only the supplied graph context,\n"
                   "explain the route.\n\nQuestion:\n%s\n\nGraph Context:\n%s")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def as_doubles(vec: Column) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; a zero-norm side scores 0.0."""
    a, b = as_doubles(a), as_doubles(b)
    dot = _sum(F.zip_with(a, b, lambda x, y: x * y))
    na = F.sqrt(_sum(F.transform(a, lambda x: x * x)))
    nb = F.sqrt(_sum(F.transform(b, lambda x: x * x)))
    return F.when((na > 0) & (nb > 0), dot / (na * nb)).otherwise(F.lit(0.0))


def query_vector(vectors: DataFrame, id_col: str, vec_col: str, vec_id) -> Column:
    """The vector of one stored item as a scalar subquery (stays lazy)."""
    return vectors.filter(F.col(id_col) == F.lit(vec_id)).select(vec_col).scalar()


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def vector_topk(vectors: DataFrame, id_col: str, vec_col: str, query: Column, k: int,
                keep: Sequence[str] = ()) -> DataFrame:
    """The k most similar items, descending score, ties by id.

    ``k`` larger than the table gives the whole table.
    """
    # the query and its norm are one scalar, worked out once; it is projected first, as subqueries cannot sit inside lambdas
    q = vectors.sparkSession.range(1).select(query.alias("_raw")).select(as_doubles(F.col("_raw")).alias("v")).select("v", F.sqrt(_sum(F.transform("v", lambda x: x * x))).alias("n"))
    withq = vectors.select(F.col(id_col), as_doubles(F.col(vec_col)).alias("_v"), *[F.col(c) for c in keep],
                           q.select(F.struct("v", "n")).scalar().alias("_q"))
    dot, norm = _sum(F.zip_with("_v", F.col("_q.v"), lambda x, y: x * y)), F.sqrt(_sum(F.transform("_v", lambda x: x * x)))
    score = F.when((norm > 0) & (F.col("_q.n") > 0), dot / (norm * F.col("_q.n"))).otherwise(F.lit(0.0))
    scored = withq.select(F.col(id_col), *[F.col(c) for c in keep], score.alias("score"))
    return scored.orderBy(F.desc("score"), F.col(id_col)).limit(int(k))


def match_band(score: Column) -> Column:
    """``Match`` when score > 0.5, else ``Partial``."""
    return F.when(score > F.lit(MATCH_THRESHOLD), F.lit(MATCH)).otherwise(F.lit(PARTIAL))


def _indexable(id_col: str, text_col: str):
    ident = F.col(id_col).cast("string")
    long_ = F.when(F.length(ident) > MAX_ID_LENGTH, F.lit(f"id over {MAX_ID_LENGTH} characters"))
    return F.coalesce(F.when(F.coalesce(ident, F.lit("")) == "", F.lit("no id")), long_,
                      F.when(F.coalesce(F.col(text_col), F.lit("")) == "", F.lit("no text")))


def rejected_documents(batch: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The rows that ``index_documents`` does not take, with their ``reason``."""
    return batch.withColumn("reason", _indexable(id_col, text_col)).filter("reason IS NOT NULL")


def index_documents(existing: DataFrame | None, batch: DataFrame, id_col: str = "id",
                    text_col: str = "text", order_by: str | None = None) -> DataFrame:
    """Keep entries with an id (<= 50 chars) and a text; upsert by id.

    A repeated id replaces the stored entry (vector and text; the newest text
    is kept -- a deviation from the source, which kept both texts).  Of repeats within the batch the one
    with the greatest ``order_by`` counts (the greatest text, if that is not given), so reruns agree.  What is
    not taken comes from ``rejected_documents``.
    """
    clean = batch.filter(_indexable(id_col, text_col).isNull())
    newest = latest_per_key(clean.withColumn("_order", F.struct(order_by or text_col, text_col)), id_col, "_order").drop("_order")
    newest = newest.select(*batch.columns)
    return newest if existing is None else upsert(existing, newest, id_col, mode="replace")


def prompt(question: Column, context: Column) -> Column:
    """The fixed analyst template with question and context."""
    return F.format_string(PROMPT_TEMPLATE, question, context)


def evidence_text(parts: Sequence[tuple[str, Column]]) -> Column:
    """``label: value`` lines joined into one evidence text (NULLs skipped)."""
    return F.concat_ws("\n", *[F.when(v.isNotNull(), F.concat(F.lit(f"{label}: "),
                                                              v.cast("string")))
                               for label, v in parts])


def document_evidence(hits: DataFrame, entities: DataFrame, links: DataFrame, hit_id: str, hit_entity: str, entity_key: str,
                      link_entity: str, document: Column, entity: Column, link: Column, chunk: Column | None = None) -> DataFrame:
    """``(hit_id, part, evidence)``: each retrieved document with its entity and all links of that entity as one text.

    ``document``, ``entity`` and ``link`` are the texts of a hit, its entity and one link; a hit without an entity has its
    document alone, an entity without links no link lines.  Links come sorted.  ``chunk`` (a number taken from a link's columns)
    parts an entity's links over several texts, each with the document and entity at its head, so that a hot entity's are
    not put together in one task; hits should be few (the top k).
    """
    names = {"hit": F.col(hit_id), "entity_of": F.col(hit_entity), "document": document}
    h = hits.select(*[c.alias(n) for n, c in names.items()])
    e = entities.select(F.col(entity_key).alias("entity_key"), entity.alias("entity"))
    known = h.join(e, h["entity_of"] == e["entity_key"], "left")
    wanted = known.select("entity_key").filter("entity_key is not null").distinct()
    li = links.select(F.col(link_entity).alias("of"), (chunk if chunk is not None else F.lit(0)).cast("long").alias("part"), link.alias("line"))
    li = li.join(wanted, li["of"] == wanted["entity_key"], "left_semi")
    texts = li.groupBy("of", "part").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("lines"))
    j = known.join(texts, known["entity_key"] == texts["of"], "left")
    return j.select(F.col("hit").alias(hit_id), F.coalesce("part", F.lit(0)).alias("part"),
                    F.concat_ws("\n", "document", "entity", F.when(F.col("lines") != "", F.col("lines"))).alias("evidence"))
